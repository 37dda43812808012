import hashlib
import random
import re
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from clearwell.llm.runs import LastOccurrences, automaton_runs, find_runs, repeating_stretches, suffix_automaton, word_runs

SF = "/root/testdata/sf0.001"


def brute(words, least=24, exponent=3):
    """Every period in turn: stretches that agree with themselves so far on, without a smaller period."""
    number = {}
    a = np.array([number.setdefault(w, len(number)) for w in words], dtype=int)
    out = []
    for q in range(1, len(a) // exponent + 1):
        turn = np.diff(np.concatenate([[0], (a[q:] == a[:-q]).astype(int), [0]]))
        for i, j in zip(np.flatnonzero(turn == 1).tolist(), np.flatnonzero(turn == -1).tolist(), strict=True):
            b = a[i : j + q]
            if len(b) >= max(least, exponent * q) and not any((b[p:] == b[:-p]).all() for p in range(1, q)):
                out.append((i, len(b), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic(rng, size):
    k, words = rng.choice([1, 2, 3, 8, 50]), []
    while len(words) < size:
        block = [rng.randrange(k) for _ in range(rng.choice([1, 2, 3, 5, 9, 14, 25]))]
        words += block * rng.choice([1, 1, 2, 3, 4, 9]) + block[: rng.randrange(len(block) + 1)]
    return words


@pytest.mark.parametrize("least", [24, 6, 1])
def test_equals_brute_force(least):
    rng = random.Random(least)
    for _ in range(400):
        words = periodic(rng, rng.choice([5, 30, 80, 160]))
        want = brute(words, least)
        assert sorted(automaton_runs(words, least), key=lambda r: (r[0], r[2])) == want
        assert word_runs([b"%d" % w for w in words], least) == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60))
def test_small_alphabets(words):
    assert word_runs([b"%d" % w for w in words], 6) == brute(words, 6)


def test_automaton_knows_all_factors():
    rng = random.Random(2)
    for _ in range(50):
        words = [rng.randrange(3) for _ in range(30)]
        link, length, prefixes = suffix_automaton(words)
        factors = {tuple(words[i:j]) for i in range(31) for j in range(i + 1, 31)}
        assert sum(length[v] - length[link[v]] for v in range(1, len(link))) == len(factors)
        assert [length[p] for p in prefixes] == list(range(1, 31))


def test_access_gives_the_segments_of_the_path():
    rng = random.Random(3)
    for _ in range(100):
        n = 40
        parent = [-1] + [rng.randrange(max(0, v - 5), v) for v in range(1, n)]
        tree, colour = LastOccurrences(parent, list(range(n))), {}
        for step in range(60):
            node, want = rng.randrange(n), []
            v = node
            while v >= 0:
                if v in colour and (not want or want[-1][0] != colour[v]):
                    want.append((colour[v], v))
                colour[v] = step
                v = parent[v]
            assert tree.access(node, step) == want


def test_stretches_hold_all_runs_and_skip_the_rest():
    rng = random.Random(4)
    plain = [rng.randrange(10**9) for _ in range(3000)]
    license_line = plain[:40]
    words = plain + license_line + plain[50:200] + [1, 2, 3, 4] * 10 + plain[300:340] + license_line
    found = repeating_stretches(np.array(words, dtype=np.int64))
    assert len(found) == 1 and found[0][1] - found[0][0] < 60
    assert word_runs([b"%d" % w for w in words]) == brute(words)


def test_long_texts_take_near_linear_time():
    fibonacci, before = [0, 1], [0]
    while len(fibonacci) < 50_000:
        fibonacci, before = fibonacci + before, fibonacci
    for words in ([7] * 50_000, list(range(500)) * 100, fibonacci):
        start = time.perf_counter()
        runs = automaton_runs(words)
        assert runs and time.perf_counter() - start < 20


def test_awkward_rows(spark, docs, no_docs):
    got = find_runs(docs.withColumnsRenamed({"quality": "runs", "node": "collapsed", "lang": "a", "source": "t"})).collect()
    texts = [r["text"] for r in docs.collect()]
    assert sorted(r["collapsed"] for r in got if not r["runs"]) == sorted(" ".join((t or "").split()) for t in texts)
    assert {r["n_words"] for r in got if r["doc_id"] in (12, 13, 14)} == {0} and sum(r["doc_id"] is None for r in got) == 1
    assert find_runs(no_docs).collect() == [] and find_runs(no_docs).columns == ["doc_id", "n_words", "runs", "collapsed"]
    rows = [(1, "x " * 30), (1, "x " * 30), (None, "\x1c\xa0 a\tb\n" * 12), (2, "a b c " * 8 + "é\x85 " * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    by = sorted((str(r["doc_id"]), [tuple(x) for x in r["runs"]], r["collapsed"]) for r in find_runs(df).collect())
    assert by[0] == by[1] == ("1", [(0, 30, 1)], "x")
    assert by[2] == ("2", [(0, 24, 3), (24, 40, 1)], "a b c é\x85")
    assert by[3] == ("None", [(0, 36, 3)], "\x1c\xa0 a b")


def test_query_equals_brute_force(spark):
    got = {r["doc_id"]: r for r in entry.queries()["op12_periodic_runs"](spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    some = 0
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        if n > 4000 and h % 10:
            continue  # brute force takes squares
        runs = brute(words)
        some += len(runs)
        drop = {i for a, size, q in runs for i in range(a + q, a + size)}
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        r = got[doc_id]
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest()
        kept = " ".join(w for i, w in enumerate(words) if i not in drop)
        assert r["collapsed_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
    assert some > 10
