import random
import time
import tracemalloc
from collections import Counter

import pytest

import __spark_entry__ as entry
from clearwell.llm import decontaminate
from clearwell.llm.decontaminate import (
    PassageIndex,
    banded_distance,
    codes,
    drop_contaminated,
    find_passages,
    letter_counts,
    letters_lacking,
    normal,
)

SF = "/root/testdata/sf0.001"


def distance(pattern: str, text: str) -> int:
    """Edits of the pattern against its best part of the text."""
    before = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        row = [i]
        for j, b in enumerate(text, 1):
            row.append(min(before[j - 1] + (a != b), before[j] + 1, row[-1] + 1))
        before = row
    return min(before)


def test_banded_alignment_equals_the_full_table():
    rng = random.Random(3)
    for _ in range(500):
        p = "".join(rng.choices("abc", k=rng.randint(1, 14)))
        t = "".join(rng.choices("abc", k=rng.randint(0, 22)))
        most, want = rng.randint(0, 5), distance(p, t)
        got = banded_distance(codes(p), codes(t), most)
        assert (got[0] if got else None) == (want if want <= most else None), (p, t, most)


def edited(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        at, kind = rng.randrange(len(chars)), rng.randrange(3)
        if kind == 0:
            chars[at] = rng.choice("abcdefgh")
        elif kind == 1 and len(chars) > 1:
            del chars[at]
        else:
            chars.insert(at, rng.choice("abcdefgh"))
    return "".join(chars)


def test_no_passage_within_the_budget_is_missed():
    rng = random.Random(4)
    letters = "abcdefghijklmnop "
    items = [normal("".join(rng.choices(letters, k=rng.randint(30, 150)))) for _ in range(20)]
    index = PassageIndex.build(list(enumerate(items)), 6, 0.1)
    finder = index.finder()
    for _ in range(200):
        k = rng.randrange(len(items))
        noise = ["".join(rng.choices(letters, k=rng.randint(0, 300))) for _ in range(2)]
        text = normal(noise[0] + edited(rng, items[k], rng.randint(0, int(index.budgets[k]))) + noise[1])
        found = {x[0]: x for x in finder.find(text)}
        assert (k in found) == (distance(items[k], text) <= index.budgets[k])
        for other, start, end, edits in found.values():
            assert edits == distance(items[other], text[start:end]) <= index.budgets[other]


def test_far_places_of_a_long_text_are_found():
    rng = random.Random(5)
    item = normal("".join(rng.choices("abcdefghijkl ", k=120)))
    filler = normal("".join(rng.choices("mnopqrstuvw ", k=700_000)))
    finder = PassageIndex.build([(1, item)], 8, 0.1).finder()
    text = f"{filler[:300_000]} {item} {filler[300_000:]} {item}"
    assert [(s, e) for _, s, e, _ in finder.find(text)] == [(text.find(item), text.find(item) + len(item)), (text.rfind(item), text.rfind(item) + len(item))]


def test_awkward_rows(spark, docs, no_docs):
    text = docs.where("doc_id = 5").head()["text"]
    items = spark.createDataFrame(
        [(1, text[20:100].upper()), (2, None), (3, " "), (4, "xq"), (5, text[20:100])], "item_id long, text string"
    ).selectExpr("*", "0 AS start", "0 AS id")
    got = find_passages(docs, items).collect()
    assert {(r["doc_id"], r["item_id"], r["edits"]) for r in got} == {(5, 1, 0), (5, 5, 0)}
    many = find_passages(docs, items, index_chars=60).collect()  # several passes
    assert sorted(map(str, many)) == sorted(map(str, got))
    assert find_passages(no_docs, items).count() == find_passages(docs, items.limit(0)).count() == 0
    assert find_passages(docs, items.limit(0)).columns == ["doc_id", "item_id", "start", "end", "edits"]
    clean = drop_contaminated(docs, items)
    assert clean.columns == docs.columns and clean.count() == docs.count() - 1


def test_query_finds_every_verbatim_passage(spark):
    found = {(r["doc_id"], r["item_id"]) for r in entry.queries()["op2_decontaminate"](spark, SF).collect()}
    texts = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    finder = PassageIndex.build([(r["item_id"], r["text"]) for r in items], 8, 0.1)
    want = {(d["doc_id"], i["item_id"]) for d in texts for i in items if normal(i["text"]) in normal(d["text"])}
    assert want and want <= found
    for doc, item in found - want:
        text = next(normal(d["text"]) for d in texts if d["doc_id"] == doc)
        k = finder.ids.index(item)
        assert distance(finder.texts[k], text) <= finder.budgets[k]


def test_bands_are_the_same_a_place_at_a_time(monkeypatch):
    rng = random.Random(9)
    items = [normal("".join(rng.choices("abc ", k=rng.randint(20, 80)))) for _ in range(10)]
    finder = PassageIndex.build(list(enumerate(items)), 4, 0.1).finder()
    texts = [normal("".join(rng.choices("abc ", k=400)) + edited(rng, rng.choice(items), 1)) for _ in range(60)]
    found = [finder.find(t) for t in texts]
    monkeypatch.setattr(decontaminate, "PAIRS_AT_ONCE", -1)
    assert [finder.find(t) for t in texts] == found and any(found)


def test_overlapping_places_of_a_repeating_text():
    """A periodic passage in a periodic text: every place of the old list is covered, none overlap."""
    item = normal("ab cd ef gh " * 6)
    finder = PassageIndex.build([(1, item)], 8, 0.1).finder()
    text = normal("zz " + "ab cd ef gh " * 30 + "qq")
    found = finder.find(text)
    spans = sorted((s, e) for _, s, e, _ in found)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert len(spans) == len(text) // len(item) and all(d == 0 for *_, d in found)


@pytest.mark.parametrize("case", ["runs", "periods"])
def test_repeated_grams_need_little_memory_and_time(case):
    """A ruled line or a table of numbers shares its few grams with many places of many passages."""
    rng = random.Random(6)
    if case == "runs":
        words = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(200)]
        items = [" ".join(rng.choices(words, k=30)) + " 0" * 60 for _ in range(300)]
        text = "0 " * 5000
    else:
        items = [("ab cd " * 200)[i : i + 720 + i] for i in range(5)]
        text = "ab cd " * 600
    finder = PassageIndex.build(list(enumerate(items)), 8, 0.1).finder()
    start = time.perf_counter()
    found = finder.find(text)
    assert time.perf_counter() - start < 2
    places = Counter(k for k, *_ in found)
    assert places == ({} if case == "runs" else {k: len(text) // len(items[k]) for k in range(5)})
    tracemalloc.start()
    assert finder.find(text) == found
    assert tracemalloc.get_traced_memory()[1] < 500 << 20
    tracemalloc.stop()


def test_letters_lacking_bounds_the_distance():
    rng = random.Random(7)
    for _ in range(300):
        p, t = ("".join(rng.choices("abcd", k=rng.randint(a, 15))) for a in (1, 0))
        assert letters_lacking(letter_counts(codes(p)), letter_counts(codes(t))) <= distance(p, t)
