import random

import numpy as np
import pytest
from llm_rows import prose

import __spark_entry__ as entry
from clearwell.llm.jaccard import jaccard_classes, least_matches, shingles, within_groups

SF = "/root/testdata/sf0.001"


def brute(rows, words=5, threshold=0.8):
    """id -> (class, links) by comparing all pairs."""
    sets = {i: set(shingles(t, words).tolist()) for i, t in rows if i is not None}
    ids = sorted(sets)
    label, links = {i: i for i in ids}, dict.fromkeys(ids, 0)
    pairs = []
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            if a and b and len(a & b) >= threshold * len(a | b):
                links[i] += 1
                links[j] += 1
                pairs.append((i, j))
    for _ in ids:
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j])
    return {i: (label[i], links[i]) for i in ids}


def altered(rng, text, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(999)}"
    return " ".join(words)


@pytest.mark.parametrize("block_rows", [4, 1024])
def test_classes_equal_all_pairs(spark, block_rows):
    rng = random.Random(4)
    rows = [prose(rng, rng.randint(1, 120)) for _ in range(40)]
    base = prose(rng, 100)
    rows += [altered(rng, base, rng.randint(0, 5)) for _ in range(60)]  # a large group of near copies
    rows += [base] * 15 + ["two words"] * 3 + ["Two  WORDS", "", " ", None]
    rows += [f"{base} {prose(rng, 90)}" for _ in range(10)]  # a shared passage is no near copy
    rows = list(enumerate(rows))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard_classes(df, block_rows=block_rows).collect()}
    assert got == brute(rows)


def test_awkward_rows(spark, docs, no_docs):
    got = jaccard_classes(docs).collect()
    assert len(got) == docs.count()
    by = {r["doc_id"]: (r["rep_id"], r["class_id"], r["n_links"]) for r in got}
    assert by[16] == (3, 3, 1) and by[3] == (3, 3, 1)
    assert by[4] == (4, 4, 0)  # repeated rows are one document
    assert by[12] == (12, 12, 0) and by[13] == (13, 13, 0) and by[14] == (14, 14, 0) and by[None] == (None, None, 0)
    assert jaccard_classes(no_docs).count() == 0


@pytest.mark.parametrize("block_rows", [4, 1024])
@pytest.mark.parametrize("repeats", [3, 4_000])
def test_repeated_rows_beside_near_copies(spark, repeats, block_rows):
    rng = random.Random(8)
    base, other = prose(rng, 100), prose(rng, 100)
    rows = [(1, base)] + [(2 + i, altered(rng, base, rng.randint(0, 3))) for i in range(20)]
    want = brute(rows)
    assert want[1][1] > 0
    rows += [(1, base)] * repeats + [(1, f" {base.upper()}")] * repeats
    # many texts of one id are one document
    rows += [(99, altered(rng, other, 2)) for _ in range(min(repeats, 500))]
    want[99] = (99, 0)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = jaccard_classes(df, block_rows=block_rows).collect()
    assert len(got) == len(rows)
    assert {(r["doc_id"], r["class_id"], r["n_links"]) for r in got} == {(i, *w) for i, w in want.items()}


def test_pruning_keeps_what_may_be_similar():
    steps = [16, 32, 96]
    for n, least in zip(steps, least_matches(0.8, 1e-5, steps), strict=True):
        # posterior mass from 0.8 on under a uniform prior, by summation
        grid = np.linspace(0, 1, 20_001)

        def mass(m):
            weight = grid**m * (1 - grid) ** (n - m)
            return weight[grid >= 0.8].sum() / weight.sum()

        assert mass(least) >= 0.9e-5 and (least == 0 or mass(least - 1) < 1.1e-5)


def test_all_pairs_of_groups_in_parts():
    starts = np.array([0, 1, 5, 5, 12])
    want = {(i, j) for a, b in zip(starts, starts[1:], strict=False) for i in range(a, b) for j in range(i + 1, b)}
    for at_once in (1, 3, 100):
        got = [(int(x), int(y)) for i, j in within_groups(starts, at_once) for x, y in zip(i, j, strict=True)]
        assert len(got) == len(set(got)) and set(got) == want


def test_query_equals_all_pairs(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = entry.queries()["op8_jaccard_join"](spark, SF).collect()
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in got} == brute(rows)
