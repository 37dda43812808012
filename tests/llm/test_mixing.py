import random
import re
from collections import defaultdict
from fractions import Fraction

import pytest

import __spark_entry__ as entry
from clearwell.llm.mixing import _block_plan, mix_sources, sainte_lague, shard_quotas, source_targets

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, weights=(1, 2, 3), most=3):
    """Exact shares: cap what is above its limit, share again, until nothing is."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = Fraction(sum(sizes.values())), set()
    while True:
        rest = total - sum(most * sizes[s] for s in capped)
        left = sum(weight[s] for s in names if s not in capped)
        share = {s: Fraction(most * sizes[s]) if s in capped else rest * weight[s] / left for s in names}
        over = {s for s in names if s not in capped and share[s] > most * sizes[s]}
        if not over:
            return share
        capped |= over


def seats_one_by_one(votes, house):
    won = dict.fromkeys(votes, 0)
    for _ in range(house):
        best = max(votes, key=lambda k: (Fraction(votes[k], 2 * won[k] + 1), [-ord(c) for c in k]))
        won[best] += 1
    return won


@pytest.mark.parametrize("house", [0, 1, 2, 7, 100, 12_345])
def test_seats_equal_the_highest_quotients(spark, house):
    rng = random.Random(house)
    votes = {f"p{i}": rng.choice([1, 3, 50, 1000, 98_765]) for i in range(9)}
    df = spark.createDataFrame(list(votes.items()), "k string, v long")
    got = {r["k"]: r["seats"] for r in sainte_lague(df, house, "k", "v").collect()}
    assert {k: got.get(k, 0) for k in votes} == seats_one_by_one(votes, house)


def check(rows, got):
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    want = targets(sizes)
    taken = defaultdict(int)
    assert sorted((r["doc_id"], r["size"]) for r in got if r["doc_id"] is not None) == sorted(
        (i, len(WORD.findall(t or ""))) for i, t, _ in rows if i is not None
    )
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(float(want[r["source"]]))
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for s, words in taken.items():
        assert abs(words - want[s]) <= max(64, 0.02 * want[s]), (s, words, float(want[s]))


def test_query_meets_its_targets(spark):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check(rows, mix_sources(spark.read.parquet(f"{SF}/documents.parquet")).collect())
    first, again = (sorted(map(tuple, entry.queries()["op10_mix_sources"](spark, SF).collect())) for _ in range(2))
    assert first == again


def test_tiny_hot_and_capped_sources(spark):
    rng = random.Random(7)
    rows = [(i, "w " * rng.randint(0, 900), "a" if i % 3 else f"z{i % 7}") for i in range(3000)]
    rows += [(5000, "one two", "tiny"), (5001, None, "void"), (5002, "x y z", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    check(rows, mix_sources(df).collect())


def test_hot_source_among_many(spark):
    rng = random.Random(11)
    rows = [(i, "w " * rng.randint(1, 900), "hot") for i in range(1_400)]
    rows += [(10_000 + i, "w " * rng.randint(400, 800), f"s{i:04}") for i in range(2_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    got = mix_sources(df).collect()
    check(rows, got)
    assert sum(r["taken"] for r in got if r["source"] == "hot") > 0


def test_awkward_rows(spark, docs, no_docs):
    got = mix_sources(docs).collect()
    assert len(got) == docs.count()
    check([(r["doc_id"], r["text"], r["source"]) for r in docs.collect()], got)
    assert all(r["taken"] == 0 for r in got if not r["size"])
    assert mix_sources(no_docs).count() == 0
    blank = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r["size"], r["taken"]) for r in mix_sources(blank).collect()] == [(0, 0), (0, 0)]


def test_shard_quotas_sum_to_the_seats(spark):
    rng = random.Random(13)
    sizes = [("sa", 400_000), ("sb", 900), ("sc", 70_001), ("n", 50)]
    df = spark.createDataFrame([(k, k, s) for k, s in sizes], "_key string, _source string, _size long")
    plan = _block_plan(source_targets(df, (1, 2, 3), 3), 32, 1024, 3, 7)
    shards = []
    for key, size in sizes:
        left, shard = size, 0
        while left:
            words = min(left, rng.randint(1, 2000))
            shards.append((key, shard, words))
            left, shard = left - words, shard + 1
    quotas = shard_quotas(plan, spark.createDataFrame(shards, "_key string, _shard long, _words long")).collect()
    for r in plan.collect():
        own = [q for q in quotas if q["_key"] == r["_key"]]
        assert sum(q["quota"] for q in own) == r["_quota"] and sum(q["blocks"] for q in own) == r["_n"]
        assert all(abs(q["quota"] - r["_quota"] * q["blocks"] / r["_n"]) <= 1 for q in own)
        assert all(0 <= q["quota"] <= 3 * q["blocks"] for q in own)
        assert abs(r["_quota"] * r["source_size"] / r["_n"] - r["target"]) <= max(64, 0.02 * r["target"])


def test_empty_texts_and_a_repeated_id_spread_over_tasks(spark):
    rng = random.Random(17)
    rows = [(i, "w " * rng.randint(1, 300), "a") for i in range(2000)] + [(5000 + i, "x y " * 40, "b") for i in range(500)]
    many = spark.range(100_000).selectExpr("-99 AS doc_id", "'w w w' AS text", "'a' AS source")
    empty = spark.range(100_000).selectExpr("id + 10000 AS doc_id", "'' AS text", "'b' AS source")
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").unionByName(many).unionByName(empty)
    mixed = mix_sources(df)
    got = mixed.collect()
    assert len(got) == df.count()
    wanted = {r["source"]: r["target"] for r in got}
    for source, target in wanted.items():
        assert abs(sum(r["taken"] for r in got if r["source"] == source) - target) <= max(64, 0.02 * target)
    assert all(r["taken"] == 0 for r in got if not r["size"]) and all(r["taken"] <= 3 * r["size"] for r in got)
    copies = [r["taken"] for r in got if r["doc_id"] == -99]
    assert len(copies) == 100_000 and len(set(copies)) > 1  # each has a place of its own
    again = mix_sources(df.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
