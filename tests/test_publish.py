"""All tables of a run appear together or not at all."""

import pytest
from pyspark.sql import functions as F

from clearwell.plans import pipeline
from clearwell.plans.entities import ENTITIES
from clearwell.sources import publish, sinks

from catalog.bronze import bronze

SF = "/root/testdata/sf0.001"


def tables(spark, value):
    return {n: spark.range(10).withColumn("value", F.lit(value)) for n in ("a", "b/c")}


def seen(spark, base):
    version = publish.current(spark, base)
    return {r["value"] for n in ("a", "b/c") for r in version.table(spark, n).collect()}


def test_versions_follow_each_other(spark, tmp_path):
    base = str(tmp_path)
    assert publish.current(spark, base) is None
    for value in (1, 2, 3):
        version, counts = publish.publish(spark, base, lambda f, v=value: sinks.write_tables(tables(spark, v), f), dict)
        assert version.number == value and counts == {"a": 10, "b/c": 10} == publish.current(spark, base).notes
        assert seen(spark, base) == {value}
    assert publish.version(spark, base, 1).table(spark, "a").first()["value"] == 1


def test_a_run_that_fails_in_the_middle_is_not_seen(spark, tmp_path):
    base = str(tmp_path)
    publish.publish(spark, base, lambda f: sinks.write_tables(tables(spark, 1), f))
    reading = publish.current(spark, base).table(spark, "a")

    def fails(folder):
        sinks.write_table(tables(spark, 2)["a"], f"{folder}/a")
        broken = spark.range(10).withColumn("value", F.raise_error(F.lit("lost")))
        sinks.write_table(broken, f"{folder}/b/c")

    with pytest.raises(Exception, match="lost"):
        publish.publish(spark, base, fails)
    assert publish.current(spark, base).number == 1 and seen(spark, base) == {1}
    assert {r["value"] for r in reading.collect()} == {1}
    version, _ = publish.publish(spark, base, lambda f: sinks.write_tables(tables(spark, 3), f))
    assert version.number == 2 and seen(spark, base) == {3}
    assert {r["value"] for r in reading.collect()} == {1}  # a reader keeps its version


def test_of_two_runs_at_a_time_one_is_published(spark, tmp_path):
    base = str(tmp_path)

    def overtaken(folder):
        sinks.write_tables(tables(spark, 1), folder)
        publish.publish(spark, base, lambda f: sinks.write_tables(tables(spark, 2), f))

    with pytest.raises(publish.PublishConflict):
        publish.publish(spark, base, overtaken)
    assert publish.current(spark, base).number == 1 and seen(spark, base) == {2}
    with pytest.raises(publish.PublishConflict):
        publish._switch(spark, base, 1, {"folder": "x", "notes": {}})
    assert seen(spark, base) == {2} and len(list((tmp_path / "manifests").glob("[!.]*"))) == 1


def test_prune_keeps_what_is_read_and_written(spark, tmp_path):
    base = str(tmp_path)
    versions = [publish.publish(spark, base, lambda f, v=v: sinks.write_tables(tables(spark, v), f))[0] for v in range(4)]
    (tmp_path / "versions" / "unfinished").mkdir()
    assert publish.prune(spark, base, keep=2) == sorted(v.folder for v in versions[:2])
    assert seen(spark, base) == {3} and publish.version(spark, base, 3).number == 3
    assert publish.prune(spark, base, keep=2, abandoned_hours=0) == [f"{base}/versions/unfinished"]
    with pytest.raises(ValueError):
        publish.prune(spark, base, keep=0)
    assert publish.publish(spark, base, lambda f: None)[0].number == 5


def test_pipeline_is_published_as_a_whole(spark, tmp_path, monkeypatch):
    raw = bronze(spark, SF)
    base = str(tmp_path / "out")
    version, run = pipeline.publish_pipeline(spark, raw, base, gold_tables=["sales_by_product"], staging=str(tmp_path / "s1"))
    counts = publish.current(spark, base).notes["counts"]
    assert counts == run.counts and set(counts["rejects"]) == set(ENTITIES)
    for layer, name in (("gold", "sales_by_product"), ("rejects", "orders"), ("quality", "silver_counts")):
        assert version.table(spark, f"{layer}/{name}").count() == counts[layer][name]
    fewer = raw | {"orders": raw["orders"].limit(5)}
    monkeypatch.setattr(pipeline.gold, "build_gold", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        pipeline.publish_pipeline(spark, fewer, base, gold_tables=["sales_by_product"], staging=str(tmp_path / "s2"))
    assert publish.current(spark, base) == version
    assert version.table(spark, "rejects/orders").count() == counts["rejects"]["orders"]
