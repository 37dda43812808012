"""Multi-line JSON cut at its elements, and records that cannot be read."""

import json
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearwell.operators import rejects, silver
from clearwell.plans.entities import ENTITIES
from clearwell.plans import pipeline, reports
from clearwell.sources import json_arrays, readers

PIECES = ["a{b", "}]", '[,"x\\\\', '\\"', 'é,"{', "𝄞}", "plain", "\\", '"', " {\n}"]


def documents(seed, n):
    rng = random.Random(seed)
    return [
        {"event_id": f"E{i}", "t": "".join(rng.choices(PIECES, k=rng.randrange(4))), "location": {"city": "c}"}, "n": [1, {"k": i}, []], "z": None}
        for i in range(n)
    ]


@pytest.fixture
def split_size(spark):
    """Sets how many bytes a split has; several files or parts of files are then several tasks."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]

    def use(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "0")

    yield use
    for name in names:
        spark.conf.unset(name)


def counted(texts):
    return Counter(json.dumps(json.loads(t), sort_keys=True) for t in texts)


def elements(spark, path, tmp_path, name="elements"):
    return [r["value"] for r in json_arrays.json_elements(spark, str(path), str(tmp_path / name)).collect()]


def test_states_compose():
    """Any block's numbers give the same state as reading all bytes before it."""
    data = np.frombuffer(json.dumps(documents(1, 40), ensure_ascii=False, indent=1).encode(), dtype=np.uint8)
    _, inside, depth = json_arrays.boundaries(data, False, 0, True)
    assert (inside, depth) == (False, 0)
    cuts = [0, *(np.flatnonzero(data == ord("}")) + 1).tolist(), len(data)]
    quotes, level = 0, 0
    for a, b in zip(cuts, cuts[1:], strict=False):
        own, outside, within = json_arrays.summed(data[a:b])
        level += within if quotes % 2 else outside
        quotes += own
        _, inside, depth = json_arrays.boundaries(data[:b], False, 0, True)
        assert (quotes % 2 == 1, level) == (inside, depth)


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("size", [97, 600, 1 << 27])
def test_arrays_are_cut_at_elements(spark, tmp_path, split_size, size, indent):
    docs = documents(2, 12 if size < 100 else 90)
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps(docs, indent=indent, ensure_ascii=False), encoding="utf-8")
    (folder / "b.json").write_text("﻿ [ ]\n", encoding="utf-8")
    (folder / "c.txt").write_text("[1]")
    split_size(size)
    assert counted(elements(spark, folder, tmp_path)) == counted(json.dumps(d) for d in docs)


def test_other_files(spark, tmp_path, split_size):
    docs = documents(3, 5)
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "one.json").write_text(json.dumps(docs[0]))
    (folder / "lines.json").write_text("\n".join(json.dumps(d, indent=1) for d in docs[1:]) + "\n")
    (folder / "mixed.json").write_text('[1, "x,]", null, [2, {"a": 3}], {"event_id": "q"} ]')
    (folder / "two.json").write_text('[{"event_id": "r"}] [{"event_id": "s"}]')
    (folder / "empty.json").write_text("")
    split_size(64)
    want = [*map(json.dumps, docs), "1", '"x,]"', "null", '[2, {"a": 3}]', '{"event_id": "q"}', '{"event_id": "r"}', '{"event_id": "s"}']
    assert counted(elements(spark, folder, tmp_path)) == counted(want)


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ('[{"a":1},{"a":2', ['{"a":1}', '{"a":2']),
        ('[{"a":1},{"a":2}', ['{"a":1}', '{"a":2}']),
        ('[{"a":1},,{"a":2}]', ["", '{"a":1}', '{"a":2}']),
        ('[{"a":1}] rest', ["rest", '{"a":1}']),
        ('[{"a":"open}]', ['{"a":"open}]']),
        ('no json', ["no json"]),
    ],
)
def test_no_text_is_lost_from_broken_files(spark, tmp_path, text, want):
    (tmp_path / "a.json").write_text(text)
    assert sorted(elements(spark, tmp_path / "a.json", tmp_path)) == sorted(want)


def test_large_array_is_read_by_several_tasks(spark, tmp_path):
    docs = documents(4, 2000) * 60
    path = tmp_path / "in"
    path.mkdir()
    (path / "a.json").write_text(json.dumps(docs))
    assert (path / "a.json").stat().st_size > 12_000_000
    chunks = json_arrays._chunks(spark, str(path), False, "*.json")
    assert chunks.rdd.getNumPartitions() > 1
    rows = readers.read_json(spark, str(path), "event_id string, n array<string>", multi_line=True, staging=str(tmp_path / "s"))
    assert rows.count() == len(docs) and rows.select("event_id").distinct().count() == 2000
    assert rows.rdd.getNumPartitions() > 1


def test_inferred_types(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1, "b": {"c": "x"}, "o`OBJECT<": true}, {"a": "y", "d": [1.5]}, 7]')
    rows = readers.read_json(spark, str(tmp_path), multi_line=True, staging=str(tmp_path / "s"), keep_malformed=True)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    assert kinds["a"] == "string" and kinds["b"] == "struct<c:string>" and kinds["o`OBJECT<"] == "boolean"
    assert sorted(str(r["a"]) for r in rows.collect()) == ["1", "None", "y"]
    assert [r["_malformed"] for r in rows.where("_malformed IS NOT NULL").collect()] == ["7"]


def test_what_is_malformed(spark):
    texts = ['{"a":"1","b":{"c":"2"}}', '{"a": x}', "[1]", "3", "", " ", '{"a":"q","b":3}', '{"b":3}', "null", "{", None]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    got = json_arrays.parsed(df, T.StructType.fromDDL("a string, b struct<c: string>")).collect()
    assert [r["_malformed"] for r in got] == [None, '{"a": x}', "[1]", "3", "", " ", None, None, "null", "{", None]
    assert got[6]["a"] == "q" and got[6]["b"] is None


LINES = [
    ("O1,C1,2024-01-05,paid,card,10.5,EUR", None),
    ("O2,C2", "line"),
    ("O3,C3,2024-01-05,paid,card,10.5,EUR,more", "line"),
    ('O4,"C4,2024-01-05,paid,card,10.5,EUR', "line"),
    ('O5,C5,2024-01-05,paid,card,10.5,"EUR', "line"),
    ('"O6","C,6",2024-01-05,"pa""id",card,10.5,EUR', None),
]


def test_csv_lines_that_cannot_be_taken_apart(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.csv").write_text("h1,h2,h3,h4,h5,h6,h7\n" + "\n".join(x for x, _ in LINES) + "\n\n")
    source = readers.Source("csv", str(tmp_path), {"header": "true", "escape": '"'}, ENTITIES["orders"].raw_schema, keep_malformed=True)
    raw = readers.as_raw(readers.read_source(spark, source), "orders")
    by = {r["order_id"]: r for r in raw.collect() if r["_malformed"] is None}
    assert set(by) == {"O1", "O6"} and by["O6"]["customer_id"] == "C,6" and by["O6"]["status"] == 'pa"id'
    valid, rejected = silver.split(raw, ENTITIES["orders"])
    assert "_malformed" not in valid.columns and valid.count() == 4
    got = rejects.envelope(rejected, "orders").where("rejection_reason = 'MALFORMED'")
    assert sorted(r["original_data"] for r in got.collect()) == sorted([x for x, bad in LINES if bad] * 2)
    assert "_malformed" not in got.columns
    assert raw.select("order_id").count() == 12  # whatever columns are read


def test_pipeline_carries_malformed_records(spark, tmp_path):
    empty = {n: spark.createDataFrame([], e.raw_schema) for n, e in ENTITIES.items()}
    (tmp_path / "o.csv").write_text("\n".join(["h1,h2,h3,h4,h5,h6,h7", *[x for x, _ in LINES]]))
    (tmp_path / "events").mkdir()
    (tmp_path / "events" / "e.json").write_text('[{"event_id": "EVT1", "order_id": "ORD1", "event_timestamp": "2024-01-01 10:00:00", "event_type": "DELIVERED"},\n{"event_id": EVT2}]')
    options = {"header": "true", "escape": '"'}
    orders = readers.Source("csv", str(tmp_path / "o.csv"), options, ENTITIES["orders"].raw_schema, keep_malformed=True)
    events = readers.Source("json", str(tmp_path / "events"), {"multiLine": "true"}, ENTITIES["delivery_events"].raw_schema, keep_malformed=True)
    bronze = empty | {n: readers.as_raw(readers.read_source(spark, s), n) for n, s in (("orders", orders), ("delivery_events", events))}
    run = pipeline.run_pipeline(spark, bronze, str(tmp_path / "out"), staging=str(tmp_path / "staging"))
    read = {n: spark.read.parquet(f"{tmp_path}/out/rejects/{n}") for n in ("orders", "delivery_events")}
    assert [r["original_data"] for r in read["delivery_events"].collect()] == ['{"event_id": EVT2}']
    assert read["orders"].where(F.col("rejection_reason") == "MALFORMED").count() == 4
    assert not run.report_errors
    views = reports.raw_views(bronze)
    assert views["orders"].count() == 2 and "_malformed" not in views["orders"].columns


def test_options_that_do_not_go_together(spark, tmp_path):
    schema = ENTITIES["orders"].raw_schema
    for source in (
        readers.Source("parquet", str(tmp_path), keep_malformed=True),
        readers.Source("csv", str(tmp_path), {"multiLine": "true"}, schema, keep_malformed=True),
        readers.Source("json", str(tmp_path), {"mode": "FAILFAST"}, schema, keep_malformed=True),
    ):
        with pytest.raises(ValueError):
            readers.read_source(spark, source)
