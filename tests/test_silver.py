"""Cleaning, rules, rejects and quality counters."""

import json
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from clearwell.operators import duplicates, rejects, silver
from clearwell.plans import quality
from clearwell.plans.entities import CUSTOMERS, ENTITIES, ORDER_ITEMS, ORDERS

from catalog.bronze import spark_table

ITEMS = [
    ("ord-1", "p1", "2", "10.50", "0.15", None),
    ("x", "p1", "2", "10", "0", "ORDER_ID_INVALID"),
    ("x", "", "0", "abc", "9", "ORDER_ID_INVALID"),
    ("1", None, "2", "10", "0", "PRODUCT_ID_INVALID"),
    ("1", "1", "2.5", "10", "0", "QUANTITY_INVALID"),
    ("1", "1", "-1", "0", None, "QUANTITY_NOT_POSITIVE"),
    ("1", "1", "1", "abc", "0", "UNIT_PRICE_INVALID"),
    ("1", "1", "1", "0", "0", "UNIT_PRICE_ZERO"),
    ("1", "1", "1", "1", "", "DISCOUNT_INVALID"),
    ("1", "1", "1", "1", "150", "DISCOUNT_OUT_OF_RANGE"),
    ("1", "1", "1", "-7", "-3", None),
]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([r[:5] for r in ITEMS], ORDER_ITEMS.raw_schema)


def test_first_broken_rule_names_the_reject(items):
    tagged = silver.tag(items, ORDER_ITEMS)
    assert [r.rejection_reason for r in tagged.collect()] == [r[5] for r in ITEMS]


def test_valid_and_rejected_partition_the_cleaned_rows(items):
    cleaned = silver.clean(items, ORDER_ITEMS)
    valid, rejected = silver.split(items, ORDER_ITEMS)
    both = valid.unionByName(rejected.select(*valid.columns))
    assert both.exceptAll(cleaned).isEmpty() and cleaned.exceptAll(both).isEmpty()
    assert valid.columns == items.columns


def test_each_value_is_cleaned_once(items):
    """The reject filter must stay above the cleaning projection."""
    plan = silver.valid(silver.tag(items, ORDER_ITEMS))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in text.splitlines() if "Filter" in line]
    assert filters and all("regexp_extract" not in f for f in filters)


def test_only_rule_and_result_columns_are_read(spark, tmp_path):
    path = str(tmp_path / "customers")
    spark.createDataFrame([], CUSTOMERS.raw_schema).write.parquet(path)
    tagged = silver.tag(spark.read.parquet(path), CUSTOMERS, keep_raw=True)
    ids = silver.valid(tagged).select("customer_id")
    plan = ids._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<customer_id:string,email:string>" in plan


def test_unlisted_columns_are_kept(spark):
    df = spark.createDataFrame(
        [("1", "2", "2026-03-01", "paid", "cb", "5", "", "web")],
        ORDERS.raw_schema + ", channel string",
    )
    valid, _ = silver.split(df, ORDERS)
    row = valid.first()
    assert (row.channel, row.currency, row.total_amount) == ("web", "EUR", Decimal("5.00"))


def test_empty_tables(spark):
    bronze = {n: spark.createDataFrame([], e.raw_schema) for n, e in ENTITIES.items()}
    built = silver.build_silver(bronze)
    assert {r.entity: r.n_rows for r in quality.split_counts(built.tagged).collect()} == {
        n: 0 for n in ENTITIES
    }
    assert rejects.summary(built.tagged).count() == 0
    assert quality.quality_report(built.valid).count() == 21


def test_missing_table_is_named(spark):
    with pytest.raises(KeyError, match="delivery_events"):
        silver.build_silver({})


def test_envelope_keeps_the_row_as_read(items):
    _, rejected = silver.split(items, ORDER_ITEMS)
    env = rejects.envelope(rejected, "order_items")
    assert env.columns[:4] == rejects.ENVELOPE
    row = env.where("rejection_reason = 'DISCOUNT_INVALID'").first()
    assert json.loads(row.original_data) == {
        "order_id": "1",
        "product_id": "1",
        "quantity": "1",
        "unit_price": "1",
        "discount": "",
    }
    null_kept = env.where("rejection_reason = 'PRODUCT_ID_INVALID'").first()
    assert json.loads(null_kept.original_data)["product_id"] is None


def test_envelope_of_the_cleaned_row_leaves_nulls_out(items):
    _, rejected = silver.split(items, ORDER_ITEMS)
    env = rejects.envelope(rejected, "order_items", payload="cleaned")
    row = env.where("rejection_reason = 'PRODUCT_ID_INVALID'").first()
    assert json.loads(row.original_data) == {
        "order_id": "ORD-0001",
        "quantity": 2,
        "unit_price": 10.0,
        "discount": 0.0,
    }


def test_envelope_without_reason_or_data(spark):
    df = spark.createDataFrame([(" ",), (None,), ("WHY",)], "rejection_reason string")
    env = rejects.envelope(df, "s")
    fallback = "Motif de rejet non renseigné"
    assert [r.rejection_reason for r in env.collect()] == [fallback, fallback, "WHY"]
    assert {r.original_data for r in env.collect()} == {"{}"}
    bare = rejects.envelope(spark.range(1), "s").first()
    assert (bare.rejection_reason, bare.original_data) == (fallback, '{"id":0}')
    with pytest.raises(ValueError):
        rejects.envelope(df, "s", payload="other")


def test_customers_without_email(spark):
    rows = [("1",) + (None,) * 8, ("x",) + (None,) * 8]
    df = spark.createDataFrame(rows, CUSTOMERS.raw_schema)
    tagged = silver.tag(df, CUSTOMERS)
    assert [r.rejection_reason for r in tagged.collect()] == [
        "EMAIL_MISSING",
        "CUSTOMER_ID_INVALID",
    ]


def test_quality_counts(spark, items):
    cleaned = silver.clean(items, ORDER_ITEMS)
    got = {r.check_name: r.n_bad for r in quality.quality_of(cleaned, "order_items").collect()}
    assert got == {
        "order_id_null": 2,
        "product_id_null": 2,
        "quantity_invalid": 3,
        "unit_price_invalid": 4,
        "discount_invalid": 3,
    }
    with pytest.raises(KeyError):
        quality.checks("nothing")


def test_quality_is_one_scan(spark, tmp_path, items):
    path = str(tmp_path / "items")
    items.write.parquet(path)
    cleaned = silver.clean(spark.read.parquet(path), ORDER_ITEMS)
    report = quality.quality_of(cleaned, "order_items")
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_null_profile(spark):
    df = spark.createDataFrame([("", 1), (None, None), ("a", 2)], "s string, n int")
    got = {r.column_name: (r.n_missing, r.n_rows) for r in quality.null_profile(df).collect()}
    assert got == {"s": (2, 3), "n": (1, 3)}
    with pytest.raises(ValueError):
        quality.null_profile(df.select())


def test_row_counts(spark):
    counts = quality.row_counts({"a": spark.range(3), "b": spark.range(0)})
    assert {r.table_name: r.n_rows for r in counts.collect()} == {"a": 3, "b": 0}


def test_currency_domain(spark):
    df = spark.createDataFrame(
        [("1", "1", "1", c) for c in ("EUR", "CHF", None)],
        "order_id string, customer_id string, total_amount string, currency string",
    ).withColumn("total_amount", F.col("total_amount").cast("decimal(10,2)"))
    report = quality.quality_of(df, "orders", ["EUR"])
    assert {r.check_name: r.n_bad for r in report.collect()}["currency_outside_domain"] == 1


def test_one_row_a_key(spark, tmp_path):
    rows = [("a", 1, "x"), ("a", 3, "y"), ("a", 3, "y"), ("a", None, "z"), ("b", None, "x"), (None, 1, "x"), (None, 1, "x")]
    rows += [("hot", i, "x") for i in range(300)]
    spark.createDataFrame(rows, "k string, age int, v string").repartition(3).write.parquet(str(tmp_path / "t"))
    tagged = duplicates.tag_duplicates(spark.read.parquet(str(tmp_path / "t")), ["k"], ["age"], "dup")
    kept = sorted(tuple(r) for r in tagged.where("k IS NOT NULL AND NOT dup").drop("dup").collect())
    assert kept == [("a", 3, "y"), ("b", None, "x"), ("hot", 299, "x")]
    assert tagged.where("k IS NULL").where("dup").isEmpty() and tagged.count() == len(rows)
    empty = spark.read.parquet(str(tmp_path / "t")).where("k = 'none'")
    assert duplicates.tag_duplicates(empty, ["k", "v"], [], "dup").count() == 0


@pytest.mark.parametrize("entity", ["orders", "products", "order_items", "reviews", "delivery_events"])
def test_cleaning_is_code_that_the_jvm_compiles(spark, entity):
    """The JVM interprets methods of more than 8,000 bytes for good."""
    tagged = silver.tag(spark_table(spark, "/root/testdata/sf0.001", entity), ENTITIES[entity])
    code = spark._jvm.PythonSQLUtils.explainString(silver.valid(tagged)._jdf.queryExecution(), "codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) <= 8000
