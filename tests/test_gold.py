"""Business tables on small dirty data with duplicate dimension rows.

The checks join the raw valid rows plainly, in DuckDB, so they also check the
copy counts that stand in for duplicates here.
"""

import random
import re
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest
from compare import rows
from pyspark.sql import functions as F

from catalog import oracles as O
from catalog.queries import portable
from clearwell.operators import joins
from clearwell.operators import summaries as S
from clearwell.plans import gold
from clearwell.sources import sinks

SCHEMAS = {
    "customers": "customer_id string, first_name string, last_name string,"
    " email string, city string, country string",
    "orders": "order_id string, customer_id string, order_date date, status string,"
    " total_amount decimal(10,2)",
    "products": "product_id string, product_name string, category string, brand string",
    "order_items": "order_id string, product_id string, quantity int,"
    " unit_price decimal(10,2), discount decimal(5,2)",
    "reviews": "_id string, productId string, orderId string, rating int,"
    " verifiedPurchase boolean",
    "delivery_events": "event_id string, order_id string, event_type string,"
    " event_timestamp timestamp, location struct<city: string, country: string>,"
    " carrier struct<id: string, name: string>",
}


def make_rows(seed: int) -> dict[str, list[tuple]]:
    r = random.Random(seed)

    def money(top):
        return Decimal(r.randint(1, top)) / 100

    def order():
        # one order id holds a third of everything
        return "ORD-0001" if r.random() < 0.34 else f"ORD-{r.randint(2, 40):04d}"

    def product():
        return "P001" if r.random() < 0.34 else f"P{r.randint(2, 30):03d}"

    def customer():
        return "C001" if r.random() < 0.34 else f"C{r.randint(2, 30):03d}"

    data = {
        "customers": [
            (
                customer(),
                r.choice(["Ann", "Bo", None]),
                r.choice(["Lee", None]),
                r.choice(["a@b.co", "c@d.org"]),
                r.choice(["Paris", None]),
                r.choice(["FRANCE", None]),
            )
            for _ in range(40)
        ],
        "orders": [
            (
                order(),
                customer(),
                r.choice([date(2026, 3, d) for d in range(1, 20)] + [None]),
                r.choice(["PAID", "CANCELLED", "ODD", None]),
                money(50_000),
            )
            for _ in range(90)
        ],
        "products": [
            (
                product(),
                r.choice(["Pen", "Cup", "Hat"]),
                r.choice(["Home", None]),
                r.choice(["Hp", "Dell", None]),
            )
            for _ in range(40)
        ],
        "order_items": [
            (order(), product(), r.randint(1, 9), money(9_999), money(100))
            for _ in range(300)
        ],
        "reviews": [
            (
                f"REV{i}",
                product(),
                r.choice([order(), None]),
                r.randint(1, 5),
                r.choice([True, False, None]),
            )
            for i in range(120)
        ],
        "delivery_events": [
            (
                f"EVT{i}",
                order(),
                r.choice(["SHIPPED", "IN_TRANSIT", "DELIVERED", "PREPARING"]),
                datetime(2026, 3, r.randint(1, 6), r.randint(0, 3)),
                (r.choice(["Paris", None]), r.choice(["FRANCE", None])),
                (r.choice(["DHL01", None]), r.choice(["Dhl", None])),
            )
            for i in range(200)
        ],
    }
    # a third of the dimension rows are copies of one row
    for table in ("customers", "products", "orders", "order_items"):
        data[table] += [data[table][0]] * (len(data[table]) // 2)
    return data


@pytest.fixture(scope="module", params=[1, 2])
def tables(spark, request):
    data = make_rows(request.param)
    silver = {n: spark.createDataFrame(data[n], s) for n, s in SCHEMAS.items()}
    con = duckdb.connect()
    for name, df in silver.items():
        arrow = portable_keep_types(df)
        con.register("arrow", arrow)
        con.execute(f"CREATE TABLE silver_{name} AS SELECT * FROM arrow")
        con.unregister("arrow")
    return silver, con


def portable_keep_types(df):
    flat = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "struct":
            flat += [
                F.col(f"{f.name}.{g.name}").alias(f"{f.name}_{g.name}")
                for g in f.dataType.fields
            ]
        elif f.dataType.typeName() == "timestamp":
            flat.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            flat.append(F.col(f.name))
    return df.select(*flat).toArrow()


def check(df, con, name):
    ctes = [c for c in O.TABLE_CTES[name] if not is_entity_cte(c)]
    full = O.table(name)
    sql = "WITH " + ",\n".join(ctes) + full[full.rindex("\nSELECT") :]
    got = rows(df.columns, df.collect())
    cursor = con.execute(sql)
    want = rows([d[0] for d in cursor.description], cursor.fetchall())
    assert got == want


def is_entity_cte(cte: str) -> bool:
    return cte.startswith(("raw_", "values_", "cleaned_", "silver_"))


@pytest.mark.parametrize("name", gold.BUILDERS)
def test_gold_table(tables, name):
    silver, con = tables
    check(portable(gold.BUILDERS[name](silver)), con, name)


@pytest.mark.parametrize("name", sorted(gold.SUMMARIES_OF))
def test_stored_summaries_give_the_same_rows(tables, name, tmp_path):
    silver, con = tables
    stored = sinks.stage_tables(gold.order_summaries(silver), str(tmp_path))
    check(portable(gold.build_gold(silver, [name], stored)[name]), con, name)


def test_latest_event_agrees_with_the_summary(tables):
    silver, _ = tables
    events = silver["delivery_events"]
    latest = S.latest_event(events)
    summary = S.delivery_summary(events).select(*latest.columns)
    assert latest.exceptAll(summary).isEmpty()
    assert latest.count() == summary.count()


def test_net_per_order_adds_up_to_revenue_per_product(tables):
    silver, _ = tables
    one_each = dict(silver, products=silver["products"].dropDuplicates(["product_id"]))
    net = S.order_items_summary(one_each["order_items"]).agg(F.sum("net_amount"))
    revenue = gold.sales_by_product(one_each).agg(F.sum("revenue"))
    assert net.first()[0] == revenue.first()[0]


def test_orphan_counts(tables):
    silver, con = tables
    sql = O.join_orphans()
    body = sql[sql.index("\nSELECT 'orders_customers'") :]
    got = gold.orphan_counts(silver)
    want = con.execute(body)
    assert rows(got.columns, got.collect()) == rows(
        [d[0] for d in want.description], want.fetchall()
    )


SPLITTING = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
}


@pytest.fixture
def splitting(spark):
    """Small partitions count as skewed, and nothing is broadcast."""
    old = {c: spark.conf.get(c, None) for c in SPLITTING}
    for c, v in SPLITTING.items():
        spark.conf.set(c, v)
    yield
    for c, v in old.items():
        spark.conf.unset(c) if v is None else spark.conf.set(c, v)


@pytest.mark.parametrize("hot", [1, 3, 150])
def test_heavy_keys_of_any_number_are_split(spark, splitting, hot):
    """However many heavy keys there are, no task of the join gets one whole."""
    n, partitions = 300_000, 300
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        left = spark.range(0, n, 1, 64).select(
            F.when(F.col("id") % 2 == 0, F.concat(F.lit("HOT"), (F.col("id") / 2 % hot).cast("int")))
            .otherwise(F.concat(F.lit("K"), F.col("id")))
            .alias("k"),
            F.xxhash64("id").alias("noise"),  # sizes in bytes then follow the rows
        )
        summary = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        joined = joins.left_join_summary(left, "k", summary, "s")
        out = joined.select("*", F.spark_partition_id().alias("task")).cache()
        assert out.count() == n and out.where("s.n IS NULL").isEmpty()
        assert out.where(f"s.n = {n // 2 // hot}").count() == n // 2
        most = out.groupBy("task").count().agg(F.max("count")).first()[0]
        assert most <= n / 20  # one of few heavy keys has n / 2 or n / 6 rows
    finally:
        spark.catalog.clearCache()
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_order_lines_cross_few_exchanges(tables, splitting):
    silver, _ = tables
    items, products = silver["order_items"], silver["products"]

    def exchanges(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    # by order and product, so that no task holds the products of an order as a set; by order
    assert exchanges(S.order_items_summary(items)) == 2
    # labels by product and again for the join, lines by product, distinct values, by order
    assert exchanges(S.order_lines_summary(items, products)) == 5


def test_a_shared_customer_is_split_by_adaptive_execution(spark, splitting):
    orders = spark.range(0, 200_000, 1, 8).select(
        F.col("id").cast("string").alias("order_id"),
        F.when(F.col("id") % 3 == 0, "C001")
        .otherwise(F.concat(F.lit("C"), F.col("id")))
        .alias("customer_id"),
    )
    people = spark.range(0, 20_000, 1, 2).select(
        F.concat(F.lit("C"), F.lpad(F.col("id").cast("string"), 3, "0")).alias("customer_id"),
        *[F.lit("x").alias(c) for c in ("first_name", "last_name", "email", "city", "country")],
    )
    joined = gold.orders_with_customers(orders, people)
    assert joined.count() >= 200_000
    joined = joined.repartition(4, "order_id")  # as the order joins that follow
    joined.collect()
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


def test_present_orders_and_leaves_unsorted_tables_alone(tables):
    silver, _ = tables
    best = gold.present("sales_by_product", gold.sales_by_product(silver))
    revenue = [r.revenue for r in best.collect()]
    assert revenue == sorted(revenue, reverse=True)
    assert gold.sort_order("order_items_summary") == []


def test_missing_table_is_named(tables):
    silver, _ = tables
    with pytest.raises(KeyError, match="reviews"):
        gold.build_gold({n: d for n, d in silver.items() if n != "reviews"})


def test_an_order_of_many_products_is_counted_without_a_set(spark):
    """Distinct values are rows spread by (order, value); no aggregate holds a set."""
    n = 200_000
    items = spark.range(n * 2).selectExpr(
        "'ORD00001' AS order_id", f"concat('PRD', id % {n}) AS product_id", "1 AS quantity",
        "CAST(2 AS decimal(10,2)) AS unit_price", "CAST(0 AS decimal(10,2)) AS discount",
    )
    products = spark.range(n).selectExpr("concat('PRD', id) AS product_id", "concat('name ', id) AS product_name", "concat('c', id % 3) AS category", "'b' AS brand")
    summary = S.order_lines_summary(items, products)
    row = summary.collect()[0]
    assert (row["number_of_products"], row["total_quantity"], row["net_amount"]) == (n, 2 * n, Decimal("800000.00"))
    names = row["product_names"].split(", ")
    assert len(names) == n and names == sorted(names) and row["categories"] == "c0, c1, c2" and row["number_of_categories"] == 3
    counted = S.order_items_summary(items)
    assert [r["number_of_products"] for r in counted.collect()] == [n]
    for df in (summary, counted):
        assert "collect_set(product_id" not in df._jdf.queryExecution().optimizedPlan().toString()
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\([^)]*kind#\d+, value#", plan)


def test_a_line_is_one_row_of_an_order(spark):
    """Labels travel with their product; only further labels of one product add rows."""
    items = spark.createDataFrame(
        [("O1", "P1", 1), ("O1", "P1", 2), ("O1", "P2", 1), ("O1", "P3", 1), ("O2", "P2", 5), ("O2", "P9", 1)],
        "order_id string, product_id string, quantity int",
    ).selectExpr("*", "CAST(2 AS decimal(10,2)) AS unit_price", "CAST(0 AS decimal(5,2)) AS discount")
    products = spark.createDataFrame(
        [("P1", "a", "x", "h"), ("P2", "b", "x", "h"), ("P3", "b", "y", "h"), ("P3", "c", "y", None), ("P3", "a", "y", "h")],
        "product_id string, product_name string, category string, brand string",
    )
    values = S._distinct_values(S._labelled_lines(items, products), sums=True)
    # three products and two more names and one more brand of P3; one known product and an unknown one
    assert {r["order_id"]: r["count"] for r in values.groupBy("order_id").count().collect()} == {"O1": 6, "O2": 2}
    found = {r["order_id"]: r for r in S.order_lines_summary(items, products).collect()}
    one, two = found["O1"], found["O2"]
    assert (one["number_of_products"], one["total_quantity"], one["gross_amount"]) == (3, 5, Decimal("10.00"))
    assert (one["product_names"], one["categories"], one["number_of_categories"]) == ("a, b, c", "x, y", 2)
    assert one["brands"] == "Inconnue, h"
    assert (two["product_names"], two["categories"], two["brands"]) == ("Produit supprimé, b", "Inconnue, x", "Inconnue, h")
    listed = {r["order_id"]: r.asDict() for r in S.order_products_summary(items, products).collect()}
    assert listed == {o: {c: r[c] for c in listed[o]} for o, r in found.items()}


def test_summary_joins_compare_numbers_first(spark, splitting):
    left = spark.range(100).selectExpr("concat('ORD', id) AS k")
    joined = joins.left_join_summary(left, "k", left.groupBy("k").count(), "s")
    assert joined.where("s.count = 1").count() == 100
    assert re.search(r"SortMergeJoin \[xxhash64", joined._jdf.queryExecution().executedPlan().toString())
