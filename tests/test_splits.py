"""Scan predicates hold every row once, in parts of about equal rows."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from clearwell.sources import readers, splits


def sizes(df, predicates):
    """Rows of each part; fails if a row is in no part or in several."""
    held = [F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates]
    total = held[0]
    for h in held[1:]:
        total = total + h
    row = df.agg(F.min(total).alias("least"), F.max(total).alias("most"), *[F.sum(h).alias(f"n{i}") for i, h in enumerate(held)]).head()
    assert (row["least"], row["most"]) == (1, 1), predicates
    return list(row)[2:]


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(10_000).selectExpr(
        "id * id AS spread", "IF(id % 2 = 0, 5, id) AS hot", "CAST(id % 3 AS int) AS few",
        "IF(id % 4 = 0, NULL, id) AS gaps", "date_add(DATE'2024-01-01', CAST(id % 700 AS int)) AS day",
        "timestamp_seconds(id * 3600) AS moment", "CAST(id AS double) / 7 AS real", "CAST(id / 3 AS decimal(12,2)) AS money",
        "IF(id < 100, CAST('NaN' AS double), id) AS odd", "CAST(id AS string) AS name", "CAST(5 AS int) AS one",
    )


@pytest.mark.parametrize("column", ["spread", "gaps", "day", "moment", "real", "money", "odd"])
@pytest.mark.parametrize("parts", [1, 2, 9])
def test_parts_are_about_equal(table, column, parts):
    predicates = splits.plan_splits(table, column, parts)
    filled = [n for n, p in zip(sizes(table, predicates), predicates, strict=True) if "IS NULL" not in p]
    assert len(filled) == parts
    rows = table.where(f"{column} IS NOT NULL").count()
    assert max(filled) <= 1.2 * 10_000 / parts and min(filled) >= 0.5 * rows / parts - 800


def test_a_heavy_key_stands_alone(table):
    predicates = splits.plan_splits(table, "hot", 8)
    filled = dict(zip(predicates, sizes(table, predicates), strict=True))
    assert filled["hot = 5"] == 5_001 and max(n for p, n in filled.items() if p != "hot = 5") <= 1_400
    divided = splits.plan_splits(table, "hot", 8, then="spread")
    assert max(sizes(table, divided)) <= 2_000 and sum("hot = 5 AND" in p for p in divided) >= 4


def test_few_and_single_keys(spark, table):
    filled = [n for n in sizes(table, splits.plan_splits(table, "few", 9)) if n]
    assert sorted(filled) == [3333, 3333, 3334]
    assert sorted(sizes(table, splits.plan_splits(table, "one", 4)))[-1] == 10_000
    assert sum(sizes(table, splits.plan_splits(table, "one", 4, then="day"))) == 10_000
    none = table.limit(0)
    assert splits.plan_splits(none, "hot", 3) == ["hot IS NOT NULL", "hot IS NULL"]
    assert splits.plan_splits(table, "few", 1) == ["1 = 1"]
    nulls = spark.range(5).selectExpr("CAST(NULL AS bigint) AS k")
    assert sizes(nulls, splits.plan_splits(nulls, "k", 3)) == [0, 5]


def test_what_cannot_be_split(table):
    with pytest.raises(TypeError, match="numbers, dates or times"):
        splits.plan_splits(table, "name", 3)
    with pytest.raises(ValueError):
        splits.plan_splits(table, "hot", 0)
    assert splits._literal(date(2024, 2, 3)) == "DATE '2024-02-03'"


def test_a_sample_plans_the_whole(table):
    predicates = splits.plan_splits(table.where("spread % 5 = 0"), "hot", 6, name="hot")
    assert sum(sizes(table, predicates)) == 10_000


def test_jdbc_read_asks_for_its_parts(spark, table, monkeypatch, tmp_path):
    asked = {}

    def keys(_spark, url, single_task, query, **connection):
        asked.update(url=url, query=query, connection=connection)
        return table.select("hot", "spread")

    class Reader:
        def jdbc(self, url, name, predicates, properties):
            asked.update(table=name, predicates=predicates, properties=properties)
            return table

    class Session:
        read = Reader()
        conf = spark.conf

    monkeypatch.setattr(readers, "read_jdbc", keys)
    readers.read_jdbc_split(Session(), "jdbc:x", "public.orders", "hot", 8, "spread", "TABLESAMPLE SYSTEM (1)", user="u")
    assert asked["query"] == "SELECT hot, spread FROM public.orders TABLESAMPLE SYSTEM (1)"
    assert asked["properties"] == asked["connection"] == {"user": "u"} and asked["table"] == "public.orders"
    assert sum(sizes(table, asked["predicates"])) == 10_000
