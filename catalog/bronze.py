"""Raw tables derived from the benchmark tables: the same facts, made dirty.

Every raw column is one expression over a benchmark table, written once in the
SQL that Spark and DuckDB share, so both sides of a check start from the same
text.  What differs between the two (date formatting, day arithmetic) goes
through a small dialect.  No row is left out: orphans and rejects come from
unreadable ids and values.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# The benchmark tables read here, declared so that reading them
# needs no footer job.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string,"
    " o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string,"
    " p_size int, p_retailprice double",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint,"
    " l_linenumber int, l_quantity double, l_extendedprice double,"
    " l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string",
}

# strftime spelling of the Java patterns used below
_STRFTIME = {
    "yyyy-MM-dd": "%Y-%m-%d",
    "yyyy/MM/dd": "%Y/%m/%d",
    "dd/MM/yyyy": "%d/%m/%Y",
    "yyyy-MM-dd HH:mm:ss": "%Y-%m-%d %H:%M:%S",
    "yyyy/MM/dd HH:mm:ss": "%Y/%m/%d %H:%M:%S",
    "dd/MM/yyyy HH:mm:ss": "%d/%m/%Y %H:%M:%S",
    "yyyy-MM-dd'T'HH:mm:ss": "%Y-%m-%dT%H:%M:%S",
}


@dataclass(frozen=True)
class Dialect:
    duckdb: bool

    def fmt(self, moment: str, pattern: str) -> str:
        if self.duckdb:
            return f"strftime({moment}, '{_STRFTIME[pattern]}')"
        quoted = pattern.replace("'", "\\'")
        return f"date_format({moment}, '{quoted}')"

    def days_after(self, day: str, days: str) -> str:
        if self.duckdb:
            return f"(DATE '{day}' + CAST({days} AS INTEGER))"
        return f"date_add(DATE '{day}', CAST({days} AS INT))"

    def div(self, a: str, b: int) -> str:
        return f"({a} // {b})" if self.duckdb else f"({a} DIV {b})"


SPARK, DUCKDB = Dialect(False), Dialect(True)


def text(expression: str) -> str:
    return f"CAST({expression} AS STRING)"


def money(expression: str) -> str:
    return text(f"CAST({expression} AS DECIMAL(12,2))")


def pick(key: str, *choices: str) -> str:
    """The choice numbered ``key`` modulo their count."""
    cases = " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(choices))
    return f"CASE ({key}) % {len(choices)} {cases} END"


def spoil(key: str, value: str, *flaws: tuple[int, int, str]) -> str:
    """``value``, replaced where ``key`` modulo m is r by the flaw (m, r, flaw)."""
    cases = " ".join(f"WHEN ({key}) % {m} = {r} THEN {flaw}" for m, r, flaw in flaws)
    return f"CASE {cases} ELSE {value} END"


def spell_id(turn: str, number: str, *prefixes: str) -> str:
    n = text(number)
    return pick(turn, *[f"concat('{p}', {n})" for p in prefixes])


Columns = dict[str, str]


def customers(d: Dialect) -> Columns:
    k, ks = "c_custkey", text("c_custkey")
    born = d.days_after("1950-01-01", f"({k} * 37) % 18000")
    made = d.days_after("2020-01-01", f"{k} % 1500")
    return {
        "customer_id": spoil(
            k,
            spell_id(k, k, "c", " C", "cust-", "CUST ", "C"),
            (41, 7, "'unknown'"),
            (97, 11, "NULL"),
        ),
        "first_name": pick(
            k, "c_mktsegment", "lower(c_mktsegment)", "concat(' ', c_mktsegment, ' ')"
        ),
        "last_name": spoil(k, "upper(c_name)", (61, 3, "NULL")),
        "email": spoil(
            k,
            pick(
                k,
                f"concat('User', {ks}, '@Example.com')",
                f"concat(' user', {ks}, '@example.org ')",
            ),
            (17, 3, f"concat('user', {ks}, '.example.com')"),
            (29, 5, "NULL"),
        ),
        "phone": pick(
            k,
            f"concat('00336', lpad({ks}, 8, '1'))",
            f"concat('06', lpad({ks}, 8, '2'))",
            f"concat('+33 7 ', lpad({ks}, 8, '3'))",
            "''",
            "NULL",
            "'call me'",
            f"concat('07-', lpad({ks}, 8, '4'))",
            f"concat('01', lpad({ks}, 8, '5'))",
        ),
        "city": pick(k, "n_name", "lower(n_name)", "concat(n_name, ' nord ')", "NULL"),
        "country": pick(
            k, "'FR'", "'france'", "' French Republic '", "''", "lower(n_name)", "NULL"
        ),
        "birth_date": pick(
            k,
            d.fmt(born, "yyyy-MM-dd"),
            d.fmt(born, "yyyy/MM/dd"),
            d.fmt(born, "dd/MM/yyyy"),
            "'31-02-2020'",
            "''",
            f"concat(' ', {d.fmt(born, 'yyyy-MM-dd')})",
            "'2021-02-30'",
        ),
        "created_at": pick(
            k,
            f"concat({d.fmt(made, 'yyyy-MM-dd')}, ' 08:15:00')",
            f"concat({d.fmt(made, 'yyyy/MM/dd')}, ' 23:59:59')",
            f"concat({d.fmt(made, 'yyyy-MM-dd')}, 'T00:00:01')",
            d.fmt(made, "dd/MM/yyyy"),
        ),
    }


def orders(d: Dialect) -> Columns:
    k = "o_orderkey"
    amount = money("o_totalprice")
    status = (
        "CASE o_orderstatus"
        f" WHEN 'P' THEN {pick(k, repr('paid'), repr('Payée'), repr(' PAID '), repr('payee'))}"
        f" WHEN 'F' THEN {pick(k, repr('completed'), repr('Terminée'), repr('COMPLETE'), repr('delivered'))}"
        f" ELSE {pick(k, repr('pending'), repr('annulée'), repr(' Cancelled'), repr('en attente'), repr('ANNULÉE'))}"
        " END"
    )
    return {
        "order_id": spoil(
            k,
            spell_id(k, k, "ord-", " ORD", "ORD-", "order "),
            (211, 9, "'n/a'"),
            (307, 2, "NULL"),
        ),
        "customer_id": spoil(
            k,
            spell_id(k, "o_custkey", "c", "C", " cust-"),
            (83, 3, "'cust-x'"),
            (61, 5, "'C99999999'"),
        ),
        "order_date": pick(
            k,
            d.fmt("o_orderdate", "yyyy-MM-dd"),
            d.fmt("o_orderdate", "yyyy/MM/dd"),
            d.fmt("o_orderdate", "dd/MM/yyyy"),
            "'bad-date'",
            d.fmt("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
            f"concat(' ', {d.fmt('o_orderdate', 'yyyy-MM-dd')}, ' ')",
            d.fmt("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"),
        ),
        "status": spoil(k, status, (53, 0, "NULL"), (59, 1, "'shipped'")),
        "payment_method": spoil(
            k,
            "CASE o_orderpriority WHEN '1-URGENT' THEN 'Credit Card'"
            " WHEN '2-HIGH' THEN ' cb ' WHEN '3-MEDIUM' THEN 'VIREMENT'"
            " WHEN '5-LOW' THEN 'PayPal' ELSE 'cash' END",
            (71, 4, "NULL"),
        ),
        "total_amount": spoil(
            k,
            amount,
            (19, 4, f"concat('-', {amount})"),
            (101, 7, "'n/a'"),
            (103, 8, "NULL"),
            (107, 9, "'123456789012.00'"),
        ),
        "currency": pick(k, "'EUR'", "''", "NULL", "' usd '", "'mad'", "'chf'"),
    }


def products(d: Dialect) -> Columns:
    k = "p_partkey"
    return {
        "product_id": spoil(k, spell_id(k, k, "p", "P", "PROD-"), (23, 4, "'n/a'")),
        "product_name": spoil(
            k,
            pick(k, "p_name", "upper(p_name)", "concat(' ', p_name, ' ')"),
            (37, 5, "NULL"),
        ),
        "category": "CASE p_type"
        " WHEN 'ECONOMY' THEN "
        + pick(k, "'high tech'", "' High-Tech '", "'HIGH__TECH'")
        + " WHEN 'PROMO' THEN 'hightech'"
        " WHEN 'LARGE' THEN " + pick(k, "'electronique'", "'ELECTRONIQUE'")
        + " WHEN 'SMALL' THEN 'INFORMATIQUE'"
        " WHEN 'MEDIUM' THEN 'maison-jardin' ELSE NULL END",
        "brand": pick(k, "p_brand", "upper(p_brand)", "'HP'", "NULL"),
        "current_price": spoil(
            k,
            money("p_retailprice"),
            (31, 6, "'0'"),
            (43, 7, "'abc'"),
            (47, 8, "'-5'"),
        ),
        "active": pick(
            k, "'True'", "'yes'", "' OUI '", "'1'", "'False'", "'0'", "'maybe'", "NULL"
        ),
    }


def order_items(d: Dialect) -> Columns:
    m = "l_orderkey * 7 + l_partkey * 3 + l_linenumber"
    price = money("l_extendedprice")
    return {
        "order_id": spoil(
            m,
            spell_id(m, "l_orderkey", "ord-", " ORD", "ORD-", "order "),
            (401, 9, "''"),
        ),
        "product_id": spoil(
            m, spell_id(m, "l_partkey", "P", "prod-", " p"), (409, 3, "NULL")
        ),
        "quantity": spoil(
            m,
            text("CAST(l_quantity AS INTEGER)"),
            (22, 3, "'0'"),
            (23, 4, "'-1'"),
            (151, 7, "'2.5'"),
        ),
        "unit_price": spoil(
            m, price, (29, 2, f"concat('-', {price})"), (57, 5, "'0'"), (173, 1, "'abc'")
        ),
        "discount": spoil(
            m,
            text("CAST(l_discount AS DECIMAL(5,2))"),
            (13, 5, "NULL"),
            (13, 6, "'12'"),
            (13, 7, "'-0.05'"),
            (89, 4, "'1.2'"),
            (97, 9, "'150'"),
            (179, 2, "'15000'"),
        ),
    }


def reviews(d: Dialect) -> Columns:
    k = "event_id"
    return {
        "_id": spoil(k, f"concat(' REV', {text(k)})", (113, 6, "NULL")),
        "customerId": spell_id(k, "user_id", "cust-", "C"),
        "productId": spoil(k, spell_id(k, f"({k} * 31) % 1999", "P", "p-"), (71, 2, "'P'")),
        "orderId": spoil(
            k, spell_id(k, d.div(k, 2), "ORD-", "ord ", " ORD"), (67, 1, "NULL")
        ),
        "rating": spoil(k, text(f"1 + ({k} * 5) % 7"), (109, 3, "'good'"), (127, 4, "NULL")),
        "comment": pick(k, "concat(' ', event_type, ' ')", "''", "NULL"),
        "reviewDate": pick(
            k,
            d.fmt("ts", "yyyy-MM-dd"),
            d.fmt("ts", "dd/MM/yyyy"),
            d.fmt("ts", "yyyy/MM/dd"),
            d.fmt("ts", "yyyy-MM-dd'T'HH:mm:ss"),
            "'yesterday'",
        ),
        "verifiedPurchase": pick(
            k, "'true'", "'1'", "'Yes'", "'no'", "'0'", "'false'", "'maybe'", "NULL"
        ),
    }


def delivery_events(d: Dialect) -> Columns:
    k = "event_id"
    return {
        "event_id": spoil(k, f"concat(' evt', {text(k)})", (131, 5, "NULL")),
        "order_id": spoil(
            k, spell_id(k, d.div(k, 4), "ORD-", "ord ", " ORD"), (137, 2, "'?'")
        ),
        "event_type": "CASE event_type WHEN 'signup' THEN 'order_created'"
        " WHEN 'view' THEN " + pick(k, "'PREPARING'", "' in_transit '")
        + " WHEN 'click' THEN " + pick(k, "'Shipped'", "'OUT_FOR_DELIVERY'")
        + " WHEN 'purchase' THEN 'DELIVERED'"
        " ELSE " + pick(k, "'X'", "'RETURNED'", "' cancelled '", "NULL") + " END",
        "event_timestamp": spoil(
            k,
            pick(
                k,
                d.fmt("ts", "yyyy-MM-dd'T'HH:mm:ss"),
                d.fmt("ts", "yyyy-MM-dd HH:mm:ss"),
                d.fmt("ts", "yyyy/MM/dd HH:mm:ss"),
                d.fmt("ts", "dd/MM/yyyy HH:mm:ss"),
            ),
            (47, 3, "'soon'"),
            (139, 8, "NULL"),
        ),
        "city": pick("user_id", "'PARIS'", "' lyon '", "'toulouse centre'", "NULL"),
        "country": pick("user_id", "'France'", "'FR'", "'maroc'", "''", "NULL"),
        "carrier_id": pick("user_id", "'dhl01'", "' UPS01'", "NULL"),
        "carrier_name": pick("user_id", "'DHL'", "'ups express'", "NULL"),
    }


# entity -> (benchmark table, raw columns)
TABLES = {
    "customers": ("customer", customers),
    "orders": ("orders", orders),
    "products": ("part", products),
    "order_items": ("lineitem", order_items),
    "reviews": ("events", reviews),
    "delivery_events": ("events", delivery_events),
}


def duckdb_sql(entity: str) -> str:
    table, columns = TABLES[entity]
    source = table
    if entity == "customers":
        source = "customer LEFT JOIN nation ON c_nationkey = n_nationkey"
    listed = ",\n  ".join(f'{e} AS "{c}"' for c, e in columns(DUCKDB).items())
    return f"SELECT {listed}\nFROM {source}"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def spark_table(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    table, make_columns = TABLES[entity]
    columns = make_columns(SPARK)
    if entity == "delivery_events":
        city, country = columns.pop("city"), columns.pop("country")
        carrier, carrier_name = columns.pop("carrier_id"), columns.pop("carrier_name")
        columns["location"] = f"named_struct('city', {city}, 'country', {country})"
        columns["carrier"] = f"named_struct('id', {carrier}, 'name', {carrier_name})"
    df = read(spark, sf_dir, table)
    if entity == "customers":
        nation = read(spark, sf_dir, "nation")
        df = df.join(nation, df.c_nationkey == nation.n_nationkey, "left")
    return df.selectExpr(*[f"{e} AS `{c}`" for c, e in columns.items()])


def bronze(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {entity: spark_table(spark, sf_dir, entity) for entity in TABLES}
