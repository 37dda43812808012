"""Truth tables of the value normalisers, and idempotence."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from clearwell.functions import normalize as N
from clearwell.functions import vocab as V

D = Decimal

CASES = {
    "customer_id": (
        N.customer_id,
        [
            ("C001", "C001"),
            (" c2 ", "C002"),
            ("cust-17", "C017"),
            ("CUST12-034", "C012"),
            ("12345", "C12345"),
            ("000123", "C000123"),
            ("none", None),
            ("", None),
            (None, None),
        ],
    ),
    "order_id": (
        N.order_id,
        [("ord-1", "ORD-0001"), (" ORD25", "ORD-0025"), ("36", "ORD-0036"), ("x", None)],
    ),
    "order_id_exact": (
        lambda c: N.order_id(c, exact_width=True),
        [("12345", "ORD-1234"), ("7", "ORD-0007"), (None, None)],
    ),
    "product_id": (N.product_id, [("p1", "P001"), ("PROD-12", "P012"), ("P", None)]),
    "boolean": (
        N.boolean,
        [(w, v) for v, ws in V.BOOLEAN_WORDS.items() for w in ws]
        + [(" TRUE ", True), ("maybe", None), ("", None), (None, None)],
    ),
    "flag": (N.flag, [("Yes", True), ("0", False), ("maybe", False), (None, False)]),
    "country": (
        N.country,
        [
            ("fr", "FRANCE"),
            (" French Republic ", "FRANCE"),
            ("maroc", "MAROC"),
            ("", None),
            ("  ", None),
            (None, None),
        ],
    ),
    "order_status": (
        N.order_status,
        [(w, v) for v, ws in V.ORDER_STATUS_WORDS.items() for w in ws]
        + [(" ANNULÉE ", "CANCELLED"), ("Shipped", "SHIPPED"), ("", ""), (None, None)],
    ),
    "payment_method": (
        N.payment_method,
        [(w, v) for v, ws in V.PAYMENT_WORDS.items() for w in ws]
        + [(" CB", "CARD"), ("cash", "CASH"), (None, None)],
    ),
    "currency": (
        N.currency,
        [("usd ", "USD"), ("", "EUR"), ("   ", "EUR"), (None, "EUR"), ("MAD", "MAD")],
    ),
    "category": (
        N.category,
        [
            ("High-Tech", "High-tech"),
            ("high__tech", "High-tech"),
            ("hightech", "High-tech"),
            ("ELECTRONIQUE", "Electronique"),
            ("INFORMATIQUE", "Informatique"),
            ("maison-jardin", "Maison Jardin"),
            (None, None),
        ],
    ),
    "event_type": (
        N.event_type,
        [(t.lower(), t) for t in V.DELIVERY_EVENT_TYPES]
        + [(" shipped ", "SHIPPED"), ("RETURNED", "UNKNOWN"), (None, "UNKNOWN")],
    ),
    "phone": (
        N.phone,
        [
            ("0033612345678", "+33612345678"),
            ("0612345678", "+33612345678"),
            ("+33 6 12 34 56 78", "+33612345678"),
            ("07-12-34-56-78", "+33712345678"),
            ("0112345678", None),
            ("+34612345678", None),
            ("06123456789", None),
            ("", None),
            (None, None),
        ],
    ),
    "date": (
        N.date,
        [
            ("1990-12-01", date(1990, 12, 1)),
            ("1990/12/01", date(1990, 12, 1)),
            ("01/12/1990", date(1990, 12, 1)),
            ("31-02-2020", None),
            ("2021-02-30", None),
            (" 1990-12-01", None),
            ("1990-1-1", None),
            ("2026-03-12T10:25:00", None),
            ("bad-date", None),
            ("", None),
            (None, None),
        ],
    ),
    "review_date": (
        N.review_date,
        [
            ("2026-03-12T10:25:00", date(2026, 3, 12)),
            ("12/03/2026", date(2026, 3, 12)),
            ("2026/03/12", date(2026, 3, 12)),
            ("2026-03-12T25:25:00", None),
        ],
    ),
    "timestamp": (
        lambda c: N.timestamp(c, V.EVENT_TIMESTAMP_FORMATS),
        [
            ("2026-03-17T08:30:00", datetime(2026, 3, 17, 8, 30)),
            ("2026-03-17t08:30:00", datetime(2026, 3, 17, 8, 30)),
            ("2026-03-17 08:30:00", datetime(2026, 3, 17, 8, 30)),
            ("2026/03/17 08:30:00", datetime(2026, 3, 17, 8, 30)),
            ("17/03/2026 08:30:00", datetime(2026, 3, 17, 8, 30)),
            ("2026-03-17", None),
            ("2026-13-17 08:30:00", None),
            (None, None),
        ],
    ),
    "absolute_money": (
        N.absolute_money,
        [
            ("-20", D("20.00")),
            ("100.5", D("100.50")),
            ("n/a", None),
            ("", None),
            ("123456789012", None),
            (None, None),
        ],
    ),
    "integer": (N.integer, [("3", 3), ("-1", -1), ("2.5", None), ("x", None)]),
    "discount": (
        N.discount,
        [
            ("0.1", D("0.10")),
            ("-0.2", D("0.00")),
            ("1", D("1.00")),
            ("1.2", D("0.01")),
            ("12", D("0.12")),
            ("100", D("1.00")),
            ("150", D("150.00")),
            ("15000", None),
            ("", None),
            (None, None),
        ],
    ),
    "name": (N.name, [(" HP ", "Hp"), ("jean PAUL", "Jean Paul"), ("\tx", "\tx")]),
}


@pytest.mark.parametrize("name", CASES)
def test_truth_table(spark, name):
    normalise, cases = CASES[name]
    rows = [(i, raw) for i, (raw, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, "i int, raw string")
    got = df.select("i", normalise(F.col("raw")).alias("v")).orderBy("i").collect()
    assert [(cases[r.i][0], r.v) for r in got] == list(cases)


def test_a_signed_year_parses_as_with_every_format_tried(spark):
    df = spark.createDataFrame([("+12026-02-03",), ("+2026-02-03",)], "raw string")
    tried = [F.try_to_date("raw", f) for f in V.DATE_FORMATS]
    same = N.date(F.col("raw")).eqNullSafe(F.coalesce(*tried))
    assert [r[0] for r in df.select(same).collect()] == [True, True]


@pytest.mark.parametrize(
    "name",
    [
        "customer_id",
        "order_id",
        "product_id",
        "country",
        "order_status",
        "payment_method",
        "currency",
        "event_type",
        "phone",
        "discount",
        "absolute_money",
    ],
)
def test_normalisers_are_idempotent(spark, name):
    normalise, cases = CASES[name]
    df = spark.createDataFrame([(raw,) for raw, _ in cases], "raw string")
    once = df.select(normalise(F.col("raw")).cast("string").alias("a"))
    twice = once.select("a", normalise(F.col("a")).cast("string").alias("b"))
    assert twice.where(~F.col("a").eqNullSafe(F.col("b"))).count() == 0
