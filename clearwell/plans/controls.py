"""The nineteen consistency controls of the one-row-per-order table.

All of them come out of a single aggregation by order id followed by a global
one: the table is computed once, and no count goes through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearwell.functions import vocab as V

SCORE = "data_quality_score"

# Control labels, in reporting order.
UNIQUE_ORDERS = "Unicité des commandes"
SCORE_MISSING = "Colonne data_quality_score absente"
SCORE_OUT_OF_RANGE = "Scores qualité hors intervalle"
LABELS = [
    UNIQUE_ORDERS,
    "Order_id manquants",
    "Customer_id manquants",
    "Montants négatifs ou absents",
    "Incohérence des montants calculés",
    "Quantités ou compteurs négatifs",
    "Notes moyennes hors intervalle",
    SCORE_MISSING,
    SCORE_OUT_OF_RANGE,
    "Livraison antérieure à la commande",
    "Expédition antérieure à la commande",
    "Livraison antérieure à l'expédition",
    "Dernier événement antérieur au premier",
    "Statuts de commande non normalisés",
    "Commandes annulées marquées livrées",
    "Commandes livrées sans date",
    "Date de livraison sans statut DELIVERED",
    "Incohérence de l'indicateur customer_found",
    "Incohérence de l'indicateur delivery_found",
]
PASSED, FAILED = "OK", "ERREUR"


def _any(*conditions: Column) -> Column:
    """True if any condition is; NULL conditions count as false."""
    return F.greatest(*[F.coalesce(c, F.lit(False)) for c in conditions])


def _any_negative(*columns: str) -> Column:
    return _any(*[F.col(c) < 0 for c in columns])


def _any_present(*columns: str) -> Column:
    return _any(*[F.col(c).isNotNull() for c in columns])


def row_anomalies() -> dict[str, Column]:
    """Label to "this row is an anomaly", for controls decided row by row."""
    c = F.col
    status, delivered = c("order_status"), c("last_delivery_status") == "DELIVERED"
    conditions = [
        c("order_id").isNull(),
        c("customer_id").isNull(),
        _any(
            c("order_total_amount").isNull(),
            _any_negative(
                "order_total_amount", "gross_amount", "discount_amount", "net_amount"
            ),
        ),
        c("net_amount") != c("gross_amount") - c("discount_amount"),
        _any_negative(
            "number_of_products",
            "total_quantity",
            "number_of_categories",
            "number_of_reviews",
            "verified_reviews",
            "number_of_events",
        ),
        ~c("average_rating").between(1, 5),
        c("delivery_date").cast("date") < c("order_date").cast("date"),
        c("shipping_date").cast("date") < c("order_date").cast("date"),
        c("delivery_date") < c("shipping_date"),
        c("last_event_timestamp") < c("first_event_timestamp"),
        _any(status.isNull(), ~status.isin(V.ORDER_STATUSES)),
        (status == "CANCELLED") & delivered,
        _any(status == "DELIVERED", delivered) & c("delivery_date").isNull(),
        c("delivery_date").isNotNull() & ~delivered,
        ~c("customer_found") & _any_present("first_name", "last_name", "email"),
        ~c("delivery_found")
        & _any(
            _any_present("first_event_timestamp", "last_event_timestamp"),
            c("number_of_events") > 0,
        ),
    ]
    special = (UNIQUE_ORDERS, SCORE_MISSING, SCORE_OUT_OF_RANGE)
    by_row = [label for label in LABELS if label not in special]
    return dict(zip(by_row, conditions, strict=True))


def validation_results(orders_360: DataFrame) -> DataFrame:
    """``controle, nombre_anomalies, statut``, one row per control."""
    anomalies = row_anomalies()
    if SCORE in orders_360.columns:
        score = F.col(SCORE)
        anomalies[SCORE_OUT_OF_RANGE] = score.isNull() | ~score.between(0, 100)
    counters = {label: f"c{LABELS.index(label)}" for label in anomalies}

    per_order = orders_360.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(bad).alias(counters[label]) for label, bad in anomalies.items()],
    )
    totals = per_order.agg(
        F.count_if(F.col("rows") > 1).alias("duplicates"),
        *[
            F.coalesce(F.sum(c), F.lit(0).cast("bigint")).alias(c)
            for c in counters.values()
        ],
    )
    found: dict[str, Column] = {
        UNIQUE_ORDERS: F.col("duplicates"),
        SCORE_MISSING: F.lit(int(SCORE not in orders_360.columns)).cast("bigint"),
        SCORE_OUT_OF_RANGE: F.lit(0).cast("bigint"),
        **{label: F.col(c) for label, c in counters.items()},
    }
    rows = F.array(
        *[
            F.struct(F.lit(label).alias("controle"), found[label].alias("n"))
            for label in LABELS
        ]
    )
    n = F.col("r.n")
    return totals.select(F.explode(rows).alias("r")).select(
        "r.controle",
        n.alias("nombre_anomalies"),
        F.when(n == 0, PASSED).otherwise(FAILED).alias("statut"),
    )


def present(results: DataFrame) -> DataFrame:
    """Reading order: ``OK`` before ``ERREUR`` (descending), then by control."""
    return results.orderBy(F.col("statut").desc(), F.col("controle").asc())


def failed(results: DataFrame) -> DataFrame:
    return results.where(F.col("statut") == FAILED)


def with_quality_score(orders_360: DataFrame) -> DataFrame:
    """Adds ``data_quality_score``: the share of row controls passed, 0 to 100."""
    anomalies = list(row_anomalies().values())
    broken = sum(
        (F.coalesce(bad, F.lit(False)).cast("int") for bad in anomalies), F.lit(0)
    )
    passed = F.lit(len(anomalies)) - broken
    return orders_360.withColumn(
        SCORE, (passed * 100 / len(anomalies)).cast("decimal(5,2)")
    )
