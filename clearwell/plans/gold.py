"""Business tables built from the valid rows.

Facts are aggregated by their key *before* they meet a dimension, and identical
dimension rows are folded into one row with a copy count.  Neither a hot key nor
a pile of copies then reaches a join as raw rows, and multiplying by the copy
count gives the totals that joining the raw rows would give.  Tables are returned
unsorted; :func:`present` gives the reading order, because sorting before a
Parquet write costs a range shuffle that no reader benefits from.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearwell.functions import vocab as V
from clearwell.operators import joins
from clearwell.operators import summaries as S
from clearwell.operators.silver import require
from clearwell.plans.entities import ENTITIES

Silver = Mapping[str, DataFrame]
Summaries = Mapping[str, DataFrame]


def _or_zero(column: Column, type_name: str = "bigint") -> Column:
    return F.coalesce(column, F.lit(0).cast(type_name))


def _products_with_copies(products: DataFrame) -> DataFrame:
    keys = ["product_id", *S.product_labels()]
    return products.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))


def _times_copies(column: str) -> Column:
    return F.col(column) * F.coalesce(F.col("copies"), F.lit(1).cast("bigint"))


def sales_by_product(silver: Silver) -> DataFrame:
    amount = S.line_amounts()["net_amount"]
    sold = (
        silver["order_items"]
        .select("product_id", "quantity", amount.alias("line_total"))
        .groupBy("product_id")
        .agg(
            F.sum("quantity").alias("quantity_sold"),
            S.total("line_total").alias("revenue"),
        )
    )
    return sold.join(
        _products_with_copies(silver["products"]), "product_id", "left"
    ).select(
        "product_id",
        *S.product_labels(),
        _times_copies("quantity_sold").alias("quantity_sold"),
        _times_copies("revenue").cast(V.TOTAL_AMOUNT).alias("revenue"),
    )


def _orders_per_customer(orders: DataFrame) -> DataFrame:
    return orders.groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("number_of_orders"),
        S.total("total_amount").alias("total_spent"),
    )


def _customers_with_copies(customers: DataFrame) -> DataFrame:
    return customers.groupBy(
        "customer_id",
        F.concat_ws(" ", "first_name", "last_name").alias("full_name"),
        S.label("email", V.UNKNOWN_M).alias("email"),
        S.label("city", V.UNKNOWN_F).alias("city"),
        S.label("country", V.UNKNOWN_M).alias("country"),
    ).agg(F.count(F.lit(1)).alias("copies"))


def customer_orders(silver: Silver) -> DataFrame:
    spent = _orders_per_customer(silver["orders"])
    known = _customers_with_copies(silver["customers"])
    return spent.join(known, "customer_id", "left").select(
        "customer_id",
        S.label("full_name", V.NO_CUSTOMER).alias("full_name"),
        S.label("email", V.UNKNOWN_M).alias("email"),
        S.label("city", V.UNKNOWN_F).alias("city"),
        S.label("country", V.UNKNOWN_M).alias("country"),
        F.col("copies").isNotNull().alias("customer_found"),
        "number_of_orders",
        _or_zero(_times_copies("total_spent"), V.TOTAL_AMOUNT)
        .cast(V.TOTAL_AMOUNT)
        .alias("total_spent"),
    )


def product_ratings(silver: Silver) -> DataFrame:
    rated = (
        silver["reviews"]
        .groupBy(F.col("productId").alias("product_id"))
        .agg(*S.rating_columns("_id"))
    )
    return rated.join(
        _products_with_copies(silver["products"]), "product_id", "left"
    ).select(
        "product_id",
        *S.product_labels(),
        F.col("copies").isNotNull().alias("product_found"),
        "average_rating",
        _times_copies("number_of_reviews").alias("number_of_reviews"),
        _times_copies("verified_reviews").alias("verified_reviews"),
    )


def _delivery_columns(side: str) -> dict[str, Column]:
    """Delivery fields of a joined struct, with the labels for "no event"."""

    def field(name: str) -> Column:
        return F.col(f"{side}.{name}")

    return {
        "status": F.coalesce(field("last_delivery_status"), F.lit(V.NO_EVENT)),
        "first_event_timestamp": field("first_event_timestamp"),
        "last_event_timestamp": field("last_event_timestamp"),
        "number_of_events": _or_zero(field("number_of_events")),
        "shipping_date": field("shipping_date"),
        "delivery_date": field("delivery_date"),
        "city": F.coalesce(field("last_city"), F.lit(V.UNKNOWN_F)),
        "country": F.coalesce(field("last_country"), F.lit(V.UNKNOWN_M)),
        "carrier_id": F.coalesce(field("carrier_id"), F.lit(V.UNKNOWN_M)),
        "carrier_name": F.coalesce(field("carrier_name"), F.lit(V.UNKNOWN_M)),
        "found": F.col(side).isNotNull(),
    }


def order_summaries(silver: Silver) -> dict[str, DataFrame]:
    """The per-order summaries that several business tables share."""
    return {
        "lines": S.order_lines_summary(silver["order_items"], silver["products"]),
        "reviews": S.order_reviews_summary(silver["reviews"]),
        "delivery": S.delivery_summary(silver["delivery_events"]),
    }


def delivery_status(silver: Silver, summaries: Summaries | None = None) -> DataFrame:
    delivery = (
        summaries["delivery"] if summaries else S.delivery_summary(silver["delivery_events"])
    )
    orders = silver["orders"].select("order_id", "customer_id", "order_date")
    joined = joins.left_join_summary(orders, "order_id", delivery, "_delivery")
    d = _delivery_columns("_delivery")
    return joined.select(
        "order_id",
        "customer_id",
        "order_date",
        d["status"].alias("delivery_status"),
        d["first_event_timestamp"].alias("first_event_timestamp"),
        d["last_event_timestamp"].alias("last_event_timestamp"),
        d["number_of_events"].alias("number_of_events"),
        d["shipping_date"].alias("shipping_date"),
        d["delivery_date"].alias("delivery_date"),
        d["city"].alias("last_known_city"),
        d["country"].alias("last_known_country"),
        d["carrier_id"].alias("carrier_id"),
        d["carrier_name"].alias("carrier_name"),
        d["found"].alias("delivery_event_found"),
    )


def orders_with_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Every order with its customer's names, or NULLs and ``customer_found=false``.

    Both inputs are shuffled for this join alone, so Spark's skew handling can
    split a customer id that many orders share.
    """
    known = customers.select(
        F.col("customer_id").alias("_customer"),
        "first_name",
        "last_name",
        "email",
        F.col("city").alias("customer_city"),
        F.col("country").alias("customer_country"),
    )
    return (
        orders.join(known, F.col("customer_id") == F.col("_customer"), "left")
        .withColumn("customer_found", F.col("_customer").isNotNull())
        .drop("_customer")
    )


def items_with_products(order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Every order line with its product's labels and ``product_found``."""
    known = products.select(
        F.col("product_id").alias("_product"), "product_name", "category", "brand"
    )
    return order_items.join(
        known, F.col("product_id") == F.col("_product"), "left"
    ).select(
        *order_items.columns,
        *S.product_labels(),
        F.col("_product").isNotNull().alias("product_found"),
    )


# relation -> (facts, their key, dimension, its key)
RELATIONS = {
    "orders_customers": ("orders", "customer_id", "customers", "customer_id"),
    "order_items_orders": ("order_items", "order_id", "orders", "order_id"),
    "order_items_products": ("order_items", "product_id", "products", "product_id"),
    "reviews_products": ("reviews", "productId", "products", "product_id"),
    "reviews_orders": ("reviews", "orderId", "orders", "order_id"),
    "delivery_events_orders": ("delivery_events", "order_id", "orders", "order_id"),
}


def orphan_counts(silver: Silver) -> DataFrame:
    """``relation, n_rows, n_unmatched``: fact rows whose key has no counterpart.

    Each table is read once: its rows become (dimension, key, relation) entries, with
    no relation where the row is the dimension's own.  One aggregation by key counts
    the entries of each relation and sees whether the key is known; hot keys are
    combined before the shuffle, and nothing is joined.
    """
    entries: dict[str, list[Column]] = {}

    def add(table: str, dimension: str, key: str, relation: str | None) -> None:
        entry = F.struct(
            F.lit(dimension).alias("dimension"),
            F.col(key).alias("key"),
            F.lit(relation).cast("string").alias("relation"),
        )
        entries.setdefault(table, []).append(entry)

    for relation, (facts, fact_key, dimension, _) in RELATIONS.items():
        add(facts, dimension, fact_key, relation)
    for dimension, key in {(d, k) for _, _, d, k in RELATIONS.values()}:
        add(dimension, dimension, key, None)
    rows = reduce(
        DataFrame.unionByName,
        [
            silver[table].select(F.explode(F.array(*columns)).alias("e")).select("e.*")
            for table, columns in sorted(entries.items())
        ],
    )
    own = F.col("relation").isNull()
    per_key = rows.groupBy("dimension", "key").agg(
        F.max(own & F.col("key").isNotNull()).alias("known"),
        *[F.count_if(F.col("relation") == r).alias(r) for r in RELATIONS],
    )
    counts = per_key.agg(
        *[
            F.struct(
                F.lit(r).alias("relation"),
                _or_zero(F.sum(r)).alias("n_rows"),
                _or_zero(F.sum(F.when(~F.col("known"), F.col(r)))).alias("n_unmatched"),
            ).alias(r)
            for r in RELATIONS
        ]
    )
    return counts.select(F.explode(F.array(*RELATIONS)).alias("r")).select("r.*")


def customer_order_360(silver: Silver, summaries: Summaries | None = None) -> DataFrame:
    """One row per order: customer, amounts, products, reviews and delivery.

    The summaries are brought together by order first, so the orders are shuffled by
    order id once and meet one row per order, in a join whose heavy keys Spark splits.
    """
    narrow = silver["orders"].select(
        "order_id",
        "customer_id",
        "order_date",
        F.col("status").alias("order_status"),
        F.col("total_amount").alias("order_total_amount"),
    )
    known = joins.combined("order_id", summaries or order_summaries(silver))
    joined = joins.left_join_summary(
        orders_with_customers(narrow, silver["customers"]), "order_id", known, "_order"
    )
    amounts = ("gross_amount", "discount_amount", "net_amount")
    d = _delivery_columns("_order.delivery")
    return joined.select(
        "order_id",
        "customer_id",
        "order_date",
        "order_status",
        "order_total_amount",
        "first_name",
        "last_name",
        "email",
        "customer_city",
        "customer_country",
        "customer_found",
        _or_zero(F.col("_order.lines.number_of_products")).alias("number_of_products"),
        _or_zero(F.col("_order.lines.total_quantity")).alias("total_quantity"),
        *[_or_zero(F.col(f"_order.lines.{a}"), V.TOTAL_AMOUNT).alias(a) for a in amounts],
        F.coalesce("_order.lines.product_names", F.lit(V.NO_PRODUCT)).alias("product_names"),
        F.coalesce("_order.lines.categories", F.lit(V.UNKNOWN_F)).alias("categories"),
        F.coalesce("_order.lines.brands", F.lit(V.UNKNOWN_F)).alias("brands"),
        _or_zero(F.col("_order.lines.number_of_categories")).alias("number_of_categories"),
        F.col("_order.reviews.average_rating").alias("average_rating"),
        _or_zero(F.col("_order.reviews.number_of_reviews")).alias("number_of_reviews"),
        _or_zero(F.col("_order.reviews.verified_reviews")).alias("verified_reviews"),
        d["first_event_timestamp"].alias("first_event_timestamp"),
        d["last_event_timestamp"].alias("last_event_timestamp"),
        d["number_of_events"].alias("number_of_events"),
        d["status"].alias("last_delivery_status"),
        d["shipping_date"].alias("shipping_date"),
        d["delivery_date"].alias("delivery_date"),
        d["city"].alias("last_city"),
        d["country"].alias("last_country"),
        d["carrier_id"].alias("carrier_id"),
        d["carrier_name"].alias("carrier_name"),
        d["found"].alias("delivery_found"),
    )


def _part_of_lines(summaries: Summaries, like: DataFrame) -> DataFrame:
    return summaries["lines"].select(*like.columns)


def order_items_summary(silver: Silver, summaries: Summaries | None = None) -> DataFrame:
    own = S.order_items_summary(silver["order_items"])
    return _part_of_lines(summaries, own) if summaries else own


def order_products_summary(silver: Silver, summaries: Summaries | None = None) -> DataFrame:
    own = S.order_products_summary(silver["order_items"], silver["products"])
    return _part_of_lines(summaries, own) if summaries else own


def order_reviews_summary(silver: Silver, summaries: Summaries | None = None) -> DataFrame:
    return summaries["reviews"] if summaries else S.order_reviews_summary(silver["reviews"])


def delivery_summary(silver: Silver, summaries: Summaries | None = None) -> DataFrame:
    return summaries["delivery"] if summaries else S.delivery_summary(silver["delivery_events"])


BUILDERS: dict[str, Callable[..., DataFrame]] = {
    "customer_order_360": customer_order_360,
    "sales_by_product": sales_by_product,
    "customer_orders": customer_orders,
    "product_ratings": product_ratings,
    "delivery_status": delivery_status,
    "order_items_summary": order_items_summary,
    "order_products_summary": order_products_summary,
    "order_reviews_summary": order_reviews_summary,
    "delivery_summary": delivery_summary,
}

# The tables that are built from shared summaries, and which of them they need.
SUMMARIES_OF = {
    "customer_order_360": {"lines", "reviews", "delivery"},
    "delivery_status": {"delivery"},
    "order_items_summary": {"lines"},
    "order_products_summary": {"lines"},
    "order_reviews_summary": {"reviews"},
    "delivery_summary": {"delivery"},
}

# The five tables a pipeline run writes unless told otherwise.
CORE_TABLES = list(BUILDERS)[:5]

def sort_order(table: str) -> list[Column]:
    """Reading order of a Gold table, the key last so that it is total."""
    by = {
        "sales_by_product": ("revenue", "product_id"),
        "customer_orders": ("total_spent", "customer_id"),
        "product_ratings": ("average_rating", "product_id"),
        "delivery_status": ("last_event_timestamp", "order_id"),
    }
    if table not in by:
        return []
    value, key = by[table]
    return [F.col(value).desc_nulls_last(), F.col(key).asc()]


def present(table: str, df: DataFrame) -> DataFrame:
    order = sort_order(table)
    return df.orderBy(*order) if order else df


def build_gold(
    silver: Silver, tables: list[str] | None = None, summaries: Summaries | None = None
) -> dict[str, DataFrame]:
    """The tables by name; ``summaries``, if given, stand in for those of `order_summaries`."""
    require(silver, ENTITIES)
    return {
        name: BUILDERS[name](silver, summaries)
        if name in SUMMARIES_OF
        else BUILDERS[name](silver)
        for name in tables or CORE_TABLES
    }
