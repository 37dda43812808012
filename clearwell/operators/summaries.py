"""Per-key summaries that the business tables are assembled from.

Each has one row per key, and each is a plain aggregation: map tasks combine
first, so a key that holds a third of the rows reaches its reducer as one
partial result per map task.  Distinct values are rows before they are counted or
listed, (order, value) by (order, value) and spread by both, so that no task holds
the values of a heavy order as a set; a list is built from rows that are distinct.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from clearwell.functions import vocab as V
from clearwell.operators import joins


def line_amounts() -> dict[str, Column]:
    """Gross, discount and net of a line, each rounded to cents on its own."""
    gross = F.col("quantity") * F.col("unit_price")
    return {
        "gross_amount": gross.cast(V.LINE_AMOUNT),
        "discount_amount": (gross * F.col("discount")).cast(V.LINE_AMOUNT),
        "net_amount": (gross * (F.lit(1) - F.col("discount"))).cast(V.LINE_AMOUNT),
    }


def total(column: str) -> Column:
    return F.sum(column).cast(V.TOTAL_AMOUNT)


def label(column: str, fallback: str) -> Column:
    return F.coalesce(F.col(column), F.lit(fallback))


def product_labels() -> list[Column]:
    """Display name, category and brand, with fallbacks for what is missing."""
    return [
        label("product_name", V.NO_PRODUCT_NAME).alias("product_name"),
        label("category", V.UNKNOWN_F).alias("category"),
        label("brand", V.UNKNOWN_F).alias("brand"),
    ]


def rating_columns(id_column: str) -> list[Column]:
    return [
        F.avg("rating").cast(V.RATING).alias("average_rating"),
        F.count(id_column).alias("number_of_reviews"),
        F.count_if("verifiedPurchase").alias("verified_reviews"),
    ]


# --- order lines -------------------------------------------------------------------


def _lines(order_items: DataFrame) -> DataFrame:
    amounts = [c.alias(n) for n, c in line_amounts().items()]
    return order_items.select("order_id", "product_id", "quantity", *amounts)


def _items_columns() -> list[Column]:
    return [
        F.count_distinct("product_id").alias("number_of_products"),
        F.sum("quantity").alias("total_quantity"),
        total("gross_amount").alias("gross_amount"),
        total("discount_amount").alias("discount_amount"),
        total("net_amount").alias("net_amount"),
    ]


def order_items_summary(order_items: DataFrame) -> DataFrame:
    return _lines(order_items).groupBy("order_id").agg(*_items_columns())


def labels_per_product(products: DataFrame) -> DataFrame:
    """One row per product id with the sets of labels its rows carry.

    Products are not deduplicated, so an id may have several names.
    """
    return (
        products.select("product_id", *product_labels())
        .groupBy("product_id")
        .agg(
            F.collect_set("product_name").alias("names"),
            F.collect_set("category").alias("categories"),
            F.collect_set("brand").alias("brands"),
        )
    )


# field of a label set -> (label of a line, its value where the product is not known)
_LABEL_SETS = {
    "names": ("name", V.NO_PRODUCT_NAME),
    "categories": ("category", V.UNKNOWN_F),
    "brands": ("brand", V.UNKNOWN_F),
}
_LABELS = [label for label, _ in _LABEL_SETS.values()]
_SUMS = ("quantity", "gross_amount", "discount_amount", "net_amount")
_NUMBER = "_number"
_PRODUCT, *_LABEL_KINDS = range(1 + len(_LABEL_SETS))


def _entry(kind: int, value: Column, labels: dict[str, Column]) -> Column:
    listed = [labels.get(n, F.lit(None).cast("string")).alias(n) for n in _LABELS]
    return F.struct(F.lit(kind).alias("kind"), value.alias("value"), *listed)


def _further(kind: int, label: str) -> Callable[[Column], Column]:
    return lambda value: _entry(kind, value, {label: value})


def _entries_per_product(products: DataFrame) -> DataFrame:
    """One row per product id with what an order gets from it, an array of `_entry`.

    The first is the product itself with its first name, category and brand.  Only a product
    with several labels of a kind has more, one for each further label.  The sets are
    sorted, so that every task sees the same first label.
    """
    sets = labels_per_product(products).withColumns({field: F.sort_array(field) for field in _LABEL_SETS})
    first = {label: F.get(field, F.lit(0)) for field, (label, _) in _LABEL_SETS.items()}
    entries = [F.array(_entry(_PRODUCT, F.col("product_id"), first))]
    for kind, (field, (label, _)) in zip(_LABEL_KINDS, _LABEL_SETS.items(), strict=True):
        entries.append(F.transform(F.slice(field, F.lit(2), F.size(field)), _further(kind, label)))
    return sets.select("product_id", F.concat(*entries).alias("entries"))


def _labelled_lines(order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Each line beside the entries of its product; a hot product is split by Spark.

    Amounts are worked out behind the join, which is narrower without them.
    """
    lines = order_items.select("order_id", "product_id", "quantity", "unit_price", "discount")
    joined = joins.left_join_summary(lines, "product_id", _entries_per_product(products), "_known")
    unknown = {label: F.lit(value) for label, value in _LABEL_SETS.values()}
    alone = F.array(_entry(_PRODUCT, F.col("product_id"), unknown))
    return joined.withColumns(line_amounts() | {"entries": F.coalesce(F.col("_known.entries"), alone)})


def _distinct_values(lines: DataFrame, sums: bool) -> DataFrame:
    """``order_id, kind, value`` once each: its products, and what other labels these have.

    With ``sums`` a product's row carries those of the order's lines of that product.
    """
    amounts = [c for c in _SUMS if sums]
    rows = lines.select("order_id", *amounts, F.inline("entries"))
    if not sums:
        return rows.distinct()
    own = F.col("kind") == _PRODUCT
    # the labels belong to (kind, value), so they split no group
    return rows.groupBy("order_id", "kind", "value", *_LABELS).agg(*[F.sum(F.when(own, F.col(c))).alias(c) for c in _SUMS])


def _per_order(values: DataFrame) -> GroupedData:
    """Distinct rows meet by order and are listed there, without lists of map tasks before.

    Lists are made by sorting.  Ids start alike; a number before them decides most comparisons.
    """
    return values.repartition("order_id").groupBy(F.xxhash64("order_id").alias(_NUMBER), "order_id")


def _list_columns() -> list[Column]:
    return [F.collect_list(label).alias(f"_{field}") for field, (label, _) in _LABEL_SETS.items()]


def _with_products_columns(grouped: DataFrame) -> DataFrame:
    # several products may share a label
    lists = {f"_{field}": F.sort_array(F.array_distinct(f"_{field}")) for field in _LABEL_SETS}
    columns = {
        "product_names": F.concat_ws(", ", "_names"),
        "categories": F.concat_ws(", ", "_categories"),
        "brands": F.concat_ws(", ", "_brands"),
        "number_of_categories": F.size("_categories").cast("bigint"),
    }
    return grouped.withColumns(lists).withColumns(columns).drop(*lists)


def order_products_summary(order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Sorted, comma-joined product names, categories and brands of each order."""
    values = _distinct_values(_labelled_lines(order_items, products), sums=False)
    return _with_products_columns(_per_order(values).agg(*_list_columns()).drop(_NUMBER))


def order_lines_summary(order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Amounts and product lists together, from one pass over the lines.

    The lines meet the products first; the distinct products of an order, with their
    sums and labels, are one aggregation, and one by order follows.
    """
    values = _distinct_values(_labelled_lines(order_items, products), sums=True)
    return _with_products_columns(
        _per_order(values)
        .agg(
            F.count(F.when(F.col("kind") == _PRODUCT, F.col("value"))).alias("number_of_products"),
            F.sum("quantity").alias("total_quantity"),
            total("gross_amount").alias("gross_amount"),
            total("discount_amount").alias("discount_amount"),
            total("net_amount").alias("net_amount"),
            *_list_columns(),
        )
        .drop(_NUMBER)
    )


# --- reviews --------------------------------------------------------------------------


def order_reviews_summary(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy(F.col("orderId").alias("order_id")).agg(
        *rating_columns("_id")
    )


# --- delivery events ------------------------------------------------------------------


def _event_payload() -> list[Column]:
    return [
        F.col("event_type").alias("last_delivery_status"),
        F.col("location.city").alias("last_city"),
        F.col("location.country").alias("last_country"),
        F.col("carrier.id").alias("carrier_id"),
        F.col("carrier.name").alias("carrier_name"),
    ]


def delivery_summary(events: DataFrame) -> DataFrame:
    """First and last event, milestones and count per order, in one aggregation.

    The last event is the greatest (timestamp, event id); the payload follows in
    the same struct, so equal pairs are broken the same way on every run.
    """
    moment = F.col("event_timestamp")
    kind = F.col("event_type")
    last = F.struct(moment.alias("ts"), F.col("event_id"), *_event_payload())
    return (
        events.groupBy("order_id")
        .agg(
            F.min(moment).alias("first_event_timestamp"),
            F.count(F.lit(1)).alias("number_of_events"),
            F.min(F.when(kind.isin(V.IN_DELIVERY_TYPES), moment)).alias(
                "shipping_date"
            ),
            F.min(F.when(kind == "DELIVERED", moment)).alias("delivery_date"),
            F.max(last).alias("last"),
        )
        .select(
            "order_id",
            "first_event_timestamp",
            "number_of_events",
            "shipping_date",
            "delivery_date",
            F.col("last.ts").alias("last_event_timestamp"),
            "last.last_delivery_status",
            "last.last_city",
            "last.last_country",
            "last.carrier_id",
            "last.carrier_name",
        )
    )


def latest_event(events: DataFrame) -> DataFrame:
    """The last event of each order by ranking.

    Spark limits each key to its best row before the shuffle as well, so a busy
    order costs one row per map task.
    """
    newest_first = Window.partitionBy("order_id").orderBy(
        F.col("event_timestamp").desc_nulls_last(),
        F.col("event_id").desc_nulls_last(),
        *[F.col(c).desc() for c in ("event_type", "location", "carrier")],
    )
    return (
        events.withColumn("_rank", F.row_number().over(newest_first))
        .where("_rank = 1")
        .select(
            "order_id",
            F.col("event_timestamp").alias("last_event_timestamp"),
            *_event_payload(),
        )
    )
