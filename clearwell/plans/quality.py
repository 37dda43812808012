"""Quality counters of the cleaned entities, one aggregation per entity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearwell.functions import vocab as V
from clearwell.operators.silver import REASON, require
from clearwell.plans.entities import ENTITIES


def _null(column: str) -> Column:
    return F.col(column).isNull()


def _null_or(column: str, bad: Column) -> Column:
    return _null(column) | bad


def _not_positive(column: str) -> Column:
    return _null_or(column, F.col(column) <= 0)


def _outside(column: str, low: int, high: int) -> Column:
    return _null_or(column, ~F.col(column).between(low, high))


def checks(entity: str, currencies: Sequence[str] | None = None) -> dict[str, Column]:
    """Counter name to "this row is bad" for one entity.

    With ``currencies``, orders also count amounts in any other currency.
    """
    if entity == "customers":
        return {
            "customer_id_null": _null("customer_id"),
            "email_null": _null("email"),
            "phone_invalid": _null_or("phone", ~F.col("phone").rlike(V.MOBILE_PATTERN)),
        }
    if entity == "orders":
        counters = {
            "order_id_null": _null("order_id"),
            "customer_id_null": _null("customer_id"),
            "total_amount_invalid": _null_or("total_amount", F.col("total_amount") < 0),
        }
        if currencies:
            counters["currency_outside_domain"] = ~F.col("currency").isin(
                list(currencies)
            )
        return counters
    if entity == "products":
        return {
            "product_id_null": _null("product_id"),
            "product_name_null": _null("product_name"),
            "current_price_invalid": _not_positive("current_price"),
        }
    if entity == "order_items":
        return {
            "order_id_null": _null("order_id"),
            "product_id_null": _null("product_id"),
            "quantity_invalid": _not_positive("quantity"),
            "unit_price_invalid": _not_positive("unit_price"),
            "discount_invalid": _outside("discount", 0, 1),
        }
    if entity == "reviews":
        return {
            "review_id_null": _null("_id"),
            "order_id_null": _null("orderId"),
            "rating_invalid": _outside("rating", 1, 5),
        }
    if entity == "delivery_events":
        return {
            "event_id_null": _null("event_id"),
            "order_id_null": _null("order_id"),
            "event_timestamp_null": _null("event_timestamp"),
            "event_type_unknown": _null_or(
                "event_type", F.col("event_type") == V.UNKNOWN_EVENT_TYPE
            ),
        }
    raise KeyError(entity)


def _long_form(
    counted: DataFrame, label: str, names: Sequence[str], value: str
) -> DataFrame:
    """One row of counts, a column each, to one row per count."""
    rows = F.array(
        *[F.struct(F.lit(n).alias(label), F.col(f"`{n}`").alias(value)) for n in names]
    )
    return counted.select(F.explode(rows).alias("r"), "n_rows").select("r.*", "n_rows")


def _count_each(df: DataFrame, bad: Mapping[str, Column]) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(condition).alias(name) for name, condition in bad.items()],
    )


def quality_of(
    df: DataFrame, entity: str, currencies: Sequence[str] | None = None
) -> DataFrame:
    """``entity, check_name, n_bad, n_rows`` for one cleaned entity."""
    bad = checks(entity, currencies)
    long = _long_form(_count_each(df, bad), "check_name", list(bad), "n_bad")
    return long.select(F.lit(entity).alias("entity"), "check_name", "n_bad", "n_rows")


def quality_report(
    silver: Mapping[str, DataFrame], currencies: Sequence[str] | None = None
) -> DataFrame:
    require(silver, ENTITIES)
    parts = [quality_of(silver[name], name, currencies) for name in ENTITIES]
    return reduce(DataFrame.unionByName, parts)


def null_profile(df: DataFrame) -> DataFrame:
    """``column_name, n_missing, n_rows``: NULL, or empty text in string columns."""
    bad = {}
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        missing = column.isNull()
        if isinstance(field.dataType, T.StringType):
            missing = missing | (column == "")
        bad[field.name] = missing
    if not bad:
        raise ValueError("the table has no columns")
    return _long_form(_count_each(df, bad), "column_name", list(bad), "n_missing")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, n_rows`` for every table, in one job."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def split_counts(tagged: Mapping[str, DataFrame]) -> DataFrame:
    """``entity, n_valid, n_rejected, n_rows``, one scan per entity."""
    parts = [
        df.agg(
            F.count_if(F.col(REASON).isNull()).alias("n_valid"),
            F.count_if(F.col(REASON).isNotNull()).alias("n_rejected"),
            F.count(F.lit(1)).alias("n_rows"),
        ).select(F.lit(name).alias("entity"), "n_valid", "n_rejected", "n_rows")
        for name, df in tagged.items()
    ]
    return reduce(DataFrame.unionByName, parts)
