"""Rejected rows as one standard envelope, and their summary by reason."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearwell.functions import vocab as V
from clearwell.operators.silver import MALFORMED, RAW, REASON

ENVELOPE = ["source", REASON, "rejection_timestamp", "original_data"]


def envelope(df: DataFrame, source: str, payload: str = "raw") -> DataFrame:
    """``source, rejection_reason, rejection_timestamp, original_data`` first.

    ``payload="raw"`` writes the row as it was read, NULL fields included, when
    the rejects were tagged with ``keep_raw``; ``payload="cleaned"`` writes the
    cleaned row and leaves NULL fields out.  A malformed record's payload is its text.
    """
    if payload not in ("raw", "cleaned"):
        raise ValueError(f"payload must be 'raw' or 'cleaned', not {payload!r}")
    data = [c for c in df.columns if c not in (*ENVELOPE, RAW, MALFORMED)]
    if REASON in df.columns:
        stated = F.col(REASON).cast("string")
        reason = F.when(F.trim(stated) != "", stated).otherwise(V.NO_REASON)
    else:
        reason = F.lit(V.NO_REASON)
    if payload == "raw" and RAW in df.columns:
        original = F.to_json(RAW, {"ignoreNullFields": "false"})
    elif data:
        original = F.to_json(F.struct(*data))
    else:
        original = F.lit("{}")
    if MALFORMED in df.columns:
        original = F.coalesce(MALFORMED, original)
    return df.select(
        F.lit(source).alias("source"),
        reason.alias(REASON),
        F.current_timestamp().alias("rejection_timestamp"),
        original.alias("original_data"),
        *data,
    )


def summary(tagged: Mapping[str, DataFrame]) -> DataFrame:
    """Rejected rows per source and reason, all sources in one table."""
    parts = [
        df.where(F.col(REASON).isNotNull())
        .groupBy(F.lit(name).alias("source"), REASON)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        for name, df in tagged.items()
    ]
    return reduce(DataFrame.unionByName, parts)
