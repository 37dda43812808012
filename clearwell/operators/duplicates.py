"""Optional: one row a key.  The newest row stays, the others become rejects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DUPLICATE_KEY = "DUPLICATE_KEY"

# entity -> (key, columns by which a row is newer)
KEYS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "customers": (("customer_id",), ("created_at",)),
    "orders": (("order_id",), ("order_date",)),
    "products": (("product_id",), ()),
    "order_items": (("order_id", "product_id"), ()),
    "reviews": (("_id",), ("reviewDate",)),
    "delivery_events": (("event_id",), ("event_timestamp",)),
}


def _spelled(key: Sequence[str]) -> Column:
    """The key as one value that no plan is partitioned by, NULL if a part is."""
    whole = F.lit(True)
    for k in key:
        whole = whole & F.col(k).isNotNull()
    return F.when(whole, F.array(*[F.col(k).cast("string").cast("binary") for k in key]))


def tag_duplicates(stored: DataFrame, key: Sequence[str], recency: Sequence[str], flag: str) -> DataFrame:
    """The rows with the boolean ``flag``: true for all but the newest row of a key.

    ``stored`` is a Parquet table as read: a row's file and place tell equal copies
    apart, the same way whenever a task runs again.  Of rows equally new the greatest
    in column order stays.  A key with a NULL part has no duplicates.

    The newest row is found with combining before the shuffle; the rows then meet one
    row a key in a join whose heavy keys Spark can split.  The join sorts by a number of the
    key first: ids start alike, and numbers differ at once.
    """
    place = F.struct("_metadata.file_path", "_metadata.row_index").alias("_place")
    rows = stored.select("*", place)
    others = [c for c in stored.columns if c not in recency]
    age = F.struct(*recency, *others, "_place")
    newest = (
        rows.where(_spelled(key).isNotNull())
        .groupBy(*key)
        .agg(F.max(age).alias("_newest"))
        .select(
            F.xxhash64(_spelled(key)).alias("_key_number"),
            _spelled(key).alias("_key"),
            F.col("_newest._place").alias("_kept"),
        )
    )
    same = (F.xxhash64(_spelled(key)) == F.col("_key_number")) & (_spelled(key) == F.col("_key"))
    joined = rows.join(newest, same, "left")
    duplicate = F.col("_kept").isNotNull() & (F.col("_kept") != F.col("_place"))
    return joined.select(*stored.columns, duplicate.alias(flag))
