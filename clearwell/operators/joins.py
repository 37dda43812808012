"""Left joins with per-key summaries that stay balanced under heavy keys.

Adaptive execution splits a skewed join partition only where both inputs come
straight from a shuffle that the join itself asked for.  A summary is partitioned by
its key already, so a join by that key would read it in place and leave a heavy key
of the other side in one task.  Here the join goes by another spelling of the key:
the summary, one row a key, is shuffled once more, and Spark can split any heavy key
of the left side, however many there are and however large the input is.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _spelled(key: str) -> Column:
    # equal exactly where the texts are equal, and no attribute that a plan is partitioned by
    return F.col(key).cast("binary")


def left_join_summary(left: DataFrame, key: str, summary: DataFrame, name: str) -> DataFrame:
    """``left`` with the matching summary row as struct ``name``, NULL where there is none.

    ``summary`` has at most one row per ``key``, a text column of both sides.  Both are sorted
    by a number of the key first, which compares faster than ids that start alike.
    """
    match, number = "_spelled_key", "_key_number"
    right = summary.select(
        F.xxhash64(_spelled(key)).alias(number),
        _spelled(key).alias(match),
        F.struct(*summary.columns).alias(name),
    )
    same = (F.xxhash64(_spelled(key)) == F.col(number)) & (_spelled(key) == F.col(match))
    return left.join(right, same, "left").drop(match, number)


def combined(key: str, summaries: Mapping[str, DataFrame]) -> DataFrame:
    """One row per key with each summary's row as a struct column, NULL where it has none.

    All summaries are partitioned by the key, and at most one row of each meets here.
    """
    rows = [s.select(key, F.struct(*s.columns).alias(n)) for n, s in summaries.items()]
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return together.groupBy(key).agg(
        *[F.first(n, ignorenulls=True).alias(n) for n in summaries]
    )
