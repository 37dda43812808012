"""How to divide a table scan: predicates that cover every row once and hold about equal rows.

A range between a least and a greatest value gives a task whatever lies in its part: one
heavy key or a gap in the keys makes a long task.  Here the bounds are quantiles of the key, so
parts are equally deep; a key that fills a part by itself gets a part of its own, which a
second column can divide further.
"""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _literal(value: object) -> str:
    """A value as SQL text that databases and Spark read alike."""
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, dt.date):
        return f"DATE '{value:%Y-%m-%d}'"
    if isinstance(value, bool) or not isinstance(value, (int, float, Decimal)):
        raise TypeError(f"no split by {type(value).__name__}")
    return str(value)


def _quantiles(rows: DataFrame, column: str, parts: int, accuracy: int) -> tuple[list, int, int]:
    """(the quantiles between ``parts`` parts, repeated where a value fills more, rows, nulls)."""
    kind = rows.schema[column].dataType
    if not isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise TypeError(f"{column} is {kind.simpleString()}: splits need numbers, dates or times")
    key = F.col(f"`{column}`")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        key = F.when(~F.isnan(key), key)  # beyond all numbers, so it falls to the last part
    marks = [i / parts for i in range(1, parts)]
    found = rows.agg(
        F.percentile_approx(key, marks, accuracy).alias("q") if marks else F.lit(None).alias("q"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(f"`{column}`").isNull()).alias("nulls"),
    ).head()
    return list(found["q"] or []), found["n"], found["nulls"]


def plan_splits(
    rows: DataFrame,
    column: str,
    parts: int,
    then: str | None = None,
    accuracy: int = 10_000,
    name: str | None = None,
) -> list[str]:
    """Predicates over ``column`` (written as ``name``) that hold every row exactly once.

    ``rows`` are the table or a sample of it; one aggregation reads them.  There are
    about ``parts`` predicates, none with many more than 1 / parts of the rows but for
    keys that have as many themselves.  Those stand alone, and with ``then``, a
    second column, they are divided by its quantiles into as many parts as they
    fill, at the cost of one more aggregation for each of them; there are fewer than
    ``parts``.  NULL keys are a part, heavy or not.  Without rows there is one
    predicate, which holds everything.
    """
    if parts < 1:
        raise ValueError("at least one part")
    name = name or column
    quantiles, n, nulls = _quantiles(rows, column, parts, accuracy)
    times = Counter(quantiles)
    # a value that is k quantiles fills k - 1 parts at least
    heavy = {v for v, k in times.items() if k > 1}
    bounds = sorted(times)
    predicates, low = [], None
    for b in bounds:
        above = [f"{name} >= {_literal(low)}"] if low is not None and low not in heavy else []
        above = [f"{name} > {_literal(low)}"] if low in heavy else above
        predicates.append(" AND ".join([*above, f"{name} < {_literal(b)}"]))
        if b in heavy:
            predicates += _divided(rows, column, b, times[b], then, accuracy, name)
        low = b
    if low is None:
        predicates.append(f"{name} IS NOT NULL" if nulls or not n else "1 = 1")
    else:
        predicates.append(f"{name} {'>' if low in heavy else '>='} {_literal(low)}")
    if predicates == ["1 = 1"]:
        return predicates
    return [*predicates, f"{name} IS NULL"]


def _divided(rows: DataFrame, column: str, value: object, parts: int, then: str | None, accuracy: int, name: str) -> list[str]:
    alone = f"{name} = {_literal(value)}"
    if then is None:
        return [alone]
    own = rows.where(F.col(f"`{column}`") == F.lit(value))
    return [f"{alone} AND ({p})" for p in plan_splits(own, then, parts, accuracy=accuracy)]
