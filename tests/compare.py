"""Run a registered query and its SQL check side by side."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _key(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return f"{type(value).__name__}:{value!r}"


def rows(columns: list[str], data: list) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(_key(row[i]) for i in order) for row in data)


def compare(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """None if columns and all rows agree, else what differs first."""
    df = query(spark, sf_dir)
    got = rows(df.columns, df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)} rows"
    for a, b in zip(got, want, strict=True):
        if a != b:
            pairs = zip(sorted(names), a, b, strict=True)
            return "; ".join(f"{n}: {x} != {y}" for n, x, y in pairs if x != y)
    return None
