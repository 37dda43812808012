"""Parquet sinks.  Each table is one write job; its row count comes with it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clearwell.operators import rejects


def shared_dir(spark: SparkSession, default: str | None = None) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    ``default`` is used only where the session names none.
    """
    path = spark.conf.get("spark.checkpoint.dir", default)
    if not path:
        raise ValueError("spark.checkpoint.dir is not set")
    return path.rstrip("/")


def check_shared(spark: SparkSession, path: str, allow_local: bool = False) -> str:
    """The path; an error if it is on one machine's disk while the session is a cluster's.

    ``allow_local`` is for a disk that is mounted on every machine.  A folder in the
    session's ``spark.checkpoint.dir`` is shared by definition.
    """
    shared = str(spark.conf.get("spark.checkpoint.dir", "") or "").rstrip("/")
    if shared and ".." not in path.split("/") and f"{path.rstrip('/')}/".startswith(f"{shared}/"):
        return path
    scheme = path.partition(":")[0] if "://" in path or path.startswith("file:") else ""
    cluster = not spark.sparkContext.master.startswith("local")
    if cluster and scheme in ("", "file") and not allow_local:
        default = str(spark.conf.get("spark.hadoop.fs.defaultFS", "") or "")
        if scheme == "file" or default in ("", "file:///"):
            raise ValueError(f"{path} may be local to one machine; allow_local=True accepts it")
    return path


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> int:
    """Write and return the number of rows, counted by the write itself."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("n_rows"))
    writer = counted.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return seen.get.get("n_rows", 0)


def write_tables(tables: Mapping[str, DataFrame], base: str) -> dict[str, int]:
    """One directory per table under ``base``; rows written by table name."""
    return {name: write_table(df, f"{base}/{name}") for name, df in tables.items()}


def stage_tables(tables: Mapping[str, DataFrame], base: str) -> dict[str, DataFrame]:
    """Write the tables and return them as read back, so what follows starts from files."""
    stored = {}
    for name, df in tables.items():
        df.write.parquet(f"{base}/{name}")
        stored[name] = df.sparkSession.read.schema(df.schema).parquet(f"{base}/{name}")
    return stored


def write_rejects(
    rejected: Mapping[str, DataFrame], base: str, payload: str = "raw"
) -> dict[str, int]:
    return write_tables(
        {
            name: rejects.envelope(df, name, payload)
            for name, df in rejected.items()
        },
        base,
    )
