"""Shared folder, label splits, connected components."""

from __future__ import annotations

import ctypes
import gc
import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.

    Where it is unset, a temporary one in a local session; on a cluster that is an error,
    since executors would not see each other's files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set")
        made = spark.sparkContext.getCheckpointDir()
        folder = made or "file://" + tempfile.mkdtemp(prefix="clearwell-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends there, lost executors cost nothing."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in short slices, so that few whole texts are Python objects at a time.

    When the task's rows end, what its worker has freed goes back to the machine.
    """
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def per_worker(kind: str, key: str, make: Callable[[], Any]) -> Any:
    """One object of a kind in a Python worker, kept from task to task while the key stays."""
    # this module is shipped by value, a copy a task, so what should outlive a task is kept
    # in a module of its own
    name = "clearwell_worker_objects"
    kept = sys.modules.setdefault(name, types.ModuleType(name)).__dict__
    if kept.get(kind, (None, None))[0] != key:
        kept[kind] = (key, make())
    return kept[kind][1]


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def labelled_sample(
    labels: DataFrame, label: str, folds: int, held_out: int, rows: int, id_col: str = "doc_id"
) -> DataFrame:
    """At most ``rows`` training rows, half of each class, chosen by hash of the id.

    Rows without id or label and rows of the held-out fold take no part; an id with
    contradicting labels counts as label 0.  Columns ``sample_id``, ``label``.
    """
    one = (
        labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull())
        .where(fold(F.col(id_col), folds) != held_out)
        .groupBy(F.col(id_col).alias("sample_id"))
        .agg(F.min(label).cast("int").alias("label"))
    )
    half = rows // 2
    count = {r["label"]: r["count"] for r in one.groupBy("label").count().collect()}
    draw = F.pmod(F.xxhash64("sample_id"), F.lit(1 << 30))
    parts = []
    for label_value in (0, 1):
        own = one.where(F.col("label") == label_value)
        if count.get(label_value, 0) > half:
            # a little over the share first, so that few rows meet to be cut to the bound
            share = 1.2 * half / count[label_value]
            own = own.where(draw < share * (1 << 30)).orderBy(draw, "sample_id").limit(half)
        parts.append(own)
    return parts[0].unionByName(parts[1])


def sampled_texts(docs: DataFrame, sample: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Texts of the sampled rows.  The sample has a row bound, so it may be broadcast."""
    return docs.select(F.col(id_col).alias("sample_id"), F.col(text_col).alias("text")).join(
        F.broadcast(sample), "sample_id"
    )


def _spelled(node: str) -> Column:
    # no attribute that a plan is partitioned by, so the join shuffles both sides itself
    return F.col(node).cast("string").cast("binary")


def join_summary(rows: DataFrame, key: str, summary: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``summary``, which has one row a ``key``; others are dropped.

    A summary is partitioned by its key already; by another spelling of it the join
    shuffles both sides itself, and Spark can split a key that many rows have.
    """
    spelled = summary.withColumn("_k", _spelled(key)).drop(key)
    return rows.join(spelled, _spelled(key) == F.col("_k")).drop("_k")


def _stars(edges: DataFrame, both_ways: bool) -> DataFrame:
    """One large-star (both ways) or small-star step over edges ``u > v``."""
    out = edges
    if both_ways:
        out = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = out.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    # minima have one row a node; shuffled for the join, they let Spark split a hub's edges
    minima = least.select(_spelled("u").alias("_k"), "m")
    seen = out.join(minima, _spelled("u") == F.col("_k"))
    if both_ways:
        new = seen.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        new = seen.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = new.unionByName(least.select("u", F.col("m").alias("v")))
    return new.where("u > v").distinct()


def _digest(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(h).alias("x")).head()
    return row["n"], row["x"]


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph by alternating large-star and small-star steps.

    ``edges`` has two columns of one orderable type.  Returns ``node``, ``component``
    (the least node of its component) for every node that has an edge to another one.
    Minima are combined before each shuffle and every step ends in a checkpoint; a hub
    meets the others in a plain shuffle join, whose large partitions Spark splits.
    Null ends and loops are ignored; repeated edges count once.
    """
    shared_dir(edges.sparkSession)
    u, v = edges.columns
    current = (
        edges.where(F.col(u).isNotNull() & F.col(v).isNotNull() & (F.col(u) != F.col(v)))
        .select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
        .distinct()
        .checkpoint()
    )
    before = _digest(current)
    while before[0]:
        current = _stars(_stars(current, True), False).checkpoint()
        after = _digest(current)
        if after == before:
            break
        before = after
    nodes = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)
