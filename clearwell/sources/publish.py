"""Publish all tables of a run at once.

A run writes into a folder of its own, which no reader knows.  When everything is there,
one small manifest file with the next number appears; readers take the manifest with
the greatest number and find that run's folder in it.  So a run that fails, at
whatever point, leaves what readers see as it was, and a reader never sees tables of
two runs.  Nothing is overwritten.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any, TypeVar
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from clearwell.sources import sinks

Result = TypeVar("Result")
MANIFESTS, VERSIONS = "manifests", "versions"


class PublishConflict(RuntimeError):
    """Another run published meanwhile; this run's folder is not visible."""


@dataclass(frozen=True)
class Version:
    """A published run: its number, the folder of its tables and what the run noted."""

    number: int
    folder: str
    notes: dict[str, Any] = field(default_factory=dict)

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        """A table of this version, by its path below the folder."""
        return spark.read.parquet(f"{self.folder}/{name}")


def _path(spark: SparkSession, path: str):
    """(file system, path) of the session's Hadoop configuration: HDFS, an object store, a disk."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, folder: str) -> dict[str, int]:
    """Names in a folder, with the time of their last change in seconds; none if it is not there."""
    fs, place = _path(spark, folder)
    if not fs.exists(place):
        return {}
    return {s.getPath().getName(): s.getModificationTime() / 1000 for s in fs.listStatus(place)}


def _read(spark: SparkSession, path: str) -> str:
    fs, place = _path(spark, path)
    stream = fs.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _numbers(spark: SparkSession, base: str) -> list[int]:
    names = _names(spark, f"{base}/{MANIFESTS}")
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _manifest(base: str, number: int) -> str:
    return f"{base}/{MANIFESTS}/{number:012d}.json"


def version(spark: SparkSession, base: str, number: int) -> Version:
    content = json.loads(_read(spark, _manifest(base, number)))
    return Version(number, f"{base}/{VERSIONS}/{content['folder']}", content["notes"])


def current(spark: SparkSession, base: str) -> Version | None:
    """The version published last, or None."""
    numbers = _numbers(spark, base)
    return version(spark, base, numbers[-1]) if numbers else None


def _switch(spark: SparkSession, base: str, number: int, content: dict[str, Any]) -> None:
    """Make the manifest appear whole, or fail if that number is taken."""
    fs, hidden = _path(spark, f"{base}/{MANIFESTS}/_{uuid4().hex}")
    stream = fs.create(hidden)
    try:
        stream.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    finally:
        stream.close()
    _, place = _path(spark, _manifest(base, number))
    if fs.exists(place) or not fs.rename(hidden, place):
        fs.delete(hidden, False)
        raise PublishConflict(f"version {number} of {base} exists already")


def publish(
    spark: SparkSession,
    base: str,
    write: Callable[[str], Result],
    notes: Callable[[Result], dict[str, Any]] | None = None,
    allow_local: bool = False,
) -> tuple[Version, Result]:
    """Run ``write`` with a new folder and publish it when it returns.

    ``notes`` turns its result into what the manifest tells readers, row counts say.  If
    ``write`` fails, its error goes on and the version published before stays; so it
    does if another run published in between, since this one has not seen its tables.
    """
    base = sinks.check_shared(spark, base, allow_local).rstrip("/")
    before = _numbers(spark, base)
    number = before[-1] + 1 if before else 1
    folder = f"{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{uuid4().hex}"
    result = write(f"{base}/{VERSIONS}/{folder}")
    noted = notes(result) if notes else {}
    if _numbers(spark, base) != before:
        raise PublishConflict(f"another run published to {base}")
    _switch(spark, base, number, {"folder": folder, "notes": noted})
    return Version(number, f"{base}/{VERSIONS}/{folder}", noted), result


def prune(spark: SparkSession, base: str, keep: int = 2, abandoned_hours: float = 24.0) -> list[str]:
    """Remove all but the newest ``keep`` versions; returns the folders removed.

    Manifests go before their folders.  A folder without a manifest is a run that
    failed or still writes, and goes once it has not changed for ``abandoned_hours``.
    """
    if keep < 1:
        raise ValueError("the current version stays")
    base = base.rstrip("/")
    numbers = _numbers(spark, base)
    kept = {version(spark, base, n).folder for n in numbers[-keep:]}
    listed = {version(spark, base, n).folder for n in numbers}
    for number in numbers[:-keep]:
        fs, place = _path(spark, _manifest(base, number))
        fs.delete(place, False)
    removed = []
    for name, changed in sorted(_names(spark, f"{base}/{VERSIONS}").items()):
        folder = f"{base}/{VERSIONS}/{name}"
        old = time.time() - changed >= abandoned_hours * 3600
        if folder not in kept and (folder in listed or old):
            fs, place = _path(spark, folder)
            fs.delete(place, True)
            removed.append(folder)
    return removed
