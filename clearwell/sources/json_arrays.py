"""Multi-line JSON read by many tasks: files are cut at their top-level elements.

Spark gives a multi-line file to one task, since a byte in the middle does not tell
whether it stands in a string or how deep.  Both can be summed up, though: a block of
bytes turns "inside a string" over by its number of quotes, and changes the depth by a
number that depends on where it starts alone.  So one pass over all blocks finds these
numbers, a running sum gives the state at the start of each block, and a second pass
cuts every block at its element boundaries, on its own.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearwell.operators.silver import MALFORMED

BOM = b"\xef\xbb\xbf"
_BLANK = b" \t\r\n"
_QUOTE, _ESCAPE, _COMMA = ord('"'), ord("\\"), ord(",")
_DEPTH = np.zeros(256, dtype=np.int64)
_DEPTH[[ord("["), ord("{")]] = 1
_DEPTH[[ord("]"), ord("}")]] = -1


class State(NamedTuple):
    """What is known where a block starts; ``cut``: the file's last brace is not its own."""

    file: int
    start: int
    inside: bool
    depth: int
    array: bool
    last: bool
    cut: bool | None


def _strings(data: np.ndarray) -> np.ndarray:
    """How many string quotes have come, up to and with each byte.

    A quote after an odd number of backslashes is part of a string.  The byte before the
    data is no backslash.
    """
    quotes = data == _QUOTE
    escapes = data == _ESCAPE
    if escapes.any():
        place = np.arange(len(data))
        plain = np.maximum.accumulate(np.where(escapes, -1, place))
        at = np.flatnonzero(quotes[1:]) + 1
        run = at - 1 - plain[at - 1]
        quotes[at[run % 2 == 1]] = False
    return np.cumsum(quotes)


def summed(data: np.ndarray) -> tuple[int, int, int]:
    """(quotes, change of depth if the data starts outside a string, and if inside)."""
    quotes = _strings(data)
    step = _DEPTH[data]
    odd = (quotes & 1).astype(bool)
    return int(quotes[-1]) if len(quotes) else 0, int(step[~odd].sum()), int(step[odd].sum())


def boundaries(data: np.ndarray, inside: bool, depth: int, array: bool) -> tuple[np.ndarray, bool, int]:
    """(places of the bytes that end an element, state and depth after the data)."""
    quotes = _strings(data)
    outside = ((quotes + inside) & 1) == 0
    places = np.flatnonzero(outside & ((_DEPTH[data] != 0) | (data == _COMMA)))
    step = _DEPTH[data[places]]
    after = depth + np.cumsum(step)
    if array:
        # "[" that opens the array, commas in it, "]" that closes it
        ends = ((after == 1) & (step >= 0) & (data[places] != ord("{"))) | ((after == 0) & (step < 0))
    else:
        ends = (after == 0) & (step < 0)
    inside = bool((int(quotes[-1]) + inside) & 1) if len(quotes) else inside
    return places[ends], inside, int(after[-1]) if len(after) else depth


def _chunks(spark: SparkSession, path: str | list[str], recursive: bool, glob: str) -> DataFrame:
    """The files as text rows that end with a closing brace, which Spark can split anywhere."""
    reader = spark.read.options(lineSep="}", pathGlobFilter=glob, recursiveFileLookup=recursive)
    meta = F.col("_metadata")
    return reader.text(path).select(
        F.col("value").cast("binary").alias("value"),
        F.xxhash64(meta["file_path"]).alias("file"),
        meta["file_block_start"].alias("start"),
        meta["file_size"].alias("size"),
    )


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int, int], bytes]]:
    """((file, start, size), bytes) of the rows of each block in the batch, in order."""
    keys = [batch.column(i).to_numpy() for i in (1, 2, 3)]
    turns = np.flatnonzero((np.diff(keys[0]) != 0) | (np.diff(keys[1]) != 0)) + 1
    for a, b in zip([0, *turns.tolist()], [*turns.tolist(), batch.num_rows], strict=True):
        if a < b:
            values = batch.column(0).slice(a, b - a).to_pylist()
            yield tuple(int(k[a]) for k in keys), b"}".join(values) + b"}"


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["file", "start", "size", "bytes", "quotes", "outside", "inside", "first"]
    blocks: dict[tuple[int, int, int], list[int]] = {}
    for batch in batches:
        for key, data in _blocks(batch):
            own = blocks.setdefault(key, [0, 0, 0, 0, -1])
            quotes, outside, inside = summed(np.frombuffer(data, dtype=np.uint8))
            odd = own[1] & 1
            own[0] += len(data)
            own[1] += quotes
            own[2] += inside if odd else outside
            own[3] += outside if odd else inside
            if own[4] < 0 and key[1] == 0:
                head = data.removeprefix(BOM).lstrip(_BLANK)
                own[4] = head[0] if head else -1
    rows = [[*key, *own] for key, own in blocks.items()]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names)


def _states(chunks: DataFrame) -> list[State]:
    """The state at the start of every block: one small row a block of a file."""
    kinds = "file long, start long, size long, bytes long, quotes long, outside long, inside long, first long"
    found = chunks.mapInArrow(_summaries, kinds)
    line = Window.partitionBy("file").orderBy("start")
    before, whole = line.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("file")
    states = (
        found.withColumn("odd", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
        .withColumn("change", F.when(F.col("odd"), F.col("inside")).otherwise(F.col("outside")))
        .select(
            "file",
            "start",
            F.col("odd").alias("inside"),
            F.coalesce(F.sum("change").over(before), F.lit(0)).alias("depth"),
            (F.max("first").over(whole) == ord("[")).alias("array"),
            (F.col("start") == F.max("start").over(whole)).alias("last"),
            (F.sum("bytes").over(whole) - F.col("size")).alias("over"),
        )
    )
    # the text has one brace more than the file if it does not end with one; a
    # compressed file's size does not tell
    cut = {0: False, 1: True}
    return [State(*r[:6], cut.get(r["over"])) for r in states.collect()]


def _cutter(states: dict[tuple[int, int], State]):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["value", "file", "start", "part", "closer"]
        now: State | None = None
        inside, depth, pending, first = False, 0, b"", True

        def ended() -> list[tuple]:
            """The rest of a block, which the next one of its file goes on with."""
            rest = pending
            if now.last and rest.endswith(b"}") and (now.cut or now.cut is None and depth != int(now.array)):
                rest = rest[:-1]
            return [(rest, now.file, now.start, int(not first), None)]

        for batch in batches:
            rows: list[tuple] = []
            for (file, start, _), data in _blocks(batch):
                if now is None or (file, start) != (now.file, now.start):
                    if now is not None:
                        rows += ended()
                    if (file, start) not in states:
                        raise RuntimeError("the files or their splits changed between two reads; read again")
                    now = states[file, start]
                    inside, depth, pending, first = now.inside, now.depth, b"", True
                    if start == 0:
                        data = data.removeprefix(BOM)
                ends, inside, depth = boundaries(np.frombuffer(data, dtype=np.uint8), inside, depth, now.array)
                begin = 0
                for end in ends.tolist():
                    text = pending + data[begin : end + (not now.array)]
                    closer = data[end : end + 1]
                    if first:
                        rows.append((text, file, start, 0, closer.decode()))
                    else:
                        text = text.strip(_BLANK)
                        if text or closer == b",":
                            rows.append((text, None, None, None, None))
                    pending, begin, first = b"", end + 1, False
                pending += data[begin:]
            if rows:
                yield _batch(rows, names)
        if now is not None:
            yield _batch(ended(), names)

    return cut


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def json_elements(
    spark: SparkSession, path: str | list[str], staging: str, recursive: bool = False, glob: str = "*.json"
) -> DataFrame:
    """The top-level elements of JSON files as texts, column ``value``.

    A file whose first character is ``[`` holds arrays, whose elements are taken; any
    other file holds documents one after the other, each one an element.  Elements may
    hold braces in strings and escaped quotes, and lie across blocks of a file.  A file is
    read by as many tasks as it has splits; texts end at closing braces, so a
    file without any is one row.  Elements are written once, under ``staging``.

    What stands outside arrays, an empty element between commas and the rest of a
    file that breaks off are elements as well, so that no text is lost; a missing or
    surplus bracket makes one element of what follows it.
    """
    chunks = _chunks(spark, path, recursive, glob)
    known = {(s.file, s.start): s for s in _states(chunks)}
    pieces = chunks.mapInArrow(_cutter(known), "value binary, file long, start long, part long, closer string")
    pieces.write.parquet(staging)
    stored = spark.read.schema(pieces.schema).parquet(staging)
    ends = stored.where("part IS NOT NULL")
    line = Window.partitionBy("file").orderBy("start", "part")
    closed = F.count("closer").over(line.rowsBetween(Window.unboundedPreceding, -1))
    whole = (
        ends.withColumn("element", closed)
        .groupBy("file", "element")
        .agg(
            F.array_sort(F.collect_list(F.struct("start", "part", "value"))).alias("parts"),
            F.max("closer").alias("closer"),
        )
        .select(
            F.trim(_joined(F.col("parts")), F.lit(" \t\r\n")).alias("value"),
            F.col("closer"),
        )
        .where((F.col("value") != "") | (F.col("closer") == ","))
    )
    inner = stored.where("part IS NULL").select(F.col("value").cast("string").alias("value"))
    return inner.unionByName(whole.select("value"))


def _joined(parts: Column) -> Column:
    # bytes first: a block may end within a character
    return F.unhex(F.array_join(F.transform(parts, lambda p: F.hex(p["value"])), "")).cast("string")


def inferred_schema(elements: DataFrame) -> T.StructType:
    """The merged type of all elements that are objects; conflicting types become text."""
    value = F.try_parse_json("value")
    objects = elements.where(F.schema_of_variant(value).startswith("OBJECT"))
    found = objects.agg(F.schema_of_variant_agg(value).alias("s")).head()["s"] or "VOID"
    parts = re.split(r"(`(?:[^`]|``)*`)", found)
    for i in range(0, len(parts), 2):
        parts[i] = re.sub(r"\bOBJECT<", "STRUCT<", parts[i])
        parts[i] = re.sub(r"\b(VOID|VARIANT)\b", "STRING", parts[i])
    kind = T.StructType.fromDDL(f"s {''.join(parts)}").fields[0].dataType
    return kind if isinstance(kind, T.StructType) else T.StructType()


def parsed(texts: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """JSON texts as rows of the schema, and `MALFORMED`: the text that is no JSON object.

    An object with a value of another type than declared is read without that value.
    """
    with_text = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    rows = texts.select(F.from_json(column, with_text, options).alias("r"), F.col(column).alias("t"))
    fields = [F.col("r").getField(f.name).alias(f.name) for f in schema.fields]
    return rows.select(*fields, unreadable(F.col("r").getField(MALFORMED), F.col("t")).alias(MALFORMED))


def unreadable(corrupt: Column, text: Column) -> Column:
    """The text, if it is empty or was reported corrupt and is no JSON object; else NULL."""
    value = F.try_parse_json(text)
    is_object = F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))
    return F.when(corrupt.isNotNull() & ~is_object | (F.trim(text) == ""), text)


# what runs in workers is shipped by value, so they need no copy of this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])
