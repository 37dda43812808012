"""Schema drift: what the data holds against what was declared."""

from __future__ import annotations

import json
import sys
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MISSING, UNEXPECTED, DIFFERS, MALFORMED = "missing", "unexpected", "type_differs", "malformed"

# JSON types that a declared type accepts without drift.
_ACCEPTED = {
    "string": {"string"},
    "date": {"string"},
    "timestamp": {"string"},
    "timestamp_ntz": {"string"},
    "binary": {"string"},
    "boolean": {"boolean"},
    "float": {"bigint", "double"},
    "double": {"bigint", "double"},
    "decimal": {"bigint", "double"},
    "tinyint": {"bigint"},
    "smallint": {"bigint"},
    "int": {"bigint"},
    "bigint": {"bigint"},
    "struct": {"struct"},
    "map": {"struct"},
    "array": {"array"},
}


def _step(name: str) -> str:
    """A field name as a path step; names with special characters are quoted."""
    return "`" + name.replace("`", "``") + "`" if set(name) & set(".[]`") or not name else name


def _leaves(kind: T.DataType, path: str = "") -> dict[str, str]:
    """Path to type name at every depth; ``[]`` stands for the elements of an array.

    What a map holds is data, not schema, so its entries are no paths.
    """
    found: dict[str, str] = {}
    if isinstance(kind, T.StructType):
        if path:
            found[path] = "struct"
        for f in kind.fields:
            found |= _leaves(f.dataType, f"{path}.{_step(f.name)}" if path else _step(f.name))
    elif isinstance(kind, T.ArrayType):
        found[path] = "array"
        found |= _leaves(kind.elementType, f"{path}[]")
    else:
        found[path] = kind.simpleString()
    return found


def schema_diff(
    spark: SparkSession, actual: T.StructType, expected: T.StructType
) -> DataFrame:
    """``field, kind, expected, actual`` for every difference; field order is ignored."""
    have, want = _leaves(actual), _leaves(expected)
    rows = []
    for path in sorted(have.keys() | want.keys()):
        a, e = have.get(path), want.get(path)
        if a != e:
            kind = MISSING if a is None else UNEXPECTED if e is None else DIFFERS
            rows.append((path, kind, e, a))
    return spark.createDataFrame(
        rows, "field string, kind string, expected string, actual string"
    )


def _json_type(value: object) -> str:
    if value is None:
        return "void"
    names = {bool: "boolean", int: "bigint", float: "double", str: "string", dict: "struct"}
    return names.get(type(value), "array")


def document_paths(document: object, opaque: frozenset[str] = frozenset()) -> set[tuple[str, str]]:
    """(path, type) of everything a document holds, at any depth, without recursion.

    The entries below an ``opaque`` path (a declared map) are left out.
    """
    found: set[tuple[str, str]] = set()
    todo = [("", document)]
    while todo:
        path, value = todo.pop()
        if path:
            found.add((path, _json_type(value)))
        if path in opaque:
            continue
        if isinstance(value, dict):
            todo += [(f"{path}.{_step(k)}" if path else _step(k), v) for k, v in value.items()]
        elif isinstance(value, list):
            todo += [(f"{path}[]", v) for v in value]
    return found


def _drift(text: str | None, want: dict[str, str], opaque: frozenset[str]) -> Iterator[tuple]:
    """(field, kind, expected, actual) of one document."""
    try:
        document = json.loads(text) if text is not None else None
    except (ValueError, RecursionError):
        document = None
    if not isinstance(document, dict):
        yield "", MALFORMED, "struct", None
        return
    found = document_paths(document, opaque)
    for path in want.keys() - {p for p, _ in found}:
        yield path, MISSING, want[path], None
    for path, kind in found:
        expected = want.get(path)
        if expected is None:
            yield path, UNEXPECTED, None, kind
        elif kind != "void" and kind not in _ACCEPTED.get(expected.partition("(")[0].partition("<")[0], {expected}):
            yield path, DIFFERS, expected, kind


def document_drift(df: DataFrame, json_column: str, expected: T.StructType) -> DataFrame:
    """Drift counted over JSON texts: ``field, kind, expected, actual, n_docs``.

    Reads each document's own fields at any depth, so it also shows how often a field
    is absent or has another type, which a merged inferred schema hides.  A path
    counts once a document, whatever the array elements it comes from; names with
    special characters are quoted in it.  A JSON null has no type and counts as
    present.  A text that is no JSON object (null, broken or another value) is
    ``malformed`` and misses nothing.

    One pass over the documents: no fixed number of expressions reaches every depth,
    so tasks walk the documents and hand on counts a batch, and only these meet.
    """
    want = _leaves(expected)
    opaque = frozenset(p for p, kind in want.items() if kind.startswith("map<"))
    schema = pa.schema(
        [(c, pa.string()) for c in ("field", "kind", "expected", "actual")] + [("n", pa.int64())]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for text in batch.column(0).to_pylist():
                seen.update(_drift(text, want, opaque))
            rows = [dict(zip(schema.names, [*key, n], strict=True)) for key, n in seen.items()]
            yield pa.RecordBatch.from_pylist(rows, schema)

    counted = df.select(df[json_column].cast("string").alias("doc")).mapInArrow(
        count, "field string, kind string, expected string, actual string, n long"
    )
    return counted.groupBy("field", "kind", "expected", "actual").agg(F.sum("n").alias("n_docs"))


# what runs in workers is shipped by value, so they need no copy of this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])
