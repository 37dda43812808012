"""Readers for the raw tables.

Files are read as declared text columns: no inference pass over the data, and a
malformed number or date cannot fail the scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearwell.operators.silver import MALFORMED
from clearwell.plans.entities import DELIVERY_EVENTS, ENTITIES
from clearwell.sources import json_arrays, sinks, splits


@dataclass(frozen=True)
class JdbcRange:
    """How a table scan is divided: ``partitions`` ranges of a numeric or date column."""

    column: str
    lower: str
    upper: str
    partitions: int


@dataclass(frozen=True)
class Source:
    """Where one table comes from.  ``options`` go to the reader unchanged."""

    format: str
    location: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    schema: str | T.StructType | None = None
    # a JDBC table without a split is read by one task; that has to be asked for
    single_task: bool = False
    # CSV and JSON with a schema: keep the text of records that cannot be taken apart
    keep_malformed: bool = False


def jdbc_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    split: JdbcRange | None = None,
    fetch_size: int = 10_000,
    **connection: str,
) -> dict[str, str]:
    """Options of a table scan or of a subquery that the database computes."""
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    options = {"url": url, "fetchsize": str(fetch_size), **connection}
    if query is not None:
        query = query.strip().rstrip(";").rstrip()
        # as a derived table, so that a partitioned read of a query works as well
        table = f"({query}) AS pushed_query"
    options["dbtable"] = str(table)
    if split is not None:
        options |= {
            "partitionColumn": split.column,
            "lowerBound": split.lower,
            "upperBound": split.upper,
            "numPartitions": str(split.partitions),
        }
    return options


def _require_split(options: Mapping[str, str], single_task: bool) -> None:
    if "numPartitions" not in options and not single_task:
        raise ValueError("a JDBC scan needs a split, or single_task=True for a small one")


def read_jdbc(
    spark: SparkSession, url: str, single_task: bool = False, **arguments: object
) -> DataFrame:
    """See :func:`jdbc_options`; give ``split``, or say that one task may read it all."""
    options = jdbc_options(url, **arguments)
    _require_split(options, single_task)
    return spark.read.format("jdbc").options(**options).load()


def read_jdbc_split(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    parts: int,
    then: str | None = None,
    sample: str = "",
    **connection: str,
) -> DataFrame:
    """A table read in ``parts`` of about equal rows, whatever its keys (`splits.plan_splits`).

    A first pass fetches the keys alone, in one task; ``sample`` is what the database
    takes after the table's name to give some of them (``TABLESAMPLE SYSTEM (1)``).
    """
    listed = ", ".join([column, *([then] if then else [])])
    keys = read_jdbc(spark, url, single_task=True, query=f"SELECT {listed} FROM {table} {sample}".rstrip(), **connection)
    # the planner reads the keys more than once
    stored = sinks.stage_tables({"keys": keys}, f"{sinks.shared_dir(spark)}/split-keys-{uuid4().hex}")["keys"]
    predicates = splits.plan_splits(stored, column, parts, then)
    return spark.read.jdbc(url, table, predicates=predicates, properties=dict(connection))


def run_jdbc_reports(
    spark: SparkSession, url: str, catalogue: Mapping[str, str], **connection: str
) -> dict[str, DataFrame]:
    """Reports in the database's own SQL, computed there; each result is one task's."""
    return {
        name: read_jdbc(spark, url, single_task=True, query=sql, **connection)
        for name, sql in sorted(catalogue.items())
    }


def read_csv_text(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    keep_malformed: bool = False,
    **options: str,
) -> DataFrame:
    """Declared text columns.  ``keep_malformed`` adds the column `MALFORMED`: the line as
    read if it has too few or too many values or a quote that does not close."""
    options = {"header": "true", **options}
    if not keep_malformed:
        return spark.read.options(**options).csv(path, schema=schema)
    if str(options.get("multiLine", "false")).lower() == "true":
        raise ValueError("lines are kept as read, so values cannot hold line ends")
    # whole lines first: one column, with a separator and without quotes that occur in text
    whole = {k: v for k, v in options.items() if k in ("header", "encoding", "lineSep", "pathGlobFilter", "recursiveFileLookup")}
    lines = spark.read.options(**whole, sep="\u0001", quote="", maxCharsPerColumn="-1").csv(path, schema="line string")
    declared = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    parsed = {k: v for k, v in options.items() if k not in whole}
    parsed |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED, "maxCharsPerColumn": "-1"}
    ddl = T.StructType([*declared.fields, T.StructField(MALFORMED, T.StringType())]).toDDL()
    rows = lines.select("line", F.from_csv("line", F.lit(ddl), parsed).alias("r"))
    quote = options.get("quote", '"')
    line = F.col("line")
    escaped = F.replace(line, F.lit(options.get("escape", "\\") + quote), F.lit("")) if quote else line
    quotes = F.length(escaped) - F.length(F.replace(escaped, F.lit(quote or "\u0001"), F.lit("")))
    broken = F.col("r").getField(MALFORMED).isNotNull() | (quotes % 2 == 1)
    return rows.select(
        *[F.col("r").getField(f.name).alias(f.name) for f in declared.fields], F.when(broken, line).alias(MALFORMED)
    )


def read_json(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType | None = None,
    multi_line: bool = False,
    sampling_ratio: float = 1.0,
    recursive: bool = False,
    keep_malformed: bool = False,
    staging: str | None = None,
) -> DataFrame:
    """JSON Lines by default.  ``multi_line`` reads arrays or documents over several lines;
    Spark gives such a file to one task, so `json_arrays` cuts it at its elements, which
    are written once under ``staging`` (a new folder in ``spark.checkpoint.dir`` by
    default).  ``recursive`` takes the files of all folders below ``path`` as well.
    ``keep_malformed`` adds the column `MALFORMED`: the text of a record that is no
    JSON object."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if multi_line:
        staging = staging or f"{sinks.shared_dir(spark)}/json-elements-{uuid4().hex}"
        texts = json_arrays.json_elements(spark, path, staging, recursive)
        rows = json_arrays.parsed(texts, schema if schema is not None else json_arrays.inferred_schema(texts))
        return rows if keep_malformed else rows.drop(MALFORMED)
    reader = spark.read.options(pathGlobFilter="*.json", recursiveFileLookup=recursive)
    if keep_malformed:
        if schema is None:
            raise ValueError("malformed records are kept beside a declared schema")
        return json_arrays.parsed(reader.text(path).where(F.trim("value") != ""), schema)
    if schema is None:
        return reader.option("samplingRatio", str(sampling_ratio)).json(path)
    return reader.schema(schema).json(path)


def delivery_events_schema() -> T.StructType:
    return T.StructType.fromDDL(DELIVERY_EVENTS.raw_schema)


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """The rows; an error if there are none, as after a mistyped folder."""
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df


def read_delivery_events(
    spark: SparkSession,
    path: str,
    multi_line: bool = False,
    recursive: bool = False,
    allow_empty: bool = False,
    keep_malformed: bool = False,
) -> DataFrame:
    schema = delivery_events_schema()
    events = read_json(spark, path, schema, multi_line, recursive=recursive, keep_malformed=keep_malformed)
    return events if allow_empty else require_rows(events, path)


def read_documents(
    spark: SparkSession, format: str, options: Mapping[str, str], required: Sequence[str]
) -> DataFrame:
    """A document collection through whatever connector ``format`` names."""
    missing = [name for name in required if not options.get(name)]
    if missing:
        raise ValueError(f"missing connector options: {', '.join(missing)}")
    return spark.read.format(format).options(**options).load()


def read_source(spark: SparkSession, source: Source) -> DataFrame:
    kind = source.format.lower()
    if kind == "jdbc":
        _require_split(source.options, source.single_task)
    options = dict(source.options)
    multi_line = str(options.get("multiLine", "false")).lower() == "true"
    if kind == "json" and (multi_line or source.keep_malformed):
        if source.location is None:
            raise ValueError("files need a location")
        others = options.keys() - {"multiLine", "recursiveFileLookup", "pathGlobFilter"}
        if not others and options.get("pathGlobFilter", "*.json") == "*.json":
            recursive = str(options.get("recursiveFileLookup", "false")).lower() == "true"
            return read_json(
                spark, source.location, source.schema, multi_line, recursive=recursive, keep_malformed=source.keep_malformed
            )
        if source.keep_malformed:
            raise ValueError(f"malformed records are not kept with the options {sorted(others)}")
    if source.keep_malformed:
        if kind != "csv" or source.location is None or source.schema is None:
            raise ValueError("malformed records are kept for CSV and JSON files with a schema")
        return read_csv_text(spark, source.location, source.schema, True, **options)
    reader = spark.read.format(source.format).options(**options)
    if source.schema is not None:
        reader = reader.schema(source.schema)
    return reader.load(source.location) if source.location else reader.load()


def as_raw(df: DataFrame, entity: str) -> DataFrame:
    """The entity's declared columns as text, whatever types the source gave them.

    The text of malformed records stays where the reader kept it.
    """
    schema = T.StructType.fromDDL(ENTITIES[entity].raw_schema)
    kept = [F.col(MALFORMED)] if MALFORMED in df.columns else []
    return df.select(
        *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields], *kept
    )


def load_sources(
    spark: SparkSession, sources: Mapping[str, Source], allow_empty: bool = False
) -> dict[str, DataFrame]:
    """Raw tables by entity name, in declared shape; an empty source is an error."""
    missing = sorted(set(ENTITIES) - set(sources))
    if missing:
        raise KeyError(f"missing sources: {', '.join(missing)}")
    raw = {name: as_raw(read_source(spark, sources[name]), name) for name in ENTITIES}
    if not allow_empty:
        for name, df in raw.items():
            require_rows(df, f"source {name}")
    return raw
