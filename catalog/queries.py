"""The registered queries: every operator over the whole benchmark tables.

Results leave in types that any two engines print alike: decimals as doubles,
dates and timestamps as text.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator, Mapping
from contextlib import suppress
from functools import reduce
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.bronze import TABLES, bronze, spark_table
from catalog.bronze import read as source_table
from clearwell.functions import normalize as N
from clearwell.functions import vocab as V
from clearwell.operators import duplicates, rejects, silver
from clearwell.operators import summaries as S
from clearwell.plans import controls, dialect, gold, quality, reports
from clearwell.plans.entities import ENTITIES
from clearwell.sources import drift, json_arrays, publish, readers, sinks, splits

Query = Callable[[SparkSession, str], DataFrame]


def portable(df: DataFrame) -> DataFrame:
    """Flatten structs; decimals to double, dates and timestamps to text."""
    columns: list[Column] = []

    def add(path: str, name: str, data_type: T.DataType) -> None:
        column = F.col(path)
        if isinstance(data_type, T.StructType):
            for f in data_type.fields:
                add(f"{path}.`{f.name}`", f"{name}_{f.name}", f.dataType)
            return
        if isinstance(data_type, T.DecimalType):
            column = column.cast("double")
        elif isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            column = column.cast("string")
        columns.append(column.alias(name))

    for f in df.schema.fields:
        add(f"`{f.name}`", f.name, f.dataType)
    return df.select(*columns)


class ValidTables(Mapping[str, DataFrame]):
    """Valid rows by entity, planned only for the entities a query asks for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._raw = lambda entity: spark_table(spark, sf_dir, entity)
        self._planned: dict[str, DataFrame] = {}

    def __getitem__(self, entity: str) -> DataFrame:
        if entity not in self._planned:
            tagged = silver.tag(self._raw(entity), ENTITIES[entity])
            self._planned[entity] = silver.valid(tagged)
        return self._planned[entity]

    def __iter__(self) -> Iterator[str]:
        return iter(ENTITIES)

    def __len__(self) -> int:
        return len(ENTITIES)


valid_tables = ValidTables


def tagged_tables(
    spark: SparkSession, sf_dir: str, keep_raw: bool = False
) -> dict[str, DataFrame]:
    return {
        name: silver.tag(spark_table(spark, sf_dir, name), e, keep_raw=keep_raw)
        for name, e in ENTITIES.items()
    }


# --- sources ---------------------------------------------------------------------------


def _scan(entity: str) -> Query:
    return lambda spark, d: portable(spark_table(spark, d, entity))


def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delivery events as JSON texts that drifted from the declared schema.

    Some carry an undeclared ``priority``, some a numeric ``event_id``, some no
    carrier at all; NULL fields are absent, as document stores leave them out.
    """
    number = F.regexp_extract("event_id", r"(\d+)", 1).try_cast("bigint")
    key = F.coalesce(number, F.lit(0))
    events = spark_table(spark, sf_dir, "delivery_events")
    base = ["order_id", "event_type", "event_timestamp", "location"]
    carrier = F.when(key % 9 != 4, F.col("carrier")).alias("carrier")
    priority = F.when(key % 10 == 3, key % 3).alias("priority")
    numeric = F.struct(number.alias("event_id"), *base, carrier, priority)
    textual = F.struct("event_id", *base, carrier, priority)
    return events.select(
        F.when(key % 37 == 1, F.to_json(numeric)).otherwise(F.to_json(textual)).alias("doc")
    )


def schema_drift_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.document_drift(
        event_documents(spark, sf_dir), "doc", readers.delivery_events_schema()
    )


# --- files there and back ---------------------------------------------------------------


def _folder(spark: SparkSession, name: str) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="clearwell-")
    return f"{base.rstrip('/')}/{name}-{uuid4().hex}"


def source_csv_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw orders as a CSV file with header, read as text through the source loader."""
    path = _folder(spark, "csv")
    spark_table(spark, sf_dir, "orders").write.csv(
        path,
        header=True,
        nullValue="\\N",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    options = {"header": "true", "nullValue": "\\N"}
    source = readers.Source("csv", path, options, ENTITIES["orders"].raw_schema)
    return portable(readers.as_raw(readers.read_source(spark, source), "orders"))


def source_json_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delivery events as JSON lines in nested folders, read with the declared schema."""
    path = _folder(spark, "json")
    spark_table(spark, sf_dir, "delivery_events").write.json(f"{path}/2026/03")
    return portable(readers.read_delivery_events(spark, path, recursive=True))


def source_json_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reviews as JSON lines with inferred types, brought back to declared text."""
    path = _folder(spark, "json")
    spark_table(spark, sf_dir, "reviews").write.json(path)
    return portable(readers.as_raw(readers.read_json(spark, path), "reviews"))


def _write_arrays(documents: DataFrame, path: str) -> None:
    """JSON texts, column ``doc``, as indented arrays over many lines, one a task."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = "["
        for batch in batches:
            out = [before] + [""] * batch.num_rows
            for i, doc in enumerate(batch.column(0).to_pylist()):
                out[i] += f"\n  {doc}"
                out[i] += "," if i + 1 < batch.num_rows else ""
            before = ","
            yield pa.RecordBatch.from_arrays([pa.array(out[:-1], pa.string())], ["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["]" if before == "," else "[]"], pa.string())], ["value"])

    documents.select("doc").mapInArrow(lines, "value string").write.text(path)


def source_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delivery events as arrays over many lines, cut at their elements and read by many tasks.

    Each is indented, so that it takes several lines itself.
    """
    path = _folder(spark, "arrays")
    events = spark_table(spark, sf_dir, "delivery_events")
    pretty = F.to_json(F.struct(*events.columns), {"pretty": "true"})
    _write_arrays(events.select(pretty.alias("doc")), f"{path}/files")
    texts = json_arrays.json_elements(spark, f"{path}/files", f"{path}/elements", glob="*.txt")
    rows = json_arrays.parsed(texts, readers.delivery_events_schema())
    return portable(readers.as_raw(rows.drop(json_arrays.MALFORMED), "delivery_events"))


def reject_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as CSV and events as JSON lines and arrays, some damaged; the malformed as rejects.

    Lines lose their last values, get one too many or a quote that never closes;
    documents lose their end or the quotes of a value.
    """
    path = _folder(spark, "damaged")
    orders = spark_table(spark, sf_dir, "orders")
    number = F.coalesce(F.regexp_extract("order_id", r"(\d+)", 1).try_cast("bigint"), F.lit(0))
    values = [F.coalesce(F.col(c), F.lit("")) for c in orders.columns]
    good = F.concat_ws(",", *[F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"')) for v in values])
    orders.select(
        F.when(number % 50 == 7, F.concat_ws(",", *values[:2]))
        .when(number % 50 == 8, F.concat(good, F.lit(",extra")))
        .when(number % 50 == 9, F.concat_ws(",", values[0], F.concat(F.lit('"'), values[1])))
        .otherwise(good)
    ).write.text(f"{path}/orders")
    options = {"header": "false", "escape": '"'}
    csv = readers.Source("csv", f"{path}/orders", options, ENTITIES["orders"].raw_schema, keep_malformed=True)
    docs = event_documents(spark, sf_dir)
    key = F.coalesce(F.regexp_extract("doc", r'"event_id":"?\D*(\d+)', 1).try_cast("bigint"), F.lit(0))
    cut = F.substr("doc", F.lit(1), F.length("doc") - 3)
    unquoted = F.concat(F.lit('{"event_id":EVT'), key.cast("string"), F.lit("}"))
    docs.select(F.when(key % 40 == 3, cut).otherwise(F.col("doc"))).write.text(f"{path}/lines")
    _write_arrays(docs.select(F.when(key % 40 == 5, unquoted).otherwise(F.col("doc")).alias("doc")), f"{path}/arrays")
    schema = readers.delivery_events_schema()
    lines = json_arrays.parsed(spark.read.text(f"{path}/lines"), schema)
    arrays = json_arrays.parsed(
        json_arrays.json_elements(spark, f"{path}/arrays", f"{path}/elements", glob="*.txt"), schema
    )
    read = {
        "orders": ("orders", readers.read_source(spark, csv)),
        "event_lines": ("delivery_events", lines),
        "event_arrays": ("delivery_events", arrays),
    }
    parts = [
        rejects.envelope(
            silver.rejected(silver.tag(readers.as_raw(df, entity), ENTITIES[entity], keep_raw=True)), name
        )
        .where(F.col(silver.REASON) == silver.MALFORMED_RECORD)
        .select("source", "rejection_reason", "original_data")
        for name, (entity, df) in read.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def source_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan plans of the order lines by keys with gaps and heavy values.

    For each: rows, rows that the predicates hold, rows that several hold, and whether no
    part has more than twice its share.
    """
    lines = source_table(spark, sf_dir, "lineitem").withColumns(
        {
            # a third of all lines has one key; the others lie far apart
            "hot": F.when(F.col("l_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("l_orderkey") * F.col("l_orderkey")),
            "day": F.when(F.col("l_linenumber") != 5, F.col("l_shipdate").cast("date")),
        }
    )
    parts = []
    for name, column, then, n in (
        ("order", "l_orderkey", None, 16), ("hot", "hot", "l_partkey", 12), ("day", "day", None, 10), ("price", "l_extendedprice", None, 7),
    ):
        predicates = splits.plan_splits(lines, column, n, then)
        held = [F.expr(p).cast("int") for p in predicates]
        nulls = F.col(column).isNull()
        times = reduce(Column.__add__, [F.coalesce(h, F.lit(0)) for h in held])
        parts.append(
            lines.agg(
                F.count(F.lit(1)).alias("n_rows"),
                F.count_if(times >= 1).alias("n_held"),
                F.count_if(times > 1).alias("n_repeated"),
                (F.greatest(*[F.sum(F.when(~nulls, h)) for h in held]) <= 2 * F.count(F.lit(1)) / n).alias("is_even"),
            ).select(F.lit(name).alias("scan"), "*")
        )
    return reduce(DataFrame.unionByName, parts)


def source_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reviews through the connector reader, by format name and required options."""
    path = _folder(spark, "documents")
    spark_table(spark, sf_dir, "reviews").write.json(path)
    options = {"path": path, "primitivesAsString": "true"}
    documents = readers.read_documents(spark, "json", options, ["path"])
    return portable(readers.as_raw(documents, "reviews"))


def sink_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reject envelopes of all entities, written and read back."""
    base = _folder(spark, "rejects")
    tagged = tagged_tables(spark, sf_dir, keep_raw=True)
    sinks.write_rejects({n: silver.rejected(df) for n, df in tagged.items()}, base)
    parts = [
        spark.read.parquet(f"{base}/{n}").select("source", "rejection_reason", "original_data")
        for n in tagged
    ]
    return reduce(DataFrame.unionByName, parts)


def sink_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A business table, written and read back."""
    base = _folder(spark, "gold")
    built = gold.build_gold(valid_tables(spark, sf_dir), ["sales_by_product"])
    sinks.write_tables(built, base)
    return portable(spark.read.parquet(f"{base}/sales_by_product"))


def sink_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Business tables published as one version; a later run that breaks off is not seen."""
    base = _folder(spark, "published")
    valid = valid_tables(spark, sf_dir)
    tables = gold.build_gold(valid, ["sales_by_product", "product_ratings"])
    publish.publish(spark, base, lambda folder: sinks.write_tables(tables, folder), dict)

    def broken(folder: str) -> None:
        sinks.write_tables({"sales_by_product": tables["sales_by_product"].limit(1)}, folder)
        raise InterruptedError

    with suppress(InterruptedError):
        publish.publish(spark, base, broken)
    seen = publish.current(spark, base)
    return portable(seen.table(spark, "sales_by_product"))


def sink_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The controls over the stored order table, written and read back."""
    base = _folder(spark, "validation")
    orders = gold.build_gold(valid_tables(spark, sf_dir), ["customer_order_360"])
    sinks.write_tables(orders, base)
    stored = spark.read.parquet(f"{base}/customer_order_360")
    sinks.write_table(controls.validation_results(stored), f"{base}/results")
    return spark.read.parquet(f"{base}/results")


def sink_sql_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All reports written beside their status; the status read back."""
    base = _folder(spark, "sql")
    run = reports.run_reports(spark, reports.raw_views(bronze(spark, sf_dir)))
    reports.write_reports(spark, run, base)
    counts = [
        spark.read.parquet(f"{base}/{n}").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("report"), "n_rows")
        for n in reports.REPORTS
    ]
    status = spark.read.parquet(f"{base}/_status").select("report", "status")
    return status.join(reduce(DataFrame.unionByName, counts), "report")


# --- normalisers --------------------------------------------------------------------------


def _normalised(
    *parts: tuple[str, str, str, Callable[[Column], Column]],
) -> Query:
    """Distinct raw values with their normal form and frequency.

    Each part is (kind, entity, raw column, normaliser).
    """

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        values = [
            spark_table(spark, sf_dir, entity)
            .groupBy(F.col(column).alias("raw_value"))
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .select(
                F.lit(kind).alias("kind"),
                "raw_value",
                normalise(F.col("raw_value")).alias("value"),
                "n_rows",
            )
            for kind, entity, column, normalise in parts
        ]
        return portable(reduce(DataFrame.unionByName, values))

    return query


def _ids(exact: bool) -> Query:
    return _normalised(
        ("customer", "orders", "customer_id", lambda c: N.customer_id(c, exact)),
        ("order", "orders", "order_id", lambda c: N.order_id(c, exact)),
        ("product", "products", "product_id", lambda c: N.product_id(c, exact)),
    )


NORMALISERS: dict[str, Query] = {
    "norm_ids": _ids(False),
    "norm_ids_exact_width": _ids(True),
    "norm_phone": _normalised(("phone", "customers", "phone", N.phone)),
    "norm_dates": _normalised(
        ("order_date", "orders", "order_date", N.date),
        ("birth_date", "customers", "birth_date", N.date),
        ("review_date", "reviews", "reviewDate", N.review_date),
    ),
    "norm_timestamps": _normalised(
        (
            "created_at",
            "customers",
            "created_at",
            lambda c: N.timestamp(c, V.CREATED_AT_FORMATS),
        ),
        (
            "event_timestamp",
            "delivery_events",
            "event_timestamp",
            lambda c: N.timestamp(c, V.EVENT_TIMESTAMP_FORMATS),
        ),
    ),
    "norm_status": _normalised(("status", "orders", "status", N.order_status)),
    "norm_payment": _normalised(
        ("payment_method", "orders", "payment_method", N.payment_method)
    ),
    "norm_currency": _normalised(("currency", "orders", "currency", N.currency)),
    "norm_country": _normalised(
        ("customer", "customers", "country", N.country),
        ("event", "delivery_events", "location.country", N.country),
    ),
    "norm_category": _normalised(("category", "products", "category", N.category)),
    "norm_boolean": _normalised(
        ("verified", "reviews", "verifiedPurchase", N.boolean),
        ("active", "products", "active", N.flag),
    ),
    "norm_money": _normalised(
        ("total_amount", "orders", "total_amount", N.absolute_money),
        ("current_price", "products", "current_price", N.money),
    ),
    "norm_discount": _normalised(("discount", "order_items", "discount", N.discount)),
    "norm_event_type": _normalised(
        ("event_type", "delivery_events", "event_type", N.event_type)
    ),
    "norm_text": _normalised(
        ("name", "customers", "first_name", N.name),
        ("code", "delivery_events", "carrier.id", N.code),
        ("email", "customers", "email", N.email),
        ("text", "reviews", "comment", N.text),
    ),
}


# --- cleaning, rejects ------------------------------------------------------------------------


def _clean(entity: str) -> Query:
    return lambda spark, d: portable(
        silver.clean(spark_table(spark, d, entity), ENTITIES[entity])
    )


def _reject(entity: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tagged = silver.tag(spark_table(spark, sf_dir, entity), ENTITIES[entity])
        return portable(silver.rejected(tagged))

    return query


def _staged(spark: SparkSession, name: str, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return sinks.stage_tables(tables, _folder(spark, name))


def _without_duplicates(entity: str) -> Query:
    """Valid rows with one row a key (an option, off in the default pipeline)."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        stored = _staged(spark, "unique", {entity: valid_tables(spark, sf_dir)[entity]})[entity]
        tagged = duplicates.tag_duplicates(stored, *duplicates.KEYS[entity], "_duplicate")
        return portable(tagged.where("NOT _duplicate").drop("_duplicate"))

    return query


def duplicate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _staged(spark, "unique", dict(valid_tables(spark, sf_dir).items()))
    parts = [
        duplicates.tag_duplicates(df, *duplicates.KEYS[name], "_duplicate").agg(
            F.count_if(~F.col("_duplicate")).alias("n_kept"),
            F.count_if("_duplicate").alias("n_duplicates"),
        ).select(F.lit(name).alias("entity"), "n_kept", "n_duplicates")
        for name, df in stored.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def reject_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes of all sources; the time of rejection differs by run."""
    parts = [
        rejects.envelope(silver.rejected(df), name).select(
            "source", "rejection_reason", "original_data"
        )
        for name, df in tagged_tables(spark, sf_dir, keep_raw=True).items()
    ]
    return reduce(DataFrame.unionByName, parts)


def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        quality.null_profile(df).select(
            F.lit(name).alias("entity"), "column_name", "n_missing", "n_rows"
        )
        for name, df in bronze(spark, sf_dir).items()
    ]
    return reduce(DataFrame.unionByName, parts)


# --- business tables -------------------------------------------------------------------------------


def _gold(table: str) -> Query:
    return lambda spark, d: portable(gold.BUILDERS[table](valid_tables(spark, d)))


def customer_order_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold("customer_order_360")(spark, sf_dir)


def customer_order_360_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table from summaries that were written first, as the pipeline builds it."""
    valid = valid_tables(spark, sf_dir)
    stored = _staged(spark, "summaries", gold.order_summaries(valid))
    return portable(gold.customer_order_360(valid, stored))


def gold_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = gold.build_gold(valid_tables(spark, sf_dir), list(gold.BUILDERS))
    return quality.row_counts(tables)


def join_orders_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = valid_tables(spark, sf_dir)
    return portable(gold.orders_with_customers(v["orders"], v["customers"]))


def join_items_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = valid_tables(spark, sf_dir)
    return portable(gold.items_with_products(v["order_items"], v["products"]))


def validation_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = gold.customer_order_360(valid_tables(spark, sf_dir))
    return controls.validation_results(orders)


def quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by data quality score (an option, off in the default pipeline)."""
    orders = gold.customer_order_360(valid_tables(spark, sf_dir))
    scored = controls.with_quality_score(orders)
    return portable(
        scored.groupBy(controls.SCORE).agg(F.count(F.lit(1)).alias("n_orders"))
    )


def _report(name: str) -> Query:
    return lambda spark, d: portable(reports.report(spark, bronze(spark, d), name))


#: Reports as the files of the database have them.
REPORT_FILES = {
    "monthly_revenue": r"""
        WITH days AS (
            SELECT total_amount, UPPER(TRIM(status)) AS state, CASE
                WHEN TRIM(order_date) ~ '^\d{2}/\d{2}/\d{4}$' THEN TO_DATE(TRIM(order_date), 'DD/MM/YYYY')
                WHEN TRIM(order_date) ~ '^\d{4}-\d{2}-\d{2}$' THEN TO_DATE(TRIM(order_date), 'YYYY-MM-DD')
                WHEN TRIM(order_date) ~ '^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}$'
                    THEN TO_TIMESTAMP(REPLACE(TRIM(order_date), 'T', ' '), 'YYYY-MM-DD HH24:MI:SS')::date
                END AS day
            FROM orders
        )
        SELECT DATE_TRUNC('month', day)::date AS order_month, COUNT(*) AS number_of_orders,
               COALESCE(SUM(total_amount), 0) AS monthly_revenue, ROUND(COALESCE(AVG(total_amount), 0), 2) AS average_order_amount
        FROM days
        WHERE day IS NOT NULL AND COALESCE(state, '') NOT IN ('CANCELLED', 'ANNULÉE', 'ANNULEE')
        GROUP BY DATE_TRUNC('month', day) ORDER BY order_month;
    """,
    "top_customers": """
        SELECT o.customer_id, CONCAT(c.first_name, ' ', c.last_name) AS "full_name",
               COUNT(DISTINCT o.order_id) AS number_of_orders, SUM(o.total_amount) AS total_spent
        FROM orders o LEFT JOIN customers c ON o.customer_id = c.customer_id
        GROUP BY o.customer_id, c.first_name, c.last_name
        ORDER BY total_spent DESC, o.customer_id, full_name LIMIT 10
    """,
}


def _report_file(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        views = reports.raw_views(bronze(spark, sf_dir))
        run = reports.run_reports(spark, views, {name: dialect.to_spark(REPORT_FILES[name])})
        return portable(run.results[name])

    return query


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {f"scan_{e}": _scan(e) for e in TABLES}
    for query in (
        source_csv_tables, source_json_declared, source_json_inferred, source_json_array, source_splits, source_documents, reject_malformed,
        sink_rejects, sink_gold, sink_published, sink_validation, sink_sql_results,
    ):
        found[query.__name__] = query
    found["schema_drift_events"] = schema_drift_events
    found |= NORMALISERS
    found |= {f"clean_{e}": _clean(e) for e in TABLES}
    found["silver_counts"] = lambda spark, d: quality.split_counts(
        tagged_tables(spark, d)
    )
    found |= {f"reject_{e}": _reject(e) for e in TABLES}
    found["reject_summary"] = lambda spark, d: rejects.summary(tagged_tables(spark, d))
    found["reject_envelope"] = reject_envelope
    found |= {
        f"unique_{e}": _without_duplicates(e) for e in ("customers", "orders", "delivery_events")
    }
    found["duplicate_counts"] = duplicate_counts
    found["join_orders_customers"] = join_orders_customers
    found["join_items_products"] = join_items_products
    found["join_orphans"] = lambda spark, d: gold.orphan_counts(valid_tables(spark, d))
    found |= {table: _gold(table) for table in gold.BUILDERS}
    found["customer_order_360_routed"] = customer_order_360_routed
    found["latest_event_window"] = lambda spark, d: portable(
        S.latest_event(valid_tables(spark, d)["delivery_events"])
    )
    found["gold_counts"] = gold_counts
    found["layer_counts"] = lambda spark, d: quality.row_counts(bronze(spark, d))
    found["null_profile"] = null_profile
    found["quality_silver"] = lambda spark, d: quality.quality_report(
        valid_tables(spark, d)
    )
    found["quality_currency_domain"] = lambda spark, d: quality.quality_of(
        valid_tables(spark, d)["orders"], "orders", V.CURRENCIES
    )
    found["validation_results"] = validation_results
    found["quality_score"] = quality_score
    found |= {f"report_{name[3:]}": _report(name) for name in reports.REPORTS}
    found |= {f"report_file_{name}": _report_file(name) for name in REPORT_FILES}
    return found
