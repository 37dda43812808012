"""The full run: raw tables to valid rows, rejects, business tables and reports.

Every layer is written before the next one reads it.  Each raw source is read
once, a lost executor costs tasks and not the run, and each join starts from files,
where Spark can split a skewed key.  The per-order summaries are written before the
business tables that share them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearwell.operators import duplicates
from clearwell.operators.silver import MALFORMED, RAW, REASON, Silver, require, tag
from clearwell.plans import controls, gold, quality, reports
from clearwell.plans.entities import ENTITIES
from clearwell.sources import publish, sinks

_REJECTED = "_rejected"


@dataclass
class Run:
    """Rows written per table, by layer, the reports that failed, and the staging folder."""

    counts: dict[str, dict[str, int]] = field(default_factory=dict)
    report_errors: dict[str, str] = field(default_factory=dict)
    staging: str = ""


def stage_silver(
    spark: SparkSession,
    bronze: Mapping[str, DataFrame],
    staging: str,
    exact_width: bool = False,
) -> Silver:
    """Clean and tag each raw table once and write both outcomes side by side.

    The outcome is the partition column, so reading the valid rows back does not
    touch the rejects.  Only rejects carry the row as it was read.
    """
    require(bronze, ENTITIES)
    tagged, valid, rejected = {}, {}, {}
    for name, entity in ENTITIES.items():
        path = f"{staging}/{name}"
        rows = tag(bronze[name], entity, exact_width, keep_raw=True)
        is_rejected = F.col(REASON).isNotNull()
        rows = rows.withColumns(
            {RAW: F.when(is_rejected, F.col(RAW)), _REJECTED: is_rejected}
        )
        sinks.write_table(rows, path, partition_by=[_REJECTED])
        stored = spark.read.schema(rows.schema).parquet(path)
        tagged[name] = stored.drop(_REJECTED)
        valid[name] = stored.where(~F.col(_REJECTED)).drop(REASON, RAW, MALFORMED, _REJECTED)
        rejected[name] = stored.where(F.col(_REJECTED)).drop(_REJECTED)
    return Silver(tagged, valid, rejected)


def keep_newest(spark: SparkSession, silver: Silver, staging: str) -> dict[str, DataFrame]:
    """Leave one valid row a key in ``silver``; the others, tagged as rejects."""
    repeated = {}
    for name, (key, recency) in duplicates.KEYS.items():
        rows = duplicates.tag_duplicates(silver.valid[name], key, recency, _REJECTED)
        path = f"{staging}/unique/{name}"
        sinks.write_table(rows, path, partition_by=[_REJECTED])
        stored = spark.read.schema(rows.schema).parquet(path)
        silver.valid[name] = stored.where(~F.col(_REJECTED)).drop(_REJECTED)
        repeated[name] = (
            stored.where(_REJECTED)
            .drop(_REJECTED)
            .withColumn(REASON, F.lit(duplicates.DUPLICATE_KEY))
        )
    return repeated


def stage_raw(
    spark: SparkSession, bronze: Mapping[str, DataFrame], staging: str
) -> dict[str, DataFrame]:
    """The raw tables with those that cleaning and reports share written once.

    Every raw source is read a single time, so both see the same snapshot.
    """
    shared = {name: bronze[name] for name in reports.NUMERIC_COLUMNS if name in bronze}
    return dict(bronze) | sinks.stage_tables(shared, f"{staging}/raw")


def run_pipeline(
    spark: SparkSession,
    bronze: Mapping[str, DataFrame],
    output: str,
    staging: str | None = None,
    gold_tables: list[str] | None = None,
    exact_width: bool = False,
    unique_keys: bool = False,
    quality_score: bool = False,
    currencies: Sequence[str] | None = None,
    allow_local: bool = False,
) -> Run:
    """Write every layer under ``output``.

    ``staging`` defaults to a new folder in the session's ``spark.checkpoint.dir``;
    what is staged there stays, and ``Run.staging`` names it for the caller to remove.
    On a cluster a folder on a machine's own disk is refused unless ``allow_local``.
    ``unique_keys`` keeps the newest valid row of each key and writes the others under
    ``duplicates`` as rejects, ``quality_score`` adds that column to the controls' input, ``currencies`` a check
    of the currency domain.
    """
    staging = staging or f"{sinks.shared_dir(spark)}/clearwell-{uuid4().hex}"
    for path in (staging, output):
        sinks.check_shared(spark, path, allow_local)
    require(bronze, ENTITIES)
    run = Run(staging=staging)
    bronze = stage_raw(spark, bronze, staging)
    silver = stage_silver(spark, bronze, staging, exact_width)
    run.counts["rejects"] = sinks.write_rejects(silver.rejected, f"{output}/rejects")
    if unique_keys:
        repeated = keep_newest(spark, silver, staging)
        run.counts["duplicates"] = sinks.write_rejects(
            repeated, f"{output}/duplicates", payload="cleaned"
        )

    run.counts["quality"] = sinks.write_tables(
        {
            "silver_quality": quality.quality_report(silver.valid, currencies),
            "silver_counts": quality.split_counts(silver.tagged),
        },
        f"{output}/quality",
    )
    names = gold_tables or gold.CORE_TABLES
    needed = set().union(*[gold.SUMMARIES_OF.get(name, set()) for name in names])
    planned = gold.order_summaries(silver.valid)
    summaries = sinks.stage_tables(
        {name: planned[name] for name in sorted(needed)}, f"{staging}/summaries"
    )
    run.counts["gold"] = sinks.write_tables(
        gold.build_gold(silver.valid, names, summaries), f"{output}/gold"
    )
    if "customer_order_360" in run.counts["gold"]:
        stored = spark.read.parquet(f"{output}/gold/customer_order_360")
        if quality_score:
            stored = controls.with_quality_score(stored)
        run.counts["validation"] = sinks.write_tables(
            {"validation_results": controls.validation_results(stored)}, output
        )
    done = reports.write_reports(
        spark, reports.run_reports(spark, reports.raw_views(bronze)), f"{output}/sql_results"
    )
    run.counts["sql_results"] = done.counts
    run.report_errors = done.errors
    return run


def publish_pipeline(
    spark: SparkSession, bronze: Mapping[str, DataFrame], base: str, **options: object
) -> tuple[publish.Version, Run]:
    """`run_pipeline` into a folder of its own, published under ``base`` when all of it is there.

    Readers take ``publish.current(spark, base)`` and its tables (``gold/sales_by_product``,
    ``rejects/orders``, ...), which all come from one run; a run that fails changes nothing
    for them.  Options are those of `run_pipeline`.
    """
    return publish.publish(
        spark,
        base,
        lambda folder: run_pipeline(spark, bronze, folder, **options),
        lambda run: {"counts": run.counts, "report_errors": run.report_errors},
        bool(options.get("allow_local", False)),
    )
