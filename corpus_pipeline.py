"""From raw documents to a training mix, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows that the one before kept,
and returns a DataFrame that is written as Parquet and read again.  All but the last
return the columns of the documents; the last tells how much of each document the
mix takes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearwell.llm.common import free_name, table, written
from clearwell.llm.decontaminate import drop_contaminated
from clearwell.llm.jaccard import jaccard_classes
from clearwell.llm.mixing import mix_sources
from clearwell.llm.quality import score_quality
from clearwell.llm.toxicity import fit_toxicity, score_toxicity


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model accepts."""
    name = free_name(docs, "quality")
    scored = score_quality(docs, table(spark, sf_dir, "labels"))
    return scored.where(F.col(name)["predicted"] == 1).select(*docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    name = free_name(docs, "toxicity")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).where(F.col(name)["predicted"] == 0).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the least id.

    A document is a pair of id and text, so an id with several texts is several
    documents, each with a class of its own; a row that repeats id and text goes.
    Rows without an id have no class and stay.
    """
    row, text, several = (free_name(docs, name) for name in ("_row", "_text", "_several"))
    rows = docs.where("doc_id IS NOT NULL").withColumn(text, F.xxhash64("text"))
    # ids with several texts; their rows get numbers of their own, beyond all ids
    repeated = rows.groupBy("doc_id").agg(F.min(text).alias("a"), F.max(text).alias("b")).where("a <> b")
    repeated = written(repeated.select("doc_id", F.lit(True).alias(several)), "pipeline-repeated-ids")
    own = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64("doc_id", text), 2)
    key = F.when(F.col(several), own).otherwise(F.col("doc_id").cast("long"))
    numbered = rows.join(repeated, "doc_id", "left").withColumn(row, key)
    classes = jaccard_classes(numbered, id_col=row)
    first = classes.where(F.col(row) == F.col("class_id")).select(row).distinct()
    kept = numbered.join(first, row, "left_semi").dropDuplicates([row, text])
    return kept.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    return mix_sources(docs)


STAGES = [
    ("quality classifier", quality),
    ("toxicity", toxicity),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
]

#: Learned scores, MinHash values and seeded hashes have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
