"""The registered queries of this subpackage, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clearwell.llm.common import table
from clearwell.llm.decontaminate import find_passages
from clearwell.llm.hardneg import mine_hard_negatives
from clearwell.llm.html import extract_main_text
from clearwell.llm.jaccard import jaccard_classes
from clearwell.llm.mixing import WORD, mix_sources
from clearwell.llm.quality import score_quality
from clearwell.llm.runs import find_runs
from clearwell.llm.secretscan import scan_secrets
from clearwell.llm.tokens import count_tokens
from clearwell.llm.topk import top_k_inner_products
from clearwell.llm.toxicity import fit_toxicity, score_toxicity
from clearwell.llm.urlfilter import judge_urls
from clearwell.llm.warc import pages_round_trip

URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k_inner_products(table(spark, sf_dir, "embeddings"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select("doc_id", "toxicity.*")


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES).drop("via")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_quality(docs, table(spark, sf_dir, "labels"), keep=("doc_id",))
    return scored.select("doc_id", "quality.*")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages_round_trip(spark, table(spark, sf_dir, "pages")).drop("target_uri")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).drop("source")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(vectors.withColumn("label", moved))


def _with_periodic_tails(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``: of each tenth document, by hash, the words from one on repeat a block."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    chosen = docs.where((h % 10 == 0) & (F.size(words) > 0)).select("doc_id", words.alias("w"))
    sized = (
        chosen.withColumn("n", F.size("w").cast("long"))
        .withColumn("g", F.floor(h / 10))
        .withColumn("a", F.col("g") % F.col("n"))
        .withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    )
    rest, p = F.col("n") - F.col("a"), F.col("p")
    block = F.slice("w", (F.col("a") + 1).cast("int"), p.cast("int"))
    whole = F.flatten(F.array_repeat(block, F.floor(rest / p).cast("int")))
    tail = F.slice("w", (F.col("a") + 1).cast("int"), (rest % p).cast("int"))
    head = F.slice("w", F.lit(1), F.col("a").cast("int"))
    changed = sized.select("doc_id", F.array_join(F.concat(head, whole, tail), " ").alias("text"))
    same = docs.where(~F.coalesce((h % 10 == 0) & (F.size(words) > 0), F.lit(False))).select("doc_id", "text")
    return same.unionByName(changed)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(_with_periodic_tails(table(spark, sf_dir, "documents")))
    kind = found.schema["runs"].dataType.elementType
    # runs stand by start, then period, so the first of equal exponents is the one wanted
    best = F.aggregate(
        "runs",
        F.lit(None).cast(kind),
        lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b),
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.call_function("div", F.col("best.length") * 1000, F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def _count_of(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id",
        *[_count_of(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_top_k": op1_top_k,
        "op2_decontaminate": op2_decontaminate,
        "op3_toxicity": op3_toxicity,
        "op4_url_filters": op4_url_filters,
        "op5_quality": op5_quality,
        "op6_warc": op6_warc,
        "op7_token_counts": op7_token_counts,
        "op8_jaccard_join": op8_jaccard_join,
        "op9_html_text": op9_html_text,
        "op10_mix_sources": op10_mix_sources,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_secret_scan": op13_secret_scan,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_top_k": OP1_SQL,
        "op4_url_filters": OP4_SQL,
        "op6_warc": OP6_SQL,
        "op11_hard_negatives": OP11_SQL,
    }


OP1_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 64) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
    WHERE q.vec_id % 20 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

# No page of the tables holds a canonical link or a refresh, so there are no aliases.
OP4_SQL = """
WITH parts AS (
    SELECT page_id,
           CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), split AS (
    SELECT page_id,
           translate(regexp_extract(rest, '^[^/?#]*'),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM parts
), rules(verdict, rule_host, rule_path) AS (
    VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
           ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), fits AS (
    SELECT s.page_id, s.host, s.path, r.rule_host || r.rule_path AS rule, r.verdict,
           row_number() OVER (PARTITION BY s.page_id ORDER BY length(r.rule_host || r.rule_path) DESC NULLS LAST) AS n
    FROM split s LEFT JOIN rules r
      ON (s.host = r.rule_host OR ends_with(s.host, '.' || r.rule_host)) AND starts_with(s.path, r.rule_path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE n = 1
"""

# The payload digest in base32 is spelled out from the hex digits, five to four letters.
OP6_SQL = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex,
           max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
    FROM pages
), coded AS (
    SELECT *, list_transform(range(0, 8), lambda i: ('0x' || substr(hex, CAST(i * 5 + 1 AS INTEGER), 5))::BIGINT) AS g
    FROM p
)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(((g[CAST(j // 4 + 1 AS INTEGER)] >> CAST(15 - 5 * (j % 4) AS BIGINT)) & 31) + 1 AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM coded
"""

OP11_SQL = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
           CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v a JOIN v c ON c.vec_id <> a.vec_id AND len(c.v) = len(a.v)
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score
    FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), ranked AS (
    SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
           CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
    FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
    WHERE 100 * s.score BETWEEN 30 * p.positive_score AND 90 * p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""
