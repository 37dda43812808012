"""Secrets in texts: fixed patterns, and random strings told by character Markov models."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearwell.llm.common import written


@dataclass(frozen=True)
class Pattern:
    """A kind of secret: matches, leftmost first, whose ``group`` has ``least`` characters."""

    kind: str
    regex: str
    group: int = 0
    least: int = 0


#: Fixed patterns.  A run shorter than the bound cannot hold a longer one, so the bounds
#: of the last two stand in the pattern.
BASE = (
    Pattern(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    Pattern("access", r"AKIA[A-Z0-9]{16,}"),
    Pattern("hex", r"[0-9a-f]{24,}"),
)
#: What the models judge: unbroken strings of the alphabet of keys.
CANDIDATE = Pattern("random", r"[A-Za-z0-9+/_-]{16,}={0,2}")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
WIDTH = len(ALPHABET) + 1
#: Words, identifiers and numbers.
TOKEN = r"[A-Za-z0-9+/_-]{4,}"


def _code(letter: Column) -> Column:
    """1 + its place in `ALPHABET`; 0, the start of a string, for any other character."""
    return F.instr(F.lit(ALPHABET), letter)


@dataclass(frozen=True)
class MarkovRatio:
    """log P(next | last, random) - log P(next | last, ordinary) in thousandths, row by row.

    One table a kind of random strings.  Row 0 is the start of a string; row and column
    i + 1 are character i of `ALPHABET`.
    """

    thousandths: tuple[tuple[int, ...], ...]

    def ratio(self, text: Column) -> Column:
        """The greatest log-likelihood ratio of a string, summed over its characters, in thousandths."""
        ratios = []
        for own in self.thousandths:
            table = F.split(F.lit(",".join(map(str, own))), ",").cast("array<int>")
            summed = F.aggregate(
                F.split(text, ""),
                F.struct(F.lit(0).alias("last"), F.lit(0).cast("long").alias("total")),
                lambda seen, c: F.struct(
                    _code(c).alias("last"),
                    (seen["total"] + F.get(table, seen["last"] * WIDTH + _code(c))).alias("total"),
                ),
            )
            ratios.append(summed["total"])
        return F.greatest(*ratios) if len(ratios) > 1 else ratios[0]


def fit_markov(labelled: DataFrame, smoothing: float = 0.5) -> MarkovRatio:
    """First-order character models from rows ``text``, ``label``.

    Label 0 is ordinary; each of the others is a kind of random strings.
    Transitions are counted over all rows given and smoothed; a null text counts
    nothing, and a class without rows is a uniform model.
    """
    codes = F.transform(F.split("text", ""), _code)
    rows = labelled.where("text <> ''").select("label", codes.alias("codes"))
    steps = F.zip_with(
        F.concat(F.array(F.lit(0)), F.slice("codes", 1, F.size("codes") - 1)), "codes", lambda a, b: a * WIDTH + b
    )
    counted = rows.select("label", F.explode(steps).alias("step")).groupBy("label", "step").count()
    counts: dict[int, list[float]] = {}
    for r in counted.collect():  # WIDTH * WIDTH a label at most
        counts.setdefault(r["label"], [0.0] * (WIDTH * WIDTH))[r["step"]] = float(r["count"])

    def logs(label: int) -> list[float]:
        own, out = counts.get(label, [0.0] * (WIDTH * WIDTH)), []
        for at in range(0, WIDTH * WIDTH, WIDTH):
            total = sum(own[at : at + WIDTH]) + smoothing * WIDTH
            out += [math.log((c + smoothing) / total) for c in own[at : at + WIDTH]]
        return out

    ordinary = logs(0)
    kinds = sorted(set(counts) - {0}) or [1]
    return MarkovRatio(
        tuple(tuple(round(1000 * (r - o)) for r, o in zip(logs(k), ordinary, strict=True)) for k in kinds)
    )


def _matches(docs: DataFrame, id_col: str, text_col: str, patterns: Sequence[Pattern]) -> DataFrame:
    """``_row``, ``_id`` and, for each pattern that matches, its hits and the gaps before them."""
    hits = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(id_col).alias("_id"),
        F.col(text_col).alias("_text"),
        *[F.regexp_extract_all(text_col, F.lit(p.regex), F.lit(0)).alias(f"_h{k}") for k, p in enumerate(patterns)],
    )
    kinds = [
        F.when(
            F.size(f"_h{k}") > 0,
            F.struct(
                F.lit(k).alias("kind"),
                F.transform(F.split("_text", p.regex, -1), F.char_length).alias("gaps"),
                F.col(f"_h{k}").alias("hits"),
            ),
        )
        for k, p in enumerate(patterns)
    ]
    return hits.select("_row", "_id", F.array_compact(F.array(*kinds)).alias("kinds"))


def _placed(matches: DataFrame, patterns: Sequence[Pattern]) -> DataFrame:
    """One row a valid match: ``_row``, ``kind``, ``start``, ``stop`` (code points), ``value``."""
    own = matches.select("_row", F.explode("kinds").alias("k")).select(
        "_row",
        F.col("k.kind").alias("kind"),
        F.posexplode(F.arrays_zip(F.slice("k.gaps", 1, F.size("k.hits")).alias("gap"), F.col("k.hits").alias("hit"))).alias("at", "m"),
    )
    line = Window.partitionBy("_row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.char_length("m.hit")
    stop = F.sum(F.col("m.gap") + size).over(line)
    placed = own.repartition("_row").select(
        "_row", "kind", (stop - size).alias("start"), stop.alias("stop"), F.col("m.hit").alias("value")
    )
    value, valid = F.col("value"), F.lit(True)
    for k, p in enumerate(patterns):
        if p.group or p.least:
            group = F.regexp_extract("value", p.regex, p.group)
            value = F.when(F.col("kind") == k, group).otherwise(value)
            valid = valid & ((F.col("kind") != k) | (F.char_length(group) >= p.least))
    return placed.where(valid).withColumn("value", value)


def labelled_strings(
    docs: DataFrame,
    secrets: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    fit_docs: int = 4_000,
    fit_strings: int = 20_000,
) -> DataFrame:
    """Rows ``text``, ``label`` to learn from, from at most ``fit_strings`` strings of each origin.

    Label 0: distinct words, identifiers and numbers of at most ``fit_docs`` texts outside
    what the fixed patterns find, and numbers of 4 to 19 digits made from a quarter of
    them, since account and telephone numbers are no keys.  Labels 1 to 4, by alphabet (hexadecimal in small
    letters, in capitals, capitals with digits, any): distinct ``value`` of ``secrets``, the
    rows that the fixed patterns found; and, since a corpus holds few kinds of secrets,
    digests of the label 0 strings.  All are chosen by hash, so reruns agree.
    """

    def first(rows: DataFrame, most: int) -> DataFrame:
        rows = rows.distinct()
        return rows.orderBy(F.xxhash64(F.lit(5), "text"), "text").limit(most)

    draw = F.pmod(F.xxhash64(F.lit(3), id_col, F.char_length(text_col)), F.lit(1 << 30))
    usable = docs.where(F.col(text_col) != "")
    share = min(1.0, 1.5 * fit_docs / max(1, usable.select(id_col).count()))
    some = usable.where(draw < share * (1 << 30)).orderBy(draw, id_col).limit(fit_docs)
    rest = F.col(text_col)
    for p in BASE:
        rest = F.regexp_replace(rest, p.regex, " ")
    tokens = some.select(F.explode(F.regexp_extract_all(rest, F.lit(TOKEN), F.lit(0))).alias("text"))
    words = written(first(tokens, fit_strings), "ordinary-strings")
    size = F.pmod(F.xxhash64(F.lit(9), "text"), F.lit(28)).cast("int")
    number = F.substr(F.regexp_replace(F.xxhash64(F.lit(7), "text").cast("string"), "-", ""), F.lit(1), 2 * size + 4)
    ordinary = words.unionByName(words.where(size < 7).select(number.alias("text")))
    digest = F.unhex(F.sha2("text", 256))
    length = size + 16
    plain = F.translate(F.base64(digest), "+/=", "")
    forms = F.array(F.lower(F.hex(digest)), F.hex(digest), F.upper(plain), F.base64(digest), plain)
    made = words.select(F.explode(F.transform(forms, lambda f: F.substr(f, F.lit(1), length))).alias("text"))
    random = first(secrets.select(F.col("value").alias("text")), fit_strings).unionByName(first(made, fit_strings))
    kind = (
        F.when(F.col("text").rlike("^[0-9a-f]+$"), 1)
        .when(F.col("text").rlike("^[0-9A-F]+$"), 2)
        .when(F.col("text").rlike("^[0-9A-Z]+$"), 3)
        .otherwise(4)
    )
    return ordinary.withColumn("label", F.lit(0)).unionByName(random.withColumn("label", kind))


def scan_secrets(
    docs: DataFrame,
    least_ratio: float = 10.0,
    labelled: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    fit: Mapping[str, int] | None = None,
) -> DataFrame:
    """Secrets of every whole text: ``id_col`` and ``spans``, in text order.

    A span has ``start`` and ``stop`` (code points, end exclusive), ``rank`` (place of
    its kind among ``assign``, ``access``, ``hex``, ``random``), ``kind`` and ``ratio``.
    The first three kinds are the fixed patterns of `BASE`, matched from the left
    without overlap, each for itself.  A ``random`` span is a string of the key alphabet
    of 16 characters or more that touches none of them and whose log-likelihood ratio
    between a Markov model of random strings and that of ordinary ones reaches
    ``least_ratio`` (natural logarithms; null for fixed patterns).  The models learn from
    ``labelled`` (``text``, ``label``) or, by default, from `labelled_strings`.

    Native throughout: one pass over the texts extracts matches and the lengths of the
    gaps before them; what follows handles matches alone, one row each.  A text with
    very many matches is sorted, not gathered, until its list is built.

    A null or empty text has an empty list; rows that repeat an id are scanned each on its
    own, a null id too; other columns are ignored; an empty table gives no rows.
    """
    patterns = (*BASE, CANDIDATE)
    random = len(BASE)
    found = written(_matches(docs.select(id_col, text_col), id_col, text_col, patterns), "secret-matches")
    spans = written(_placed(found.where(F.size("kinds") > 0), patterns), "secret-spans")
    if labelled is None:
        labelled = labelled_strings(docs, spans.where(F.col("kind") < random), text_col, id_col, **(fit or {}))
    model = fit_markov(labelled)
    ratio = F.when(F.col("kind") == random, model.ratio(F.col("value")))
    likely = spans.withColumn("ratio", ratio).where((F.col("kind") < random) | (F.col("ratio") >= 1000 * least_ratio))
    before = Window.partitionBy("_row").orderBy("start", "kind")
    after = Window.partitionBy("_row").orderBy(F.desc("start"), F.desc("kind"))
    fixed = F.col("kind") < random
    apart = (
        likely.repartition("_row")
        .withColumn("_left", F.max(F.when(fixed, F.col("stop"))).over(before.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_right", F.min(F.when(fixed, F.col("start"))).over(after.rowsBetween(Window.unboundedPreceding, 0)))
        .where(
            fixed
            | (
                (F.coalesce("_left", F.lit(0)) <= F.col("start"))
                & (F.coalesce(F.col("_right"), F.col("stop")) >= F.col("stop"))
            )
        )
    )
    name = F.get(F.array(*[F.lit(p.kind) for p in patterns]), F.col("kind"))
    span = F.struct(
        F.col("start").cast("long").alias("start"),
        F.col("kind").alias("rank"),
        F.col("stop").cast("long").alias("stop"),
        name.alias("kind"),
        (F.col("ratio") / 1000).alias("ratio"),
    )
    lists = apart.groupBy("_row").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    with_any = found.where(F.size("kinds") > 0).select("_row", "_id").join(lists, "_row", "left")
    none = F.array().cast(lists.schema["spans"].dataType)
    return (
        with_any.select(F.col("_id").alias(id_col), F.coalesce("spans", none).alias("spans"))
        .unionByName(
            found.where(F.coalesce(F.size("kinds"), F.lit(0)) <= 0).select(F.col("_id").alias(id_col), none.alias("spans"))
        )
    )
