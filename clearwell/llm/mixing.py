"""Mixing sources to target weights: Sainte-Laguë apportionment of equal-token blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearwell.llm.common import join_summary, written

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Runs of characters other than space and the controls 9 to 13; null counts 0."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """Target words of each source: ``_key``, ``source_size``, ``target``.

    Sources take the weights in turn, by code point, null last, and share the total.
    A source stops at ``most`` times its size; its excess goes to the others by weight.
    A source is capped exactly when the level at which it fills up lies below the
    common one, so the capped ones are a prefix in the order of size over weight.
    """
    per_source = sizes.groupBy("_key", "_source").agg(F.sum("_size").alias("source_size"))
    # one row a source from here on
    turn = Window.orderBy(F.col("_source").isNull(), "_source")
    cycle = F.array(*[F.lit(int(w)).cast("decimal(38,0)") for w in weights])
    weighed = per_source.withColumn(
        "_w", F.get(cycle, (F.row_number().over(turn) - 1) % len(weights))
    ).withColumn("_cap", F.col("source_size").cast("decimal(38,0)") * most)
    filling = Window.orderBy(F.col("_cap").cast("double") / F.col("_w").cast("double"), "_key")
    everything = Window.partitionBy()
    level = (
        weighed.withColumn("_total", F.sum("source_size").over(everything))
        .withColumn(
            "_left", F.sum("_w").over(filling.rowsBetween(Window.currentRow, Window.unboundedFollowing))
        )
        .withColumn(
            "_before",
            F.coalesce(F.sum("_cap").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        )
        .withColumn(
            "_capped",
            F.col("_cap").cast("double") * F.col("_left").cast("double")
            + F.col("_w").cast("double") * F.col("_before").cast("double")
            < F.col("_w").cast("double") * F.col("_total").cast("double"),
        )
    )
    capped = F.sum(F.when(F.col("_capped"), F.col("_cap"))).over(everything)
    rest = F.sum(F.when(~F.col("_capped"), F.col("_w"))).over(everything)
    shared = (
        (F.col("_total") - F.coalesce(capped, F.lit(0))).cast("double") * F.col("_w").cast("double")
    ) / rest.cast("double")
    return level.select(
        "_key",
        "source_size",
        F.when(F.col("_capped"), F.col("_cap").cast("double"))
        .otherwise(F.coalesce(shared, F.lit(0.0)))
        .alias("target"),
    )


def sainte_lague(votes: DataFrame, seats: Column | int, key: str, weight: str) -> DataFrame:
    """Seats by the highest quotients weight / (2s - 1): ``key``, ``seats`` (long).

    ``seats`` is the house size.  With a divisor d a claimant has floor(w/d + 1/2)
    seats, and the sum lies within half a seat per claimant of total/d.  So the
    seats below one divisor are sure and those beyond another impossible; only the
    few quotients between them are ranked.  Ties go to the smaller key.
    """
    everything = Window.partitionBy()
    w = F.col(weight).cast("double")
    base = votes.where(w > 0).select(
        F.col(key).alias("_k"),
        w.alias("_w"),
        F.sum(w).over(everything).alias("_t"),
        F.count("*").over(everything).alias("_m"),
        (seats if isinstance(seats, Column) else F.lit(seats)).cast("double").alias("_n"),
    )
    sure = F.floor(F.col("_w") * (F.col("_n") - F.col("_m") / 2) / F.col("_t") + 0.5) - 1
    base = base.withColumn("_sure", F.greatest(F.lit(0), sure).cast("long")).withColumn(
        "_most", F.floor(F.col("_w") * (F.col("_n") + F.col("_m") / 2) / F.col("_t") + 0.5).cast("long") + 1
    )
    open_seats = F.col("_n") - F.sum("_sure").over(everything)
    ranked = (
        base.withColumn("_open", open_seats)
        .select("_k", "_w", "_open", "_sure", F.explode(F.sequence(F.col("_sure") + 1, "_most")).alias("_s"))
        .withColumn("_q", F.col("_w") / (F.col("_s") * 2 - 1))
        .withColumn("_r", F.row_number().over(Window.orderBy(F.desc("_q"), "_k")))
    )
    won = ranked.groupBy("_k").agg(
        (F.first("_sure") + F.count(F.when(F.col("_r") <= F.col("_open"), 1))).alias("seats")
    )
    return won.withColumnRenamed("_k", key)


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = (1, 2, 3),
    most: int = 3,
    block_words: int = 32,
    shard_words: int = 16_384,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """How many words the mix takes of every document, repeats counted.

    Returns ``id_col``, ``size``, ``source_size``, ``target``, ``taken``, ``source``.

    1. Sources get targets (`source_targets`) and as many blocks of about
       ``block_words`` words as `sainte_lague` gives them seats.
    2. A source's documents stand in one line: dealt by seeded hash over shards of about
       ``shard_words`` words, in seeded order inside a shard.  The line is cut into
       blocks of equal length, as many as make seats times that length the target.
    3. A shard's quota is an integer, the floor of the seats' running share of the
       blocks up to its end less the same up to its start, so the quotas of a source sum
       to its seats (`shard_quotas`).  In a shard each block is taken quota / blocks
       times, rounded down, and the rest at equal steps from a seeded start.  Counting the
       words before a position is then arithmetic, and no block becomes a row.

    No block is taken more than ``most`` times, nor is a document.  Results depend on
    ids, texts and the seed alone.  A null text or one without words has size 0 and
    takes nothing, without a place in the line; a null source is a source of its own, last
    in turn; rows that repeat an id are dealt each on its own, equal rows too, which are
    counted before they are dealt, so no task holds them all; an empty table gives no
    rows.  Other columns are ignored.
    """
    sizes = written(
        docs.select(
            F.col(id_col).alias("_id"),
            F.col(source_col).alias("_source"),
            F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("n")).alias("_key"),
            word_count(F.col(text_col)).alias("_size"),
            F.xxhash64(text_col).alias("_text"),
        ),
        "mix-sizes",
    )
    targets = written(source_targets(sizes, weights, most), "mix-targets")
    plan = written(_block_plan(targets, block_words, shard_words, most, seed), "mix-plan")
    row = ["_key", "_source", "_id", "_size", "_text"]
    copies = sizes.where("_size > 0").groupBy(*row).agg(F.count("*").alias("_copies"))
    each = copies.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)))
    place = ["_id", "_size", "_text", "_copy"]
    dealt = (
        join_summary(each.drop("_copies"), "_key", plan)
        .withColumn("_hash", F.xxhash64(F.lit(seed), *place))
        .withColumn("_shard", F.pmod(F.xxhash64(F.lit(seed + 1), *place), "_shards"))
    )
    words = dealt.groupBy("_key", "_shard").agg(F.sum("_size").alias("_words"))
    before = _words_before(written(words, "mix-shards")).drop("_words")
    stream = Window.partitionBy("_key", "_shard").orderBy("_hash", *place)
    stream = stream.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        dealt.withColumn("_end", F.sum("_size").over(stream))
        .join(before, ["_key", "_shard"])
        .withColumn("_end", F.col("_before") + F.col("_end"))
    )
    taken = _taken_before(F.col("_end")) - _taken_before(F.col("_end") - F.col("_size"))
    empty = join_summary(sizes.where("_size = 0"), "_key", plan).withColumn("_taken", F.lit(0))
    columns = [*row, "source_size", "target", "_taken"]
    both = placed.withColumn("_taken", taken).select(*columns).unionByName(empty.select(*columns))
    return both.select(
        F.col("_id").alias(id_col),
        F.col("_size").alias("size"),
        "source_size",
        "target",
        F.col("_taken").cast("long").alias("taken"),
        F.col("_source").alias("source"),
    )


def _block_plan(targets: DataFrame, block_words: int, shard_words: int, most: int, seed: int) -> DataFrame:
    """Seats, blocks and shards of each source, from `source_targets`."""
    everything = Window.partitionBy()
    total = F.sum("target").over(everything)
    smallest = F.min(F.when(F.col("target") > 0, F.col("target"))).over(everything)
    house = targets.withColumn("_blocks", F.ceil(F.greatest(total / block_words, total / smallest * 16)))
    seats = sainte_lague(house, F.col("_blocks"), "_key", "target")
    # as many blocks as make a seat worth its share of the target, and enough for the seats
    fitting = F.round(F.col("source_size") * F.col("_quota") / F.nullif(F.col("target"), F.lit(0.0)))
    blocks = F.greatest(F.lit(1), F.coalesce(fitting, F.lit(1)), F.ceil(F.col("_quota") / most)).cast("long")
    return (
        house.join(seats, "_key", "left")
        .select("_key", "source_size", "target", F.coalesce("seats", F.lit(0)).cast("long").alias("_quota"))
        .withColumn("_n", blocks)
        .withColumn("_each", _div(F.col("_quota"), F.col("_n")))
        .withColumn("_more", F.col("_quota") - F.col("_each") * F.col("_n"))
        .withColumn("_start", F.pmod(F.xxhash64(F.lit(seed + 2), "_key"), "_n"))
        .withColumn("_shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long"))
    )


def shard_quotas(plan: DataFrame, shards: DataFrame) -> DataFrame:
    """``_key``, ``_shard``, ``blocks``, ``quota``: what each shard of a source gives to the mix.

    ``shards`` has the words of each (``_key``, ``_shard``, ``_words``).  A block belongs to the
    shard where it starts.
    """

    def first_block(words: Column) -> Column:
        return F.ceil(words.cast("decimal(20,0)") * F.col("_n") / F.col("source_size")).cast("long")

    ends = _words_before(shards).withColumn("_after", F.col("_before") + F.col("_words"))
    own = ends.join(plan, "_key").withColumns({"_b": first_block(F.col("_before")), "_e": first_block(F.col("_after"))})
    quota = F.col("_each") * (F.col("_e") - F.col("_b")) + _extra(F.col("_e")) - _extra(F.col("_b"))
    return own.select("_key", "_shard", (F.col("_e") - F.col("_b")).alias("blocks"), quota.cast("long").alias("quota"))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _words_before(shards: DataFrame, together: int = 4_096) -> DataFrame:
    """The words of a source before each of its shards: ``_key``, ``_shard``, ``_words``, ``_before``.

    Running sums over ``together`` shards and over the sums of those, so that no task
    holds all shards of a large source.
    """
    parts = shards.withColumn("_part", _div(F.col("_shard"), F.lit(together).cast("long")))
    start = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy("_key", "_part").orderBy("_shard").rowsBetween(*start)
    over = Window.partitionBy("_key").orderBy("_part").rowsBetween(*start)
    bases = (
        parts.groupBy("_key", "_part")
        .agg(F.sum("_words").alias("_words"))
        .select("_key", "_part", F.coalesce(F.sum("_words").over(over), F.lit(0)).alias("_base"))
    )
    own = parts.withColumn("_own", F.coalesce(F.sum("_words").over(inside), F.lit(0)))
    return own.join(bases, ["_key", "_part"]).select(
        "_key", "_shard", "_words", (F.col("_base") + F.col("_own")).alias("_before")
    )


def _extra(block: Column) -> Column:
    """Blocks taken once more than the others, among the first ``block`` of a source."""
    n, more, start = (F.col(c).cast("decimal(20,0)") for c in ("_n", "_more", "_start"))
    return _div((block.cast("decimal(20,0)") + start) * more, n) - _div(start * more, n)


def _taken_before(x: Column) -> Column:
    """Words taken among the first x words of a source's line."""
    # products of words and blocks go beyond a long
    n, size = (F.col(c).cast("decimal(20,0)") for c in ("_n", "source_size"))
    words = x.cast("decimal(20,0)") * n
    block = F.coalesce(_div(words, F.nullif(size, F.lit(0))), F.lit(0))
    inside = words - block.cast("decimal(20,0)") * size
    # in n-ths of a word, since blocks need not end at whole words; then to the nearest word
    part = _extra(block).cast("decimal(20,0)") * size + inside * (_extra(block + 1) - _extra(block)).cast("decimal(20,0)")
    return F.col("_each") * x + _div(part * 2 + n, n * 2)
