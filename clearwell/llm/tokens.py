"""Token counts of whole texts; huge ones in overlapping chunks that resynchronise."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from clearwell.llm.common import per_worker, slices, written

#: How byte-level BPE files split text before merging (a fixed value of those tokenizers).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHED_PIECES = 400_000


class PieceCounter:
    """Tokens of a byte-level BPE tokenizer, piece by piece.

    The tokenizer first cuts out its special strings, then splits the rest by a
    pattern that looks ahead but never behind, then encodes every piece on its own.
    So the count of a text is the sum over its pieces, and pieces seen before need no
    second encoding.
    """

    def __init__(self, tokenizer_json: str, pattern: str = PATTERN) -> None:
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.margin = max(map(len, special), default=0) + 2
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.pieces = regex.compile(pattern).findall
        self.known: dict[str, int] = {}

    def _count(self, pieces: list[str]) -> int:
        known = self.known
        try:
            return sum(map(known.__getitem__, pieces))
        except KeyError:
            new = list({p for p in pieces if p not in known})
            if len(known) > CACHED_PIECES:
                known.clear()
                new = list(set(pieces))
            coded = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
            known.update(zip(new, map(len, coded), strict=True))
            return sum(map(known.__getitem__, pieces))

    def segments(self, text: str) -> Iterator[tuple[int, str, bool]]:
        at = 0
        if self.special is not None:
            for m in self.special.finditer(text):
                yield at, text[at : m.start()], False
                yield m.start(), m.group(), True
                at = m.end()
        yield at, text[at:] if at else text, False

    def count(self, text: str) -> int:
        return sum(1 if special else self._count(self.pieces(part)) for _, part, special in self.segments(text))

    def marks(self, text: str, low: int, high: int) -> tuple[list[int], list[int], int]:
        """Piece starts in [low, high) with the tokens before them; the total."""
        at, before, total = [], [], 0
        for start, part, special in self.segments(text):
            for piece in [part] if special else self.pieces(part):
                if low <= start < high:
                    at.append(start)
                    before.append(total)
                total += 1 if special else self._count([piece])
                start += len(piece)
        return at, before, total


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    limit: int = 512,
    chunk_chars: int = 32_768,
    overlap_chars: int = 1_024,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Tokens of every whole text: ``id_col``, ``n_bytes``, ``n_tokens``, ``over_limit``.

    Texts up to ``chunk_chars`` are encoded as they are.  Longer ones are cut into
    chunks that overlap, chunks are encoded wherever Spark puts them, and two
    neighbours are spliced at the first piece boundary that both have in their
    overlap.  Such a boundary is proven: pieces depend on what follows them alone, so
    two scans that both stop there go on alike, and the left chunk's boundaries count
    only so far from its end that nothing beyond could change them.  Where an overlap
    has no common boundary (one endless piece), that text is done again with chunks
    and overlaps four times as wide, until it is one chunk.

    A null text counts as empty: 0 bytes, 0 tokens.  Repeated rows and ids are counted
    each on its own; a null id is kept.  Other columns are ignored.
    """
    spark = docs.sparkSession
    tokenizer = spark.sparkContext.broadcast(Path(tokenizer_path).read_text())
    id_type = to_arrow_type(docs.schema[id_col].dataType)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.concat_ws("-", F.spark_partition_id(), F.monotonically_increasing_id()).alias("row"),
        text.alias("text"),
    )

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer)
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            whole = [len(t) <= chunk_chars for t in texts]
            counts = [counter.count(t) if w else None for t, w in zip(texts, whole, strict=True)]
            left = [None if w else t for t, w in zip(texts, whole, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").cast(id_type), batch.column("n_bytes"), batch.column("row"),
                    pa.array(counts, pa.int64()), pa.array(left, pa.string()),
                ],
                ["id", "n_bytes", "row", "n_tokens", "text"],
            )

    id_name = docs.schema[id_col].dataType.simpleString()
    first = written(
        rows.mapInArrow(first_pass, f"id {id_name}, n_bytes long, row string, n_tokens long, text string"),
        "tokens",
    )
    parts = [first.where("n_tokens IS NOT NULL").select("id", "n_bytes", "n_tokens")]
    open_rows = first.where("n_tokens IS NULL").select("id", "n_bytes", "row", "text")
    while not open_rows.isEmpty():
        spliced = written(_spliced(open_rows, tokenizer, chunk_chars, overlap_chars), "tokens-spliced")
        together = open_rows.join(spliced, "row")
        parts.append(together.where("aligned").select("id", "n_bytes", "n_tokens"))
        open_rows = together.where("NOT aligned").select("id", "n_bytes", "row", "text")
        chunk_chars, overlap_chars = 4 * chunk_chars, 4 * overlap_chars
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def _counter(tokenizer) -> PieceCounter:
    text = tokenizer.value
    return per_worker("pieces", hashlib.sha1(text.encode()).hexdigest(), lambda: PieceCounter(text))


def _spliced(rows: DataFrame, tokenizer, chunk: int, overlap: int) -> DataFrame:
    """``row``, ``n_tokens``, ``aligned`` of long texts by chunks with common boundaries."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist(), strict=True):
                # a tail that the chunk before covers whole needs no chunk of its own
                starts = range(0, max(1, len(text) - overlap), chunk)
                for k, start in enumerate(starts):
                    last = k == len(starts) - 1
                    stop = len(text) if last else start + chunk + overlap
                    yield pa.RecordBatch.from_pylist(
                        [{"row": row, "k": k, "last": last, "text": text[start:stop]}], cut_schema
                    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer)
        for batch in slices(batches):
            out = []
            for r in batch.to_pylist():
                text, shift = r["text"], r["k"] * chunk
                at, before, total = counter.marks(text, 0, len(text))
                head = [i for i, p in enumerate(at) if p < overlap] if r["k"] else []
                safe = len(text) - counter.margin
                tail = [] if r["last"] else [i for i, p in enumerate(at) if chunk <= p <= safe]
                out.append(
                    {
                        "row": r["row"], "k": r["k"], "last": r["last"], "total": total,
                        "head_at": [at[i] + shift for i in head], "head_before": [before[i] for i in head],
                        "tail_at": [at[i] + shift for i in tail], "tail_before": [before[i] for i in tail],
                    }
                )
            yield pa.RecordBatch.from_pylist(out, marks_schema)

    longs = pa.list_(pa.int64())
    cut_schema = pa.schema(
        [("row", pa.string()), ("k", pa.int64()), ("last", pa.bool_()), ("text", pa.string())]
    )
    marks_schema = pa.schema(
        [("row", pa.string()), ("k", pa.int64()), ("last", pa.bool_()), ("total", pa.int64())]
        + [(c, longs) for c in ("head_at", "head_before", "tail_at", "tail_before")]
    )
    chunks = rows.select("row", "text").mapInArrow(cut, "row string, k long, last boolean, text string")
    marks = written(
        chunks.repartition("row", "k").mapInArrow(
            encode,
            "row string, k long, last boolean, total long, head_at array<long>, head_before array<long>,"
            " tail_at array<long>, tail_before array<long>",
        ),
        "tokens-marks",
    )
    left = marks.where("NOT last").select("row", "k", "total", "tail_at", "tail_before")
    right = marks.where("k > 0").select("row", (F.col("k") - 1).alias("k"), "head_at", "head_before")
    seam = F.array_min(F.array_intersect("tail_at", "head_at"))

    def tokens_before(seam_at: str, at: str, before: str):
        return F.get(F.col(before), (F.array_position(at, F.col(seam_at)) - 1).cast("int"))

    seams = (
        left.join(right, ["row", "k"])
        .withColumn("seam", seam)
        .select(
            "row",
            F.col("seam").isNotNull().alias("aligned"),
            (
                tokens_before("seam", "tail_at", "tail_before")
                - F.col("total")
                - tokens_before("seam", "head_at", "head_before")
            ).alias("n"),
        )
    )
    totals = marks.select("row", F.lit(True).alias("aligned"), F.col("total").alias("n"))
    return (
        totals.unionByName(seams)
        .groupBy("row")
        .agg(F.min("aligned").alias("aligned"), F.sum("n").alias("n_tokens"))
    )
