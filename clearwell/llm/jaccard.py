"""N-gram Jaccard self-join: MinHash candidates, Bayesian pruning, exact verification."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from clearwell.llm.common import connected_components, join_summary, slices, written

PRIME = np.uint64(0x9E3779B97F4A7C15)
PAIRS_AT_ONCE = 1 << 18


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams; one of all words if there are fewer; none without words."""
    tokens = text.lower().split() if text else []
    if not tokens:
        return np.zeros(0, np.uint64)
    hashed = {w: xxhash.xxh64_intdigest(w) for w in set(tokens)}
    h = np.fromiter(map(hashed.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
    n = max(1, len(h) - words + 1)
    out = h[:n].copy()
    for i in range(1, min(words, len(h))):
        out *= PRIME
        out += h[i : i + n]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return np.unique(out)


def hash_family(size: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(1)
    a = draw.integers(1, 2**63, size=size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, draw.integers(0, 2**63, size=size, dtype=np.uint64)


def min_hashes(grams: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    a, b = family
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(grams), 2048):  # bounded memory for very long texts
        part = grams[start : start + 2048, None] * a[None, :]
        part += b[None, :]
        np.minimum(least, part.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def least_matches(threshold: float, tolerance: float, steps: Sequence[int]) -> list[int]:
    """For each number n of compared values, the matches below which a pair is dropped.

    With a uniform prior the similarity's posterior after m matches of n is
    Beta(m + 1, n - m + 1), and its mass from the threshold on is the chance of at most
    m successes in n + 1 trials at the threshold.
    """
    out = []
    for n in steps:
        mass = 0.0
        for m in range(n + 1):
            mass += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if mass >= tolerance:
                break
        out.append(m)
    return out


class Pruner:
    """Compares MinHash values step by step and drops pairs that will hardly reach the threshold."""

    def __init__(self, hashes: int, threshold: float, tolerance: float, step: int = 16) -> None:
        self.steps = list(range(step, hashes + 1, step))
        self.least = least_matches(threshold, tolerance, self.steps)

    def keep(self, values: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        matches = np.zeros(len(i), np.int32)
        done = 0
        for n, least in zip(self.steps, self.least, strict=True):
            matches += (values[i, done:n] == values[j, done:n]).sum(axis=1, dtype=np.int32)
            stay = matches >= least
            i, j, matches, done = i[stay], j[stay], matches[stay], n
        return i, j


def within_groups(starts: np.ndarray, at_once: int = PAIRS_AT_ONCE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs i < j inside consecutive groups (bounds in ``starts``), a bounded number at a time."""
    sizes = np.diff(starts)
    # row r is paired with the rows after it in its group
    after = np.repeat(starts[1:], sizes) - np.arange(starts[-1]) - 1
    total = np.cumsum(after)
    begin = 0
    while begin < len(after):
        floor = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, floor + at_once, side="right")))
        count = after[begin:end]
        i = np.repeat(np.arange(begin, end), count)
        offset = np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
        yield i, i + 1 + offset
        begin = end


def spanning(size: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least position reachable from each over the pairs."""
    label = np.arange(size)
    while len(i):
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def _groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Rows sorted by the keys as tables of whole groups, many small groups together."""
    held: list[pa.RecordBatch] = []
    for batch in slices(batches, 1 << 14):
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held)
        last = np.ones(table.num_rows, bool)
        for key in keys:
            column = table.column(key).to_numpy()
            last &= column == column[-1]
        cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
        if cut:
            yield table.slice(0, cut)
            held = table.slice(cut).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _bounds(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    new = np.ones(table.num_rows, bool)
    new[1:] = False
    for key in keys:
        column = table.column(key).to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.append(np.flatnonzero(new), table.num_rows)


def _matrix(column: pa.ChunkedArray, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(-1, width)


def block_pairs(rows: DataFrame, group: str, size: str, block_rows: int, id_col: str = "node") -> DataFrame:
    """Deal groups of any size into tasks of at most about two blocks.

    A group of ``size`` rows has ceil(size / block_rows) blocks by hash of the row's
    id; a row goes once to every pair of blocks that has its own.  Adds ``block``
    (the row's), ``b1`` <= ``b2`` (the pair).
    """
    count = F.ceil(F.col(size) / block_rows).cast("long")
    own = F.pmod(F.xxhash64(F.lit(3), id_col), F.col("_blocks"))
    return (
        rows.withColumn("_blocks", count)
        .withColumn("block", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
        .withColumns({"b1": F.least("block", "_other"), "b2": F.greatest("block", "_other")})
        .drop("_blocks", "_other")
    )


def _cross_only(table: pa.Table, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """In a pair of two blocks only pairs across count: those inside have a task of their own."""
    b1, b2 = table.column("b1").to_numpy(), table.column("b2").to_numpy()
    block = table.column("block").to_numpy()
    fit = (b1[i] == b2[i]) | (block[i] != block[j])
    return i[fit], j[fit]


def jaccard_classes(
    docs: DataFrame,
    threshold: float = 0.8,
    words: int = 5,
    bands: int = 24,
    rows_per_band: int = 4,
    tolerance: float = 1e-9,
    block_rows: int = 1_024,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Similarity classes of documents by Jaccard of their sets of word n-grams.

    Returns a row for every row: ``id_col``, ``rep_id`` (least id with the same set),
    ``class_id`` (least id of all documents reached over links), ``n_links`` (documents
    other than itself whose similarity is ``threshold`` or more, copies included).

    1. One pass over the texts: set digest, ``bands * rows_per_band`` MinHash values,
       band keys.  Rows with one set become one representative with a count.
    2. Representatives that share a band key are candidates (a pair at the threshold
       shares none with a chance of (1 - t^r)^b, 3e-6 here).  Each bucket compares the
       values step by step and drops pairs whose posterior chance of reaching the
       threshold is below ``tolerance``.  Only a spanning forest of what is left
       leaves the bucket, and components of these forests bring candidates together.
    3. In each component the pairs are pruned the same way on the values and the rest
       verified exactly on the sets.  What leaves are counts by document and a
       spanning forest of the verified links; its components are the classes.

    Buckets and components of any size are dealt as pairs of blocks, so no task holds
    more than two blocks and no pair becomes a row.  There is no cap on partners.

    Words are runs without white space in lower case.  A text with fewer words than
    ``words`` has one n-gram of them all.  Rows with a null id or without words link to
    nothing: class and representative are their own id, links 0.  Rows that repeat an
    id are one document with several texts: links between them are not counted.
    Other columns are ignored; an empty table gives no rows.
    """
    hashes = bands * rows_per_band
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_name = docs.schema[id_col].dataType.simpleString()
    kind = to_arrow_type(docs.schema[id_col].dataType)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = hash_family(hashes)
        weave = np.array([0xBF58476D1CE4E5B9 * (i + 1) | 1 for i in range(rows_per_band)], dtype=object)
        weave = np.array([int(w) & (2**64 - 1) for w in weave], dtype=np.uint64)
        for batch in slices(batches):
            digests, keys, values = [], [], []
            for text in batch.column("text").to_pylist():
                grams = shingles(text, words)
                if not len(grams):
                    digests.append(None), keys.append(None), values.append(None)
                    continue
                least = min_hashes(grams, family)
                digests.append(hashlib.blake2b(grams.tobytes(), digest_size=16).hexdigest())
                band = (least.reshape(bands, rows_per_band).astype(np.uint64) * weave).sum(axis=1, dtype=np.uint64)
                band ^= band >> np.uint64(31)
                band = band * np.uint64(0x94D049BB133111EB) + np.arange(bands, dtype=np.uint64) * PRIME
                keys.append(band.view(np.int64))
                # two bytes a value: unequal values agree once in 65,536, which only spares a pair
                values.append(least.astype(np.uint16).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").cast(kind), pa.array(digests, pa.string()), pa.array(keys, pa.list_(pa.int64())), pa.array(values, pa.binary())],
                ["id", "digest", "bands", "values"],
            )

    signed = written(
        rows.mapInArrow(sign, f"id {id_name}, digest string, bands array<long>, values binary"), "jaccard-signed"
    )
    with_set = signed.where("id IS NOT NULL AND digest IS NOT NULL")
    sets = written(
        with_set.groupBy("digest").agg(F.min("id").alias("node"), F.count_distinct("id").alias("copies")), "jaccard-sets"
    )
    # rows that repeat an id and a set fold to one; an id with several sets keeps them all
    folded = with_set.groupBy("digest", F.col("id").alias("node")).agg(
        F.first("bands").alias("bands"), F.first("values").alias("values")
    )
    reps = written(
        folded.join(sets.select("digest", "node"), ["digest", "node"]).select("node", _set_key(), "bands", "values"),
        "jaccard-reps",
    )
    keyed = reps.select("node", "set", F.explode("bands").alias("band"))
    buckets = keyed.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    members = written(join_summary(keyed, "band", buckets), "jaccard-buckets")
    forest = written(
        _bucket_forest(members.join(reps.select("node", "set", "values"), ["node", "set"]), id_name, kind, hashes, threshold, tolerance, block_rows),
        "jaccard-forest",
    )
    near = connected_components(forest)
    # a table whose size Spark knows, so that texts are not shuffled while it is small
    named = written(near.select("node"), "jaccard-near")
    members = near.join(sets.select("node", "copies", "digest"), "node")
    components = members.groupBy("component").agg(F.count("*").alias("size"))
    candidates = written(join_summary(members, "component", components), "jaccard-candidates")
    verified = written(
        _verified(
            rows.withColumnRenamed("id", "node").join(named, "node"), candidates,
            id_name, kind, words, hashes, threshold, tolerance, block_rows,
        ),
        "jaccard-verified",
    )
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    classes = connected_components(
        verified.where("root IS NOT NULL").select("node", F.col("root").alias("other"))
    ).withColumnRenamed("component", "class_id")
    per_set = sets.join(links, "node", "left").join(classes, "node", "left")
    per_set = per_set.select(
        "digest",
        F.col("node").alias("rep_id"),
        F.coalesce("class_id", "node").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
    )
    own = F.when(F.col("id").isNotNull(), F.col("digest"))
    return (
        signed.select("id", own.alias("digest"))
        .join(per_set, "digest", "left")
        .select(
            F.col("id").alias(id_col),
            F.coalesce("rep_id", "id").alias("rep_id"),
            F.coalesce("class_id", "id").alias("class_id"),
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
        )
    )


def _set_key() -> Column:
    """A set's number among those of one id; a clash would only add rows."""
    return F.xxhash64("digest").alias("set")


def _sorted_groups(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.repartition(*keys).sortWithinPartitions(*keys)


def _bucket_forest(members, id_name, kind, hashes, threshold, tolerance, block_rows) -> DataFrame:
    """Edges ``node``, ``root`` that span what survives the pruning in each bucket."""

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pruner = Pruner(hashes, threshold, tolerance)
        for table in _groups(batches, ["band", "b1", "b2"]):
            values = _matrix(table.column("values"), np.uint16, hashes)
            label = np.arange(table.num_rows)
            kept_i, kept_j = [], []
            for i, j in within_groups(_bounds(table, ["band", "b1", "b2"])):
                i, j = pruner.keep(values, *_cross_only(table, i, j))
                kept_i.append(i), kept_j.append(j)
            if kept_i:
                label = spanning(table.num_rows, np.concatenate(kept_i), np.concatenate(kept_j))
            nodes = table.column("node").combine_chunks()
            child = np.flatnonzero(label != np.arange(len(label)))
            yield pa.RecordBatch.from_arrays(
                [_taken(nodes, child, kind), _taken(nodes, label[child], kind)], ["node", "root"]
            )

    dealt = block_pairs(members, "band", "size", block_rows, "set").select("band", "b1", "b2", "block", "node", "values")
    edges = _sorted_groups(dealt, ["band", "b1", "b2"]).mapInArrow(prune, f"node {id_name}, root {id_name}")
    return edges.distinct()


def _taken(nodes, at: np.ndarray, kind) -> pa.Array:
    out = nodes.take(pa.array(at, pa.int64()))
    out = pa.concat_arrays(out.chunks) if isinstance(out, pa.ChunkedArray) else out
    return out.cast(kind)


def _verified(rows, candidates, id_name, kind, words, hashes, threshold, tolerance, block_rows) -> DataFrame:
    """``node``, ``links`` (documents), ``root`` (a linked node, or null) after exact verification."""

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = hash_family(hashes)
        seen: set[tuple] = set()  # of this task's last rows; what comes again later folds below
        for batch in slices(batches):
            digests, values, grams = [], [], []
            for node, text in zip(batch.column("node").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = shingles(text, words)
                digest = hashlib.blake2b(own.tobytes(), digest_size=16)
                if not len(own) or (node, digest.digest()) in seen:
                    digests.append(None), values.append(None), grams.append(None)
                    continue
                if len(seen) >= 1 << 16:
                    seen.clear()
                seen.add((node, digest.digest()))
                digests.append(digest.hexdigest())
                values.append(min_hashes(own, family).astype(np.uint16).tobytes())
                grams.append(own.tobytes())
            out = pa.RecordBatch.from_arrays(
                [batch.column("node").cast(kind), pa.array(digests, pa.string()), pa.array(values, pa.binary()), pa.array(grams, pa.binary())],
                ["node", "digest", "values", "grams"],
            )
            yield out.filter(out.column("digest").is_valid())

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pruner = Pruner(hashes, threshold, tolerance)
        for table in _groups(batches, keys):
            values = _matrix(table.column("values"), np.uint16, hashes)
            grams = [np.frombuffer(g, np.uint64) for g in table.column("grams").to_pylist()]
            copies = table.column("copies").to_numpy()
            ids = table.column("node").combine_chunks()
            number = np.unique(np.array(ids.to_pylist(), dtype=object), return_inverse=True)[1]
            size = np.array([len(g) for g in grams])
            links = np.zeros(len(grams), np.int64)
            kept_i, kept_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for i, j in within_groups(_bounds(table, keys)):
                i, j = _cross_only(table, i, j)
                other = number[i] != number[j]
                i, j = pruner.keep(values, i[other], j[other])
                # sizes that far apart cannot be similar
                fit = np.minimum(size[i], size[j]) >= threshold * np.maximum(size[i], size[j]) - 1e-9
                i, j = i[fit], j[fit]
                same = exact_similar(grams, size, i, j, threshold)
                i, j = i[same], j[same]
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                kept_i.append(i), kept_j.append(j)
            label = spanning(len(grams), np.concatenate(kept_i), np.concatenate(kept_j))
            child = label != np.arange(len(label))
            told = np.flatnonzero(child | (links > 0))
            roots = _taken(ids, label[told], kind)
            yield pa.RecordBatch.from_arrays(
                [
                    _taken(ids, told, kind), pa.array(links[told], pa.int64()),
                    pa.array([r if c else None for r, c in zip(roots.to_pylist(), child[told], strict=True)], kind),
                ],
                ["node", "links", "root"],
            )

    keys = ["component", "b1", "b2"]
    measured = rows.select("node", "text").mapInArrow(
        sets_of, f"node {id_name}, digest string, values binary, grams binary"
    )
    # an id may repeat with a text that it does not represent, and with one that it does
    folded = measured.groupBy("node", "digest").agg(F.first("values").alias("values"), F.first("grams").alias("grams"))
    own = folded.join(candidates, ["node", "digest"]).withColumn("set", _set_key())
    dealt = block_pairs(own, "component", "size", block_rows, "set")
    dealt = dealt.select("component", "b1", "b2", "block", "node", "copies", "values", "grams")
    return _sorted_groups(dealt, keys).mapInArrow(verify, f"node {id_name}, links long, root {id_name}")


def exact_similar(grams: list[np.ndarray], size: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Whether |a & b| >= threshold * |a | b| for pairs sorted by i: one row's set is marked, its partners' looked up."""
    out = np.zeros(len(i), bool)
    if not len(i):
        return out
    used = np.unique(np.concatenate([i, j]))
    number = np.unique(np.concatenate([grams[x] for x in used]), return_inverse=True)[1].astype(np.int32)
    parts = dict(zip(used.tolist(), np.split(number, np.cumsum(size[used])[:-1]), strict=True))
    mark = np.zeros(int(number.max()) + 1, bool)
    first = np.append(np.flatnonzero(np.append(True, i[1:] != i[:-1])), len(i))
    for begin, end in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        own = parts[int(i[begin])]
        mark[own] = True
        partners = j[begin:end]
        found = mark[np.concatenate([parts[y] for y in partners.tolist()])]
        lengths = size[partners]
        common = np.add.reduceat(found.astype(np.int64), np.cumsum(lengths) - lengths)
        out[begin:end] = common >= threshold * (len(own) + lengths - common) - 1e-9
        mark[own] = False
    return out
