"""Hard negatives by exact window search in a multiway hyperplane tree (GNAT)."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clearwell.llm.common import written
from clearwell.llm.vectors import Best, list_parts, matrices, narrowed, products, quantised

#: Added to either end of a range, far above the error of a computed angle.
SLACK = 1e-6


class Sphere:
    """Angles between vectors lifted onto a sphere of radius ``reach``, the greatest norm.

    A row x gets one more coordinate, sqrt(reach^2 - |x|^2), and a query has 0 there.
    Then cos(query, row) = inner product / (|query| reach): a window of scores is a
    window of angles, and angles on a sphere obey the triangle inequality.
    """

    def __init__(self, reach: float) -> None:
        self.reach = max(reach, 1.0) * (1 + 1e-9)

    def between(self, rows: np.ndarray, others: np.ndarray) -> np.ndarray:
        a, b = rows.astype(np.float64), others.astype(np.float64)
        square = self.reach * self.reach
        lift_a = np.sqrt(np.maximum(0, square - (a * a).sum(axis=1)))
        lift_b = np.sqrt(np.maximum(0, square - (b * b).sum(axis=1)))
        return np.arccos(np.clip((a @ b.T + lift_a[:, None] * lift_b[None, :]) / square, -1, 1))

    def from_scores(self, scores: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """Angles of inner products with queries of these norms; a zero query is at a right angle."""
        with np.errstate(divide="ignore", invalid="ignore"):
            cosine = np.where(norms > 0, scores / (norms * self.reach), 0.0)
        return np.arccos(np.clip(cosine, -1, 1))


def far_apart(sphere: Sphere, x: np.ndarray, count: int) -> np.ndarray:
    """Places of up to ``count`` rows, each the farthest from those before; distinct rows only."""
    chosen = [0]
    nearest = sphere.between(x, x[:1])[:, 0]
    while len(chosen) < count:
        at = int(nearest.argmax())
        if nearest[at] <= SLACK:
            break
        chosen.append(at)
        nearest = np.minimum(nearest, sphere.between(x, x[at : at + 1])[:, 0])
    return np.array(chosen)


def plant(sphere: Sphere, x: np.ndarray, fan_out: int, leaf_rows: int) -> tuple[np.ndarray, tuple]:
    """(order of the rows, tree over them as plain tuples).

    A leaf is (start, stop), rows of that order.  A node has also its split points, the
    least and greatest angle [i, j] between split point i and the rows of child j, and
    the children.  A node's rows go to the nearest of ``fan_out`` split points.  Rows
    that no split point tells apart, copies, stay in one leaf.
    """
    order = np.arange(len(x))

    def grow(start: int, stop: int) -> tuple:
        own = order[start:stop]
        if stop - start <= leaf_rows:
            return (start, stop)
        some = own[:: max(1, len(own) // (8 * fan_out))]
        splits = some[far_apart(sphere, x[some], fan_out)]
        if len(splits) < 2:  # of all rows then
            splits = own[far_apart(sphere, x[own], fan_out)]
        if len(splits) < 2:
            return (start, stop)
        angles = sphere.between(x[splits], x[own])
        child = angles.argmin(axis=0)
        by_child = np.argsort(child, kind="stable")
        order[start:stop] = own[by_child]
        ends = np.cumsum(np.bincount(child, minlength=len(splits)))
        starts = np.concatenate([[0], ends[:-1]])
        low = np.stack([angles[:, child == j].min(axis=1) for j in range(len(splits))], axis=1)
        high = np.stack([angles[:, child == j].max(axis=1) for j in range(len(splits))], axis=1)
        children = tuple(grow(start + int(a), start + int(b)) for a, b in zip(starts, ends, strict=True))
        return (start, stop, x[splits], low, high, children)

    return order, grow(0, len(x))


def meets(angle: np.ndarray, inner: np.ndarray, outer: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Whether rows at angles [low, high] from a split point can lie in a query's annulus.

    The split point is at ``angle`` from the query, the annulus reaches from ``inner``
    to ``outer``; the triangle inequality bounds the row's angle to the split point.
    """
    least = np.maximum(angle - outer, inner - angle) - SLACK
    most = np.minimum(angle + outer, 2 * np.pi - angle - inner) + SLACK
    return (least <= high) & (most >= low)


@dataclass
class Queries:
    """Anchors, and windows of scores [low, high] around them, ``k`` rows wanted in each.

    ``same``: rows of the anchor's label are wanted; else rows of another label.
    """

    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    anchor: np.ndarray  # place of each window's anchor
    low: np.ndarray
    high: np.ndarray
    same: bool
    k: int


class Search:
    """All windows over one block of rows after the other; floors rise from block to block."""

    def __init__(self, sphere: Sphere, queries: Queries, together: int = 2048) -> None:
        self.sphere, self.q, self.together = sphere, queries, together
        self.best = Best(len(queries.anchor), queries.k)
        self.norms = np.sqrt((queries.x.astype(np.float64) ** 2).sum(axis=1))
        self.scored = self.possible = 0

    def _annulus(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Inner and outer angle of windows; only rows that reach the floor still matter."""
        norms = self.norms[self.q.anchor[w]]
        least = np.maximum(self.q.low[w], self.best.floor[w])
        inner = self.sphere.from_scores(self.q.high[w].astype(np.float64), norms)
        outer = self.sphere.from_scores(least.astype(np.float64), norms)
        none = norms == 0
        return np.where(none, 0.0, inner), np.where(none, np.pi, outer)

    def _angles(self, w: np.ndarray, points: np.ndarray) -> np.ndarray:
        anchors, back = np.unique(self.q.anchor[w], return_inverse=True)
        self.scored += len(points) * len(w)
        scores = products(self.q.x[anchors], points)
        return self.sphere.from_scores(scores.astype(np.float64), self.norms[anchors][:, None])[back]

    def block(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, tree: tuple, points: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """Rows in tree order; ``low``, ``high``: ranges of their angles to the split ``points`` above."""
        self.possible += len(ids) * len(self.q.anchor)
        for at in range(0, len(self.q.anchor), self.together):
            w = np.arange(at, min(at + self.together, len(self.q.anchor)))
            w = w[self.q.low[w] <= self.q.high[w]]
            if len(w) and len(points):
                inner, outer = self._annulus(w)
                w = w[meets(self._angles(w, points), inner[:, None], outer[:, None], low, high).all(axis=1)]
            todo = [(tree, w)]
            while todo:
                node, w = todo.pop()
                if not len(w):
                    continue
                if len(node) == 2:
                    self._leaf(ids, labels, x, *node, w)
                    continue
                inner, outer = self._annulus(w)
                angle = self._angles(w, node[2])
                for j, child in enumerate(node[5]):
                    inside = meets(angle, inner[:, None], outer[:, None], node[3][:, j], node[4][:, j]).all(axis=1)
                    todo.append((child, w[inside]))
        self.best.settle()

    def _leaf(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, start: int, stop: int, w: np.ndarray) -> None:
        self.scored += (stop - start) * len(w)
        anchors, back = np.unique(self.q.anchor[w], return_inverse=True)
        scores = products(self.q.x[anchors], x[start:stop])
        fits = labels[None, start:stop] == self.q.labels[anchors][:, None]
        if not self.q.same:
            fits = ~fits
        fits &= ids[None, start:stop] != self.q.ids[anchors][:, None]
        scores, fits = scores[back], fits[back]
        least = np.maximum(self.q.low[w], self.best.floor[w])
        which, row = np.nonzero(fits & (scores >= least[:, None]) & (scores <= self.q.high[w][:, None]))
        self.best.add(w[which], scores[which, row], ids[start + row])


def build_index(rows: DataFrame, sample: pa.Table, reach: float, split_points: int, block_rows: int, fan_out: int, leaf_rows: int) -> tuple[DataFrame, dict[int, np.ndarray]]:
    """A table of blocks, each one row: at most about ``block_rows`` rows and the tree over them.

    The split points at the top come from the sample; every row goes to the nearest.
    A crowded part is dealt over as many blocks as it needs, by hash of the id.
    """
    sphere = Sphere(reach)
    points = {
        size: x[far_apart(sphere, x, max(1, min(split_points, len(x) // 8)))] for size, (_, _, x) in matrices(sample).items()
    }

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, starts, sizes = list_parts(batch.column(2))
            part = np.zeros(batch.num_rows, np.int64)
            for size, own_points in points.items():
                own = np.flatnonzero(sizes == size)
                for at in range(0, len(own), 4096):
                    some = own[at : at + 4096]
                    x = flat[starts[some][:, None] + np.arange(size)[None, :]]
                    part[some] = sphere.between(x, own_points).argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sizes, pa.int64()), pa.array(part)], ["id", "label", "v", "dims", "part"]
            )

    dealt = written(
        rows.mapInArrow(deal, "id long, label long, v array<long>, dims long, part long"), "negatives-dealt"
    )
    counts = dealt.groupBy("dims", "part").agg(F.count("*").alias("rows"))
    counts = counts.select("dims", "part", F.ceil(F.col("rows") / block_rows).cast("long").alias("blocks"))
    total = counts.agg(F.sum("blocks").alias("n")).head()["n"] or 0
    tasks = max(1, min(2000, -(-total // 8)), -(-total // 128))
    salted = dealt.join(F.broadcast(counts), ["dims", "part"]) if total < 100_000 else dealt.join(counts, ["dims", "part"])
    salted = salted.withColumn("salt", F.pmod(F.xxhash64(F.lit(17), "id"), F.col("blocks"))).drop("blocks")

    def build(block: pa.Table) -> pa.Table:
        block = block.sort_by("id")
        ((size, (ids, labels, x)),) = matrices(block).items()
        order, tree = plant(sphere, x, fan_out, leaf_rows)
        above = points.get(size, x[:0])
        angles = sphere.between(above, x) if len(above) else np.zeros((0, len(x)))
        content = (ids[order], labels[order], narrowed(x[order]), tree, angles.min(axis=1), angles.max(axis=1))
        return pa.table({"dims": pa.array([size], pa.int64()), "block": pa.array([pickle.dumps(content)], pa.binary())})

    blocks = (
        salted.repartition(tasks, "dims", "part", "salt")
        .groupBy("dims", "part", "salt")
        .applyInArrow(build, "dims long, block binary")
    )
    return written(blocks, "negatives-index"), points


def search_index(index: DataFrame, points: dict[int, np.ndarray], reach: float, queries: dict[int, Queries]) -> DataFrame:
    """``dims``, ``window``, ``score``, ``row``: at most k rows a window and task, the best among them."""
    known = index.sparkSession.sparkContext.broadcast((reach, points, {n: vars(q) for n, q in queries.items()}))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach, points, fields = known.value
        sphere = Sphere(reach)
        searches = {n: Search(sphere, Queries(**f)) for n, f in fields.items()}
        for batch in batches:
            for size, block in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if size in searches:
                    ids, labels, x, tree, low, high = pickle.loads(block.as_buffer())
                    searches[size].block(ids, labels, x, tree, points.get(size, x[:0]), low, high)
        for size, done in searches.items():
            best = done.best
            if len(best.window):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(best.window), size)), *map(pa.array, (best.window, best.score, best.row))],
                    ["dims", "window", "score", "row"],
                )

    return index.mapInArrow(look, "dims long, window long, score long, row long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("dims", "window").orderBy(F.desc("score"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine_hard_negatives(
    vectors: DataFrame,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
    every: int = 100,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    fit_rows: int = 2_048,
    split_points: int = 64,
    block_rows: int = 4_096,
    fan_out: int = 8,
    leaf_rows: int = 64,
    query_bytes: int = 16 << 20,
) -> DataFrame:
    """Rows of another label that score between ``low`` and ``high`` per cent of a positive.

    Vectors are made integer (`quantised`); a score is an inner product.  Anchors are the
    rows whose id is divisible by ``every``.  An anchor's positives are its ``positives``
    best other rows of the same label.  For each of them, the ``negatives`` best rows of
    another label with low * positive score <= 100 * score <= high * positive score:
    ``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score``,
    ``negative_score``.  Ties go to the smaller id; fewer rows are given if there are fewer.

    Every row is in the index: split points from ``fit_rows`` rows divide the rows into
    parts, parts are dealt into blocks, and each block is planted as a GNAT-style tree of
    ``fan_out`` split points a node and ``leaf_rows`` rows a leaf, with the range of angles
    between each split point and each sibling subtree.  A search visits every block
    and subtree whose ranges meet a window's annulus, and scores leaves exactly, so
    nothing is lost.  Blocks are rows of a written table that a search scans in place;
    anchors come to them in batches of at most ``query_bytes`` of vectors, through the
    driver, as a broadcast variable.  At most k rows a window leave a task.  A hot vector or
    label only makes more blocks.

    Rows with a null id, label or vector and those with a null, empty or non-finite
    vector take no part; of rows that repeat an id the one with the least (label, vector)
    does; vectors of other lengths never meet; other columns are ignored; an empty
    table gives no rows.
    """
    usable = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("long").alias("label"),
        quantised(F.col(vector_col), scale).alias("v"),
    ).where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    one = usable.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r"))
    rows = written(one.select("id", "r.label", "r.v"), "negatives-rows")
    square = F.aggregate("v", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double"))
    is_anchor = F.col("id") % every == 0
    size = rows.agg(
        F.max(square).alias("square"),
        F.sum(F.when(is_anchor, F.size("v")).cast("long")).alias("components"),
    ).head()
    reach = float(np.sqrt(size["square"] or 0.0))
    sample = rows.orderBy(F.xxhash64(F.lit(23), "id"), "id").limit(fit_rows).toArrow()
    index, points = build_index(rows, sample, reach, split_points, block_rows, fan_out, leaf_rows)
    batches = max(1, -(-8 * (size["components"] or 0) // query_bytes))
    spark = vectors.sparkSession
    shape = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    out = spark.createDataFrame([], shape)
    for batch in range(batches):
        mine = is_anchor & (F.pmod(F.xxhash64(F.lit(29), "id"), F.lit(batches)) == batch)
        anchors = matrices(rows.where(mine).toArrow())
        if anchors:
            out = out.unionByName(_mine_batch(index, points, reach, anchors, positives, negatives, low, high))
    return out


def _mine_batch(index: DataFrame, points: dict, reach: float, anchors: dict, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    spark = index.sparkSession
    edge = np.iinfo(np.int64)
    wanted = {}
    for size, (ids, labels, x) in anchors.items():
        free = np.full(len(ids), edge.min), np.full(len(ids), edge.max)
        wanted[size] = Queries(ids, labels, x, np.arange(len(ids)), *free, True, positives)
    first = written(_ranked(search_index(index, points, reach, wanted), positives), "negatives-positives")
    found = first.select("dims", "window", "score", "row").toArrow()  # at most ``positives`` an anchor
    dims, window, score, row = (found.column(c).to_numpy() for c in ("dims", "window", "score", "row"))
    windows, pairs = {}, []
    for size, (ids, labels, x) in anchors.items():
        own = dims == size
        keys, place = np.unique(np.stack([window[own], score[own]]), axis=1, return_inverse=True)
        place = place.reshape(-1)
        least, most = -((-low * keys[1]) // 100), (high * keys[1]) // 100
        windows[size] = Queries(ids, labels, x, keys[0], least, most, False, negatives)
        pairs.append(
            pa.table(
                {
                    "dims": dims[own], "window": place.astype(np.int64), "anchor_id": ids[window[own]],
                    "positive_id": row[own], "positive_score": score[own],
                }
            )
        )
    second = _ranked(search_index(index, points, reach, windows), negatives)
    positive = spark.createDataFrame(pa.concat_tables(pairs))
    chosen = second.join(positive, ["dims", "window"])
    return written(
        chosen.select(
            "anchor_id",
            "positive_id",
            F.col("rank").cast("int").alias("rank"),
            F.col("row").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        ),
        "negatives-found",
    )
