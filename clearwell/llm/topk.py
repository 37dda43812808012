"""Exact top-k inner products by no-random-access aggregation of sorted lists."""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clearwell.llm.common import written
from clearwell.llm.vectors import Best, exact_type, list_parts, narrowed, products, quantised

#: Depths, as shares of a list, after which bounds are compared.
DEPTHS = (1 / 4, 3 / 8, 1 / 2, 5 / 8, 3 / 4, 7 / 8)


class SortedLists:
    """A block of rows as one list a component: (row, value), sorted by value.

    A list is read from its top for queries with a positive component there and from its
    bottom for the others.  ``high`` holds what has been read from the tops, and for a row
    that has not come up in a list yet the value read last, which bounds it; ``low``
    the same from the bottoms.
    """

    def __init__(self, order: np.ndarray, values: np.ndarray) -> None:
        self.order, self.values = order, values  # lists by rows, least value first
        self.n = order.shape[1]

    @classmethod
    def of(cls, x: np.ndarray) -> SortedLists:
        order = np.argsort(x, axis=0, kind="stable").T
        small = np.int16 if len(x) < 1 << 15 else np.int64
        return cls(order.astype(small), narrowed(np.take_along_axis(x.T, order, axis=1)))

    def read(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        """(high, low) after ``count`` entries of each list from either end."""
        shape = (self.n, len(self.order))
        high = np.repeat(self.values[:, self.n - count][None, :], self.n, axis=0)
        low = np.repeat(self.values[:, count - 1][None, :], self.n, axis=0)
        assert high.shape == shape
        for j, (rows, values) in enumerate(zip(self.order, self.values, strict=True)):
            high[rows[self.n - count :], j] = values[self.n - count :]
            low[rows[:count], j] = values[:count]
        return high, low

    def rows(self, which: np.ndarray) -> np.ndarray:
        """Whole rows, for those whose scores are resolved."""
        x = np.empty((len(self.order), self.n), self.values.dtype)
        np.put_along_axis(x, self.order.astype(np.int64), self.values, axis=1)
        return x.T[which]


class Aggregation:
    """The k best rows of every query over blocks of sorted lists, one block after the other.

    After each depth a row's upper bound takes the value read last for what has not come up,
    its lower bound the list's last value.  Rows whose upper bound is below the k-th
    score known are outsiders: the k-th best score of the blocks before, or the k-th
    lower bound of this one if that is higher.  A query stops reading when at most
    ``settle`` * k rows are no outsiders, and their scores are resolved; the others read to
    the end, where both bounds are the score.  ``floor`` may give a score that k rows
    of the table reach.
    """

    def __init__(
        self,
        ids: np.ndarray,
        x: np.ndarray,
        k: int,
        floor: np.ndarray | None = None,
        depths: Sequence[float] = DEPTHS,
        settle: int = 4,
        together: int = 512,
    ) -> None:
        self.ids, self.x, self.k = ids, x, k
        self.depths, self.settle, self.together = depths, settle, together
        self.best = Best(len(ids), k)
        if floor is not None:
            self.best.floor = np.maximum(self.best.floor, floor)
        self.entries = self.entries_read = self.searches = self.stopped = 0

    def block(self, row_ids: np.ndarray, lists: SortedLists) -> None:
        everything = lists.rows(np.arange(lists.n))
        read = {}
        for at in range(0, len(self.ids), self.together):
            self._search(np.arange(at, min(at + self.together, len(self.ids))), row_ids, lists, everything, read)
        self.best.settle()

    def _search(self, reading: np.ndarray, row_ids, lists: SortedLists, x: np.ndarray, read: dict) -> None:
        n = lists.n
        kind = exact_type(self.x[reading], x)
        self.searches += len(reading)
        self.entries += len(reading) * x.size
        rows = np.arange(n)  # that may be no outsiders for some query
        for depth in self.depths:
            count = int(np.ceil(depth * n))
            if not len(reading) or count >= n:
                break
            if count not in read:
                read[count] = [side.astype(kind) for side in lists.read(count)]
            high, low = (side[rows].astype(kind, copy=False) for side in read[count])
            q = self.x[reading].astype(kind)
            up, down = np.maximum(q, 0), np.minimum(q, 0)
            own = self.ids[reading][:, None] == row_ids[rows][None, :]
            upper = up @ high.T + down @ low.T
            known = self.best.floor[reading]
            new = known == np.iinfo(np.int64).min
            if new.any() and len(rows) > self.k:
                known = known.copy()
                known[new] = self._kth_lower(up[new], down[new], high, low, own[new], lists)
            inside = (upper >= known[:, None].astype(np.float64)) & ~own
            few = inside.sum(axis=1) <= self.settle * self.k
            if few.any():
                done, at = np.nonzero(inside[few])
                self._resolve(reading[few], done, rows[at], row_ids, x)
                self.entries_read += int(few.sum()) * count * x.shape[1]
                self.stopped += int(few.sum())
                reading, inside = reading[~few], inside[~few]
            rows = rows[inside.any(axis=0)]
        if len(reading):
            self.entries_read += len(reading) * x.size
            scores = products(self.x[reading], x[rows])
            fits = (scores >= self.best.floor[reading][:, None]) & (self.ids[reading][:, None] != row_ids[rows][None, :])
            which, at = np.nonzero(fits)
            self.best.add(reading[which], scores[which, at], row_ids[rows[at]])

    def _kth_lower(self, up, down, high, low, own, lists: SortedLists) -> np.ndarray:
        """The k-th greatest lower bound: what has not come up may be the list's last value."""
        least, most = lists.values[:, 0].astype(high.dtype), lists.values[:, -1].astype(high.dtype)
        seen_high = np.where(high > high.min(axis=0), high, least)
        seen_low = np.where(low < low.max(axis=0), low, most)
        lower = up @ seen_high.T + down @ seen_low.T
        lower = np.where(own, -np.inf, lower.astype(np.float64))
        kth = np.partition(lower, lower.shape[1] - self.k, axis=1)[:, lower.shape[1] - self.k]
        return np.where(np.isfinite(kth), np.floor(kth), np.iinfo(np.int64).min).astype(np.int64)

    def _resolve(self, queries: np.ndarray, which: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, x: np.ndarray) -> None:
        q = self.x[queries[which]].astype(np.int64)
        scores = (q * x[rows].astype(np.int64)).sum(axis=1)
        self.best.add(queries[which], scores, row_ids[rows])


def _distinct(part: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors) by vector length; of rows that repeat an id the first vector in order."""
    ids = part.column("id").to_numpy()
    flat, starts, sizes = list_parts(part.column("v"))
    out = {}
    for size in np.unique(sizes).tolist():
        own = np.flatnonzero(sizes == size)
        vectors = flat[starts[own][:, None] + np.arange(size)[None, :]]
        order = np.lexsort([*vectors.T[::-1], ids[own]])
        first = np.unique(ids[own][order], return_index=True)[1]
        out[size] = (ids[own][order][first], vectors[order][first])
    return out


def _floors(ids: np.ndarray, q: np.ndarray, sample: tuple[np.ndarray, np.ndarray], k: int) -> np.ndarray:
    """A score that k other rows of the sample reach, for each query; the least number if there are not as many."""
    floor = np.full(len(ids), np.iinfo(np.int64).min)
    row_ids, x = sample
    for at in range(0, len(ids), 1024):
        scores = products(q[at : at + 1024], x)
        own = ids[at : at + 1024, None] == row_ids[None, :]
        scores[own] = np.iinfo(np.int64).min
        if scores.shape[1] >= k:
            floor[at : at + 1024] = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
    return floor


def top_k_inner_products(
    vectors: DataFrame,
    k: int = 20,
    scale: int = 64,
    every: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_rows: int = 4_096,
    fit_rows: int = 2_048,
    query_bytes: int = 16 << 20,
) -> DataFrame:
    """The k rows with the largest inner product for every query row, exactly.

    Vectors are made integer (`quantised`).  Queries are the rows whose id is
    divisible by ``every``; candidates are all rows but the query's own.  Returns
    ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``; ties go to the smaller id,
    and a query with fewer than k candidates returns them all.

    Rows are dealt by hash into blocks of about ``block_rows``, once; a block is a row of a
    written table that holds its sorted lists.  Queries come to the blocks in batches of
    at most ``query_bytes`` of vectors, through the driver, as a broadcast variable, with
    the k-th score that ``fit_rows`` rows of the table give them.  A task reads its
    blocks one after the other (`Aggregation`) and carries the k-th scores along.  At most
    k rows a query leave a task.  A hot vector or a group of copies spreads like any other
    rows, since blocks go by id.

    Rows without id or with a null, empty or non-finite vector take no part; vectors
    of another length than the query's are no candidates; an id that repeats counts
    once a length, with its least vector; other columns are ignored; an empty table
    gives no rows.
    """
    spark = vectors.sparkSession
    rows = written(
        vectors.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("v")).where(
            "id IS NOT NULL AND v IS NOT NULL"
        ),
        "vectors",
    )
    is_query = F.col("id") % every == 0
    size = rows.agg(
        F.count("*").alias("n"), F.sum(F.when(is_query, F.size("v")).cast("long")).alias("components")
    ).head()
    blocks = max(1, -(-size["n"] // block_rows))
    tasks = max(1, min(2000, -(-blocks // 2)), -(-blocks // 128))

    def build(part: pa.Table) -> pa.Table:
        packed = []
        for length, (ids, x) in _distinct(part).items():
            lists = SortedLists.of(x)
            packed.append((length, pickle.dumps((ids, lists.order, lists.values))))
        return pa.table({"length": pa.array([n for n, _ in packed], pa.int64()), "block": pa.array([b for _, b in packed], pa.binary())})

    lists = written(
        rows.withColumn("part", F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(blocks)))
        .repartition(tasks, "part")
        .groupBy("part")
        .applyInArrow(build, "length long, block binary"),
        "top-k-lists",
    )
    # whole ids, so that one with several vectors has the vector here that it has in a block
    sample = _distinct(rows.where(F.pmod(F.xxhash64(F.lit(2), "id"), F.lit(max(1, size["n"] // fit_rows))) == 0).limit(2 * fit_rows).toArrow()) if size["n"] else {}
    batches = max(1, -(-8 * (size["components"] or 0) // query_bytes))
    out = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    for batch in range(batches):
        mine = is_query & (F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(batches)) == batch)
        queries = {
            length: (ids, q, _floors(ids, q, sample[length], k) if length in sample else None)
            for length, (ids, q) in _distinct(rows.where(mine).toArrow()).items()
        }
        if queries:
            out = out.unionByName(_search_batch(lists, queries, k))
    return out


def _search_batch(lists: DataFrame, queries: dict[int, tuple], k: int) -> DataFrame:
    known = lists.sparkSession.sparkContext.broadcast(queries)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {length: Aggregation(ids, q, k, floor) for length, (ids, q, floor) in known.value.items()}
        for batch in batches:
            for length, block in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if length in found:
                    row_ids, order, values = pickle.loads(block.as_buffer())
                    found[length].block(row_ids, SortedLists(order, values))
        for done in found.values():
            best = done.best
            if len(best.window):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(done.ids[best.window]), pa.array(best.row), pa.array(best.score)], ["query_id", "vec_id", "score"]
                )

    found = lists.mapInArrow(search, "query_id long, vec_id long, score long").distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
