"""Integer vectors: quantising, exact products, matrices from Arrow lists, best rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component as long; null if the vector takes no part."""
    usable = (
        vector.isNotNull()
        & (F.size(vector) > 0)
        & F.forall(
            vector,
            lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))),
        )
    )
    return F.when(usable, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def exact_type(a: np.ndarray, b: np.ndarray):
    """The fastest number type in which all inner products are exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, b.shape[1])
    return np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices, as int64."""
    kind = exact_type(a, b)
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


class Best:
    """The ``k`` best (score, then least id) rows of every window, gathered piece by piece."""

    def __init__(self, windows: int, k: int) -> None:
        self.k, self.floor = k, np.full(windows, np.iinfo(np.int64).min)
        self.window, self.score, self.row = (np.zeros(0, np.int64) for _ in range(3))
        self.pieces: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.pending = 0

    def add(self, window: np.ndarray, score: np.ndarray, row: np.ndarray) -> None:
        if len(window):
            self.pieces.append((window, score, row))
            self.pending += len(window)
            if self.pending > 4096 + len(self.window) // 2:
                self.settle()

    def settle(self) -> None:
        """Keep the best; the k-th score of a full window is its floor from now on."""
        if not self.pieces:
            return
        window, score, row = (np.concatenate(c) for c in zip((self.window, self.score, self.row), *self.pieces, strict=True))
        self.pieces, self.pending = [], 0
        order = np.lexsort((row, -score, window))
        window, score, row = window[order], score[order], row[order]
        first = np.concatenate([[True], window[1:] != window[:-1]])
        begin = np.maximum.accumulate(np.where(first, np.arange(len(window)), 0))
        place = np.arange(len(window)) - begin
        keep = place < self.k
        full = place == self.k - 1
        self.floor[window[full]] = score[full]
        self.window, self.score, self.row = window[keep], score[keep], row[keep]


def list_parts(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(flat values, starts, sizes) of a column of lists."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.list_(pa.int64()))
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False), offsets[:-1], np.diff(offsets)


def matrices(part: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, vectors) by vector length."""
    flat, starts, sizes = list_parts(part.column("v"))
    ids, labels = part.column("id").to_numpy(), part.column("label").to_numpy()
    return {
        int(size): (ids[own], labels[own], flat[starts[own][:, None] + np.arange(size)[None, :]])
        for size in np.unique(sizes)
        for own in [np.flatnonzero(sizes == size)]
    }


def narrowed(x: np.ndarray) -> np.ndarray:
    """The same integers in the smallest type that holds them."""
    most = int(max(x.max(initial=0), -x.min(initial=0) - 1))
    return x.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if most <= np.iinfo(t).max))
