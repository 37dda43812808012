"""Quality scores learned from preference pairs (Bradley-Terry), cut at a score quantile."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearwell.llm.common import fold, free_name, labelled_sample, slices, written

FEATURES = (
    "symbols", "bangs", "bars", "capitals", "digits", "periods", "markup", "other_bytes", "repeats",
    "distinct", "same_lines", "word_length", "long_words", "log_words", "empty",
)


def features(text: str | None) -> list[float]:
    """Shape of a text, in the order of `FEATURES`; a null or blank one is `empty` alone.

    Shares enter as square roots, so that a junk passage in a clean text still shows.
    """
    words = text.split() if text else []
    if not words:
        return [0.0] * (len(FEATURES) - 1) + [1.0]
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    n = np.bincount(raw, minlength=256)
    size = len(raw)
    upper, lower = int(n[65:91].sum()), int(n[97:123].sum())
    count = len(words)
    again = sum(map(eq, words, words[1:]))
    lines = [x for x in text.split("\n") if x.strip()]
    letters = sum(map(len, words))
    shares = [
        int(n[[35, 36, 37, 38, 42, 64, 94, 126]].sum()) / size,
        int(n[33]) / size,
        int(n[124]) / size,
        upper / max(1, upper + lower),
        int(n[48:58].sum()) / size,
        int(n[[44, 46]].sum()) / size,
        int(n[[60, 62, 91, 93, 123, 125, 92, 95, 61]].sum()) / size,
        int(n[128:].sum()) / size,
        again / count,
        len(set(words)) / count,
        1 - len(set(lines)) / max(1, len(lines)),
    ]
    return [float(np.sqrt(x)) for x in shares] + [
        letters / count / 10,
        sum(1 for w in words if len(w) > 25) / count,
        float(np.log1p(count)) / 10,
        0.0,
    ]


@dataclass(frozen=True)
class QualityModel:
    """weights: Bradley-Terry strengths by feature; cut: the score from which texts are kept."""

    weights: tuple[float, ...]
    cut: float

    def score(self, values: Column) -> Column:
        """0 to 1; a half at the cut."""
        raw = F.lit(-self.cut)
        for i, w in enumerate(self.weights):
            raw = raw + F.get(values, F.lit(i)) * w
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-raw))


def with_features(docs: DataFrame, text_col: str, name: str) -> DataFrame:
    """The rows with an array of features in the new column ``name``."""
    fields = docs.schema.fields
    schema = T.StructType([*fields, T.StructField(name, T.ArrayType(T.FloatType()))])
    at = docs.columns.index(text_col)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [features(t) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rows, pa.list_(pa.float32()))], [*batch.schema.names, name]
            )

    return docs.mapInArrow(add, schema)


def bradley_terry(
    better: np.ndarray, worse: np.ndarray, penalty: float = 1e-3, rounds: int = 30
) -> np.ndarray:
    """Weights that maximise the mean of log sigmoid(w (better - worse)) less a penalty; Newton's method."""
    gap = better - worse
    w = np.zeros(gap.shape[1])
    ridge = penalty * np.eye(len(w))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(gap @ w, -30, 30)))
        gradient = gap.T @ (1 - p) / len(gap) - penalty * w
        curve = (gap * (p * (1 - p))[:, None]).T @ gap / len(gap) + ridge
        step = np.linalg.solve(curve, gradient)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_quality(
    featured: DataFrame,
    values: str,
    labels: DataFrame,
    label: str = "quality",
    folds: int = 3,
    held_out: int = 1,
    fit_rows: int = 20_000,
    pairs: int = 8,
    quantiles: int = 400,
    id_col: str = "doc_id",
) -> QualityModel:
    """Learn weights and cut from labelled rows outside the held-out fold.

    Weights: at most ``fit_rows`` labelled rows, half of each class; every row of the
    rarer class meets ``pairs`` rows of the other, seeded, and each pair says which
    text is better.  Cut: the scores of all labelled rows of the training folds are
    split at ``quantiles`` quantiles, and the cut is the middle of the quantiles that
    err least.  With one class alone nothing can be learned: weights are 0 and
    every text scores as that class (without any label: as good).
    """
    sample = labelled_sample(labels, label, folds, held_out, fit_rows, id_col)
    ids = featured.select(F.col(id_col).alias("sample_id"), F.col(values).alias("x"))
    rows = ids.join(F.broadcast(sample), "sample_id").orderBy("sample_id").select("x", "label").collect()
    x = np.array([r["x"] for r in rows], dtype=float).reshape(-1, len(FEATURES))
    y = np.array([r["label"] for r in rows], dtype=int)
    if len(set(y.tolist())) < 2:
        return QualityModel((0.0,) * len(FEATURES), 1.0 if (y == 0).any() else -1.0)
    good, bad = x[y == 1], x[y == 0]
    deal = np.random.default_rng(11)
    many = pairs * min(len(good), len(bad))
    turn = np.arange(many)
    if len(bad) <= len(good):
        left, right = deal.integers(len(good), size=many), turn % len(bad)
    else:
        left, right = turn % len(good), deal.integers(len(bad), size=many)
    scale = np.maximum(x.std(axis=0), 1e-6)
    weights = bradley_terry(good[left] / scale, bad[right] / scale) / scale
    scored = (
        labels.where(F.col(label).isNotNull() & (fold(F.col(id_col), folds) != held_out))
        .select(F.col(id_col).alias("sample_id"), F.col(label).cast("int").alias("label"))
        .join(ids, "sample_id")
        .select("label", _dot(weights, F.col("x")).alias("s"))
    )
    marks = [i / quantiles for i in range(1, quantiles)]
    marked = scored.agg(F.percentile_approx("s", marks, 20_000).alias("q"), F.min("s").alias("least")).head()
    grid = sorted(set(marked["q"] or []))
    if not grid:
        return QualityModel(tuple(map(float, weights)), 0.0)
    place = F.size(F.filter(F.array(*map(F.lit, grid)), lambda q: q <= F.col("s")))
    counts = scored.groupBy(place.alias("at"), "label").count().collect()
    zeros, ones = np.zeros(len(grid) + 1), np.zeros(len(grid) + 1)
    for r in counts:
        (ones if r["label"] else zeros)[r["at"]] += r["count"]
    # wrong if all from quantile k on are kept
    wrong = np.concatenate([[0], np.cumsum(ones)])[:-1] + zeros.sum() - np.concatenate([[0], np.cumsum(zeros)])[:-1]
    best = np.flatnonzero(wrong[1:] == wrong[1:].min())
    k = int(best[0])
    lower = grid[k - 1] if k else marked["least"]
    return QualityModel(tuple(map(float, weights)), float((lower + grid[k]) / 2))


def _dot(weights, values: Column) -> Column:
    total = F.lit(0.0)
    for i, w in enumerate(weights):
        total = total + F.get(values, F.lit(i)) * float(w)
    return total


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 3,
    held_out: int = 1,
    keep: tuple[str, ...] | None = None,
    **fit,
) -> DataFrame:
    """Score every whole text: the columns ``keep`` (all by default) and the struct ``quality``.

    ``quality`` has ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from the
    threshold on); its name gets underscores in front if ``docs`` has one.  Features
    are computed once a text and written beside the kept columns in the shared
    folder; the model is fitted on them (`fit_quality`) and applied as an expression.
    Labels alone come from ``labels``; no other column enters a score.

    A null or empty text has the single feature `empty` and a score like any other.
    A null id is never labelled and not held out; repeated rows and ids are scored each
    on its own; empty tables give no rows.
    """
    name = free_name(docs, "quality")
    values = free_name(docs, "features")
    columns = list(keep if keep is not None else docs.columns)
    needed = list(dict.fromkeys([*columns, id_col, text_col]))
    featured = with_features(docs.select(*needed), text_col, values)
    featured = written(featured.select(*dict.fromkeys([*columns, id_col]), values), "quality")
    model = fit_quality(featured, values, labels, folds=folds, held_out=held_out, id_col=id_col, **fit)
    score = model.score(F.col(values))
    return featured.select(
        *columns,
        F.struct(
            F.coalesce(fold(F.col(id_col), folds) == held_out, F.lit(False)).alias("held_out"),
            score.alias("score"),
            (score >= threshold).cast("int").alias("predicted"),
        ).alias(name),
    )
