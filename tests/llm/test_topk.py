import duckdb
import numpy as np
import pytest
from compare import compare, connect

import __spark_entry__ as entry
from clearwell.llm.topk import Aggregation, SortedLists, _floors, top_k_inner_products

SF = "/root/testdata/sf0.001"


def brute(q, ids, x, row_ids, k):
    out = {}
    for i, v in zip(ids.tolist(), q.tolist(), strict=True):
        scored = [(-sum(a * b for a, b in zip(v, r, strict=True)), j) for r, j in zip(x.tolist(), row_ids.tolist(), strict=True) if j != i]
        out[i] = [(j, -s) for s, j in sorted(scored)[:k]]
    return out


def aggregated(q, query_ids, x, ids, k, block, **options):
    done = Aggregation(query_ids, q, k, **options)
    for at in range(0, len(x), block):
        done.block(ids[at : at + block], SortedLists.of(x[at : at + block]))
    best = done.best
    found = {int(i): [] for i in query_ids}
    for w, s, r in sorted(zip(best.window.tolist(), (-best.score).tolist(), best.row.tolist(), strict=True)):
        found[int(query_ids[w])].append((r, -s))
    return found, done


@pytest.mark.parametrize("spread", [0, 3, 60, 1 << 20, 1 << 29])
@pytest.mark.parametrize("shape", [(400, 8), (900, 3), (30, 5), (3, 2)])
def test_lists_give_the_exact_top(spread, shape):
    rng = np.random.default_rng(spread % 97)
    x = rng.integers(-spread, spread + 1, size=shape)
    x[len(x) // 2] = x[0]  # ties
    ids = rng.permutation(len(x)) * 3
    q, query_ids = x[::7], ids[::7]
    want = brute(q, query_ids, x, ids, 5)
    for block, settle, together in ((len(x), 2, 512), (100, 1, 5), (17, 0, 512)):
        got, _ = aggregated(q, query_ids, x, ids, 5, block, settle=settle, together=together)
        assert got == want
    got, _ = aggregated(q, query_ids, x, ids, 5, 100, floor=_floors(query_ids, q, (ids[::2], x[::2]), 5))
    assert got == want


def test_bounds_hold_what_has_been_read():
    x = np.random.default_rng(1).integers(-9, 10, size=(50, 4))
    lists = SortedLists.of(x)
    assert (lists.rows(np.arange(50)) == x).all()
    for count in (1, 7, 25, 49):
        high, low = lists.read(count)
        top, bottom = np.sort(x, axis=0)[50 - count], np.sort(x, axis=0)[count - 1]
        assert (high == np.maximum(x, top)).all() and (low == np.minimum(x, bottom)).all()


def test_reading_stops_before_the_end():
    """Clear winners settle after the first depth, and nothing but their scores is resolved."""
    x = np.random.default_rng(0).integers(-3, 4, size=(4000, 4))
    x[:5] = 60 + np.arange(5)[:, None]
    got, done = aggregated(np.full((1, 4), 9), np.array([-1]), x, np.arange(4000), 3, 4000, depths=(1 / 16, 1 / 2))
    assert [r for r, _ in got[-1]] == [4, 3, 2]
    assert done.stopped == done.searches == 1 and done.entries_read == done.entries // 16


def test_share_of_entries_read_on_the_table():
    """On vectors with an even spectrum most queries stop, once scores of other rows are known."""
    rows = duckdb.sql("SELECT vec_id, embedding FROM read_parquet('/root/testdata/sf0.1/embeddings.parquet') ORDER BY 1").fetchall()
    ids = np.array([r[0] for r in rows])
    x = np.floor(64 * np.array([r[1] for r in rows], dtype=float)).astype(np.int64)
    query = ids % 20 == 0
    sample = np.random.default_rng(2).permutation(len(ids))[:500]
    deal = np.random.default_rng(3).permutation(len(ids))
    floor = _floors(ids[query], x[query], (ids[sample], x[sample]), 20)
    got, done = aggregated(x[query], ids[query], x[deal], ids[deal], 20, 250, floor=floor)
    print(f"read {done.entries_read / done.entries:.3f}, stopped {done.stopped / done.searches:.3f}")
    assert done.stopped > 0.9 * done.searches and done.entries_read < 0.9 * done.entries
    scores = x[query] @ x.T
    for i, own in enumerate(ids[query].tolist()):
        order = [j for j in np.lexsort((ids, -scores[i])) if ids[j] != own][:20]
        assert got[own] == [(int(ids[j]), int(scores[i, j])) for j in order]


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 3), 0.5, -0.25]) for i in range(45)]
    rows += [
        (60, None), (80, []), (100, [nan, 0.0, 0.0]), (120, [inf, 0.0, 0.0]), (140, [None, 1.0, 1.0]),
        (None, [1.0, 1.0, 1.0]), (160, [1.0, 1.0]), (20, rows[20][1]), (20, rows[20][1]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS id", "2 AS rank", "3 AS v")
    got = top_k_inner_products(df, k=4, block_rows=16, fit_rows=10, query_bytes=80).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    clean = {i: [int(np.floor(64 * c)) for c in v] for i, v in rows[:45]}
    for q in (0, 20, 40):
        scored = sorted((-int(np.dot(clean[q], v)), j) for j, v in clean.items() if j != q)[:4]
        assert by[q] == [(n + 1, j, -s) for n, (s, j) in enumerate(scored)]
    assert set(by) == {0, 20, 40}  # no candidate has the length of 160
    assert top_k_inner_products(df.limit(0)).collect() == []


def test_query_equals_its_sql(spark):
    assert compare(spark, connect(SF), entry.queries()["op1_top_k"], entry.oracle_sql()["op1_top_k"], SF) is None
