"""Top-k: many queries share a product, any packs and blocks give all of the best."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from liftwise.llm import mtree


def brute(x: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    out = []
    for n, i in enumerate(own.tolist()):
        q = x[ids == i][0].tolist()
        s = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for v, j in zip(x.tolist(), ids.tolist(), strict=True) if j != i)
        out += [(n, -score, j) for score, j in s[:k]]
    return out


def found(tree: mtree.MTree, q: np.ndarray, own: np.ndarray, bound: np.ndarray) -> list[tuple[int, int, int]]:
    return list(zip(*(c.tolist() for c in tree.search_many(q, own, bound)), strict=True))


@pytest.mark.parametrize("size", [3, 1000, 10**6, 10**9])
def test_batches_equal_all_scores_in_every_type(size):
    rng = np.random.default_rng(size)
    x, ids = rng.integers(-size, size, (400, 4)), rng.permutation(400)
    x[50:90] = x[50]
    top = float((x.astype(float) ** 2).sum(axis=1).max())
    assert mtree.score_type(top) is {3: np.float32, 1000: np.float32, 10**6: np.float64, 10**9: np.int64}[size]
    p = mtree.Params(leaf=16, fanout=6)
    ux, uid = mtree.distinct_best(x, ids, p.k)
    tree = mtree.MTree(ux, uid, top, p)
    want = brute(x, ids, ids[::9], p.k)
    q, own = x[::9], ids[::9]
    assert found(tree, q, own, np.full(len(q), mtree.NONE)) == want
    assert found(tree, q, own, np.array([s for _, s, _ in want[p.k - 1 :: p.k]])) == want


def test_queries_share_products(monkeypatch):
    rng = np.random.default_rng(5)
    x, ids = rng.integers(-60, 60, (3000, 32)), np.arange(3000)
    tree = mtree.MTree(x, ids, float((x.astype(float) ** 2).sum(axis=1).max()), mtree.Params())
    calls = []
    scores = mtree.scores
    monkeypatch.setattr(mtree, "scores", lambda *a: calls.append(1) or scores(*a))
    got = found(tree, x[:300], ids[:300], np.full(300, mtree.NONE))
    s = x[:300] @ x.T
    s[np.arange(300), np.arange(300)] = -(1 << 40)
    order = np.argsort(-s, axis=1, kind="stable")[:, :5]
    assert got == [(n, int(s[n, j]), int(j)) for n in range(300) for j in order[n]]
    assert len(calls) < 60  # one for each query and leaf before


def test_any_number_of_packs_and_blocks(spark, monkeypatch):
    rng = np.random.default_rng(7)
    x = rng.integers(-500, 500, (240, 3))
    x[20:60] = x[20]
    df = spark.createDataFrame([(i, (v / 256).tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    p = mtree.Params(leaf=8, fanout=4, cells=6, sample=50, block_rows=40, query_rows=9, together=4)
    monkeypatch.setattr(mtree, "PACK_BYTES", 24)
    monkeypatch.setattr(mtree, "PACKS", 7)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in mtree.top_k(df, F.col("vec_id") % 3 == 0, p).collect())
    want = brute(x, np.arange(240), np.arange(0, 240, 3), p.k)
    assert got == [(3 * n, 1 + k % p.k, i, s) for k, (n, s, i) in enumerate(want)]
