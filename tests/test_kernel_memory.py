"""Memory of the matching kernel."""

from __future__ import annotations

import tracemalloc

import numpy as np

from liftwise.operators import matching


def test_matching_holds_no_array_of_all_pairs():
    r = np.random.default_rng(3)
    t, c = (np.abs(1 + 0.6 * r.normal(size=(2048, 53))) for _ in range(2))
    ids = [f"M{k:05d}" for k in range(2048)]
    tracemalloc.start()
    ti, ci, dist, common = matching.block_top_k(ids, t, ids, c, 10)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2048 * 2048 * 8  # one such array of float64
    assert (np.bincount(ti) == 10).all() and (common == 53).all()
    assert np.allclose(dist, np.abs(t[ti] - c[ci]).sum(axis=1))
    want = np.sort(np.abs(t[:50, None] - c[None]).sum(axis=2), axis=1)[:, :10]
    assert np.allclose(np.sort(dist[ti < 50].reshape(50, 10), axis=1), want)
