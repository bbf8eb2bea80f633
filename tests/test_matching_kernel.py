"""The blocked top-k kernel against brute force, and blocking/broadcast invariance."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from liftwise.operators import matching


def brute(tv, cv, k):
    out = {}
    for i, t in enumerate(tv):
        cands = []
        for j, c in enumerate(cv):
            both = ~np.isnan(t) & ~np.isnan(c)
            if both.any():
                cands.append((float(np.abs(t[both] - c[both]).sum()), j))
        cands.sort()
        out[i] = cands[:k]
    return out


@settings(max_examples=60, deadline=None)
@given(
    nt=st.integers(1, 6),
    nc=st.integers(1, 12),
    w=st.integers(1, 8),
    k=st.integers(1, 5),
    seed=st.integers(0, 10_000),
    missing=st.floats(0.0, 0.7),
)
def test_block_top_k_matches_brute_force(nt, nc, w, k, seed, missing):
    rng = np.random.default_rng(seed)
    tv = rng.normal(1, 0.3, (nt, w)).round(2)
    cv = rng.normal(1, 0.3, (nc, w)).round(2)
    tv[rng.random(tv.shape) < missing] = np.nan
    cv[rng.random(cv.shape) < missing] = np.nan
    ti, ci, dist, common = matching.block_top_k(list(range(nt)), list(tv), list(range(nc)), list(cv), k)
    got = {}
    for a, b, d in zip(ti, ci, dist):
        got.setdefault(int(a), []).append((float(d), int(b)))
    expected = brute(tv, cv, k)
    for i in range(nt):
        g = sorted(got.get(i, []))[:k]
        e = expected[i]
        assert [b for _, b in g] == [b for _, b in e] or [round(d, 9) for d, _ in g] == [round(d, 9) for d, _ in e]
        assert np.allclose([d for d, _ in g], [d for d, _ in e])


@pytest.mark.parametrize("block_rows,chunk_rows,budget", [(2, 3, 0), (1000, 1000, 1 << 30), (3, 50, 0)])
def test_candidate_pairs_invariant_to_blocking(spark, block_rows, chunk_rows, budget):
    rng = np.random.default_rng(7)
    rows = []
    for iv in ("A", "B"):
        for m in range(25):
            v = rng.normal(1, 0.2, 10).round(3).tolist()
            if m % 4 == 0:
                v[m % 10] = None
            rows.append((iv, f"M{m:03d}", v))
    vecs = spark.createDataFrame(rows, "intervention_id string, merchant_id string, vec array<double>")
    treated = spark.createDataFrame(
        [("A", "M001"), ("A", "M002"), ("A", "M010"), ("B", "M003"), ("B", "M020")],
        "intervention_id string, merchant_id string",
    )
    t, c = matching.split_cohorts(vecs, treated)
    k = 4
    ranked = matching.rank_candidates(
        matching.candidate_pairs(t, c, k, treated_block_rows=block_rows, control_chunk_rows=chunk_rows, broadcast_bytes=budget),
        k,
    )
    reference = matching.rank_candidates(matching.candidate_pairs(t, c, k), k)
    key = lambda r: (r.intervention_id, r.treated_merchant_id, r.match_rank, r.control_merchant_id)
    assert sorted(map(key, ranked.collect())) == sorted(map(key, reference.collect()))
    assert ranked.count() == 5 * k


@pytest.mark.parametrize("budget", [1 << 30, 0])
def test_shared_pool_with_exclusions_equals_per_intervention_pools(spark, budget):
    rng = np.random.default_rng(11)
    shared_rows = []
    for m in range(30):
        v = rng.normal(1, 0.2, 8).round(3).tolist()
        if m % 5 == 0:
            v[m % 8] = None
        shared_rows.append(("W1", f"M{m:03d}", v))
    shared = spark.createDataFrame(shared_rows, "pre_start string, merchant_id string, vec array<double>")
    treated = spark.createDataFrame(
        [("A", "M001"), ("A", "M002"), ("B", "M002"), ("B", "M017"), ("B", "M020")],
        "intervention_id string, merchant_id string",
    )
    ivs = spark.createDataFrame([("A", "W1"), ("B", "W1")], "intervention_id string, pre_start string")
    k = 3
    t_vecs = shared.join(treated.join(ivs, "intervention_id"), ["pre_start", "merchant_id"])
    fast = matching.rank_candidates(
        matching.candidate_pairs(
            t_vecs, shared, k, treated_block_rows=2, control_chunk_rows=7, broadcast_bytes=budget,
            pool_key="pre_start", exclusions=treated,
        ),
        k,
    )
    per_iv = shared.join(ivs, "pre_start").drop("pre_start")
    t, c = matching.split_cohorts(per_iv, treated)
    reference = matching.rank_candidates(matching.candidate_pairs(t, c, k), k)
    key = lambda r: (r.intervention_id, r.treated_merchant_id, r.match_rank, r.control_merchant_id)
    got = sorted(map(key, fast.collect()))
    assert got == sorted(map(key, reference.collect())) and len(got) == 5 * k
    assert not [g for g in got if (g[0], g[3]) in {("A", "M001"), ("A", "M002"), ("B", "M002"), ("B", "M017"), ("B", "M020")}]
