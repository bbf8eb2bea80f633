"""Lower bounds of the matching kernel, and estimated seasonality, on planted panels."""

from __future__ import annotations

import datetime as dt
import math
import random

import numpy as np
import pytest
from conftest import make_interventions
from pyspark.sql import functions as F

from liftwise.operators import matching, panel

RND = np.random.default_rng(8)


def vectors(n: int, kind: str) -> list[list[float | None]]:
    week = np.arange(53)
    level = RND.uniform(0.2, 3, (n, 1))
    v = 1 + level * np.sin(week / 8.3 + RND.uniform(0, 6, (n, 1))) + RND.normal(0, 1.0 if kind == "noisy" else 0.01, (n, 53))
    if kind == "sparse":
        gone = np.zeros((n, 53), bool)
        for row in gone:
            for a in RND.integers(0, 50, 3):
                row[a : a + RND.integers(1, 9)] = True
        v[gone] = np.nan
        v[:3] = np.nan  # no week at all
    return [[None if math.isnan(x) else float(x) for x in row] for row in v]


def whole(t, c, k, excluded):
    """All residuals, weeks in order, ties by id."""
    out = []
    for i, a in enumerate(t):
        rows = []
        for j, b in enumerate(c):
            pairs = [(x, y) for x, y in zip(a, b, strict=True) if x is not None and y is not None]
            if pairs and f"C{j:04d}" not in excluded:
                d = 0.0
                for x, y in pairs:
                    d += abs(x - y)
                rows.append((d, f"C{j:04d}", len(pairs)))
        out += [(i, j, d, n) for d, j, n in sorted(rows)[:k]]
    return out


@pytest.mark.parametrize("kind", ["smooth", "sparse", "noisy"])
def test_pruned_matches_equal_brute_force(kind):
    t, c = vectors(25, kind), vectors(600, kind)
    t[4], c[7], c[8] = c[100], c[100], c[100]  # ties at residual 0
    ids, excluded = [f"C{j:04d}" for j in range(600)], ["C0100", "C0005"]
    n: dict = {}
    ti, ci, d, common = matching.block_top_k([f"T{i}" for i in range(25)], t, ids, c, 5, excluded, counts=n)
    got = sorted((int(i), float(x), ids[j], int(m)) for i, j, x, m in zip(ti, ci, d, common, strict=True))
    assert [(i, j, x, m) for i, x, j, m in got] == whole(t, c, 5, set(excluded))
    assert n["pairs"] == 25 * 600 and n["computed"] <= n["pairs"]
    share = 1 - n["computed"] / n["pairs"]
    assert share > (0.5 if kind == "smooth" else 0.2 if kind == "sparse" else -1), share


def test_bounds_never_exceed_residuals():
    for kind in ("smooth", "sparse", "noisy"):
        a, b = (np.array([[np.nan if x is None else x for x in row] for row in vectors(40, kind)]) for _ in range(2))
        ok_a, ok_b = ~np.isnan(a), ~np.isnan(b)
        a0, b0 = np.where(ok_a, a, 0), np.where(ok_b, b, 0)
        bound = matching._lower_bounds(*matching._group_sums(a0, ok_a), *matching._group_sums(b0, ok_b))
        i, j = (x.ravel() for x in np.indices((40, 40)))
        assert (bound.ravel() <= matching._residuals(a0, ok_a, b0, ok_b, i, j)).all()


def test_skipped_pairs_are_reported(spark):
    rows = [("I", f"T{i}", v) for i, v in enumerate(vectors(12, "smooth"))]
    pool = [("I", f"C{i:04d}", v) for i, v in enumerate(vectors(900, "smooth"))]
    schema = "intervention_id string, merchant_id string, vec array<double>"
    got = matching.pruning_counts(spark.createDataFrame(rows, schema), spark.createDataFrame(pool, schema), 3).collect()
    assert [(r.intervention_id, r.n_pairs) for r in got] == [("I", 12 * 900)] and got[0].n_computed < 12 * 900
    assert not matching.pruning_counts(spark.createDataFrame([], schema), spark.createDataFrame(pool, schema), 3).collect()


def season(day: dt.date, weekend: float, sin: float, cos: float, december: float) -> float:
    angle = 2 * math.pi * (day.timetuple().tm_yday - 1) / 365.0
    return 1 + weekend * (day.isoweekday() >= 6) + sin * math.sin(angle) + cos * math.cos(angle) + december * (day.month == 12)


def test_planted_seasons_are_recovered(spark):
    planted = {"mall": (0.3, 0.1, -0.05, 0.2), "urban": (-0.4, 0.0, 0.12, 0.0)}
    days = [dt.date(2021, 1, 1) + dt.timedelta(days=k) for k in range(730)]
    rows = [(f"{kind}{m}", d, kind, 50.0 * (m + 1) * season(d, *p)) for kind, p in planted.items() for m in range(3) for d in days]
    rows += [("none", days[0], None, 5.0), ("zero", days[0], "mall", 0.0), ("nan", days[0], "mall", float("nan"))]
    gold = spark.createDataFrame(rows, "merchant_id string, txn_date date, location_type string, amount double")
    for r in panel.seasonality_estimates(gold).collect():
        mean = np.mean([season(d, *planted[r.location_type]) for d in days])
        got = [r.weekend, r.sin_year, r.cos_year, r.december]
        assert got == pytest.approx([x / mean for x in planted[r.location_type]], abs=1e-9)
        assert r.constant == pytest.approx(1 / mean, abs=1e-9) and r.n_rows == 3 * 730


def test_terms_that_do_not_vary(spark):
    rows = [("A", dt.date(2021, 6, 7) + dt.timedelta(days=7 * k), "mall", 10.0 + k % 2) for k in range(8)]  # Mondays of one summer
    gold = spark.createDataFrame(rows, "merchant_id string, txn_date date, location_type string, amount double")
    (r,) = panel.seasonality_estimates(gold).collect()
    assert (r.weekend, r.december, r.n_rows) == (0.0, 0.0, 8)
    assert not panel.seasonality_estimates(gold.where("false")).collect()


def test_injection_by_spans_of_days(spark):
    random.seed(2)
    day = dt.date(2024, 1, 1)
    rows = [(m, day + dt.timedelta(days=k), 100.0, 10) for m in ("A", "B", "C") for k in range(30)]
    df = spark.createDataFrame(rows, "merchant_id string, txn_date date, amount double, txn_count int")
    plan = [(f"I{k}", random.sample(["A", "B", None], 2), day + dt.timedelta(days=random.choice((3, 9, 9, 20))), 60) for k in range(5)]
    raw = make_interventions(spark, plan).withColumn("true_effect", F.substring("intervention_id", 2, 1).cast("double") / 10)
    got = {(r.merchant_id, r.txn_date): r.amount for r in panel.inject_lift(df, raw).collect()}
    assert len(got) == 90
    for (m, d), x in got.items():
        want = math.prod(1 + k / 10 for k, (_, ids, start, _) in enumerate(plan) if m in ids and start <= d)
        assert x == pytest.approx(100 * want, abs=0.0051)
