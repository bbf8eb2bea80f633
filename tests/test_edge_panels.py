"""Hand-made panels with exact expectations (method contract)."""

from __future__ import annotations

import datetime as dt
import math

from conftest import daily, day, make_interventions, make_panel
from pyspark.sql import functions as F

from liftwise.operators import lift
from liftwise.operators.windows import intervention_windows, treated_merchants
from liftwise.plans.causal import CausalRun

START = day("2024-06-03")  # a Monday


def wave(base, phase=0.0, bump=0.0):
    return lambda d: base * (1 + 0.2 * math.sin((d.toordinal() + phase) / 9.0)) + bump


def run_for(spark, series, ivs, n=10):
    p = make_panel(spark, series)
    iv = make_interventions(spark, ivs)
    return CausalRun(p, intervention_windows(iv), treated_merchants(iv), n, checkpoint=False)


def full_range(fn, start=START, post=60):
    return daily(start - dt.timedelta(days=364), start + dt.timedelta(days=post), fn)


def test_dense_monday_start_weeks_and_t(spark):
    series = {f"M{i}": full_range(wave(100 + 10 * i, phase=i)) for i in range(1, 6)}
    run = run_for(spark, series, [("A", ["M1"], START, 60)])
    tr = run.parallel_trends.collect()
    pre = sorted(r.week_number for r in tr if r.period == "pre")
    post = sorted(r.week_number for r in tr if r.period == "post")
    assert pre == list(range(-52, 0))
    assert post == list(range(0, 9))
    stats = lift.lift_stats(lift.post_weeks(run.series)).collect()
    assert stats[0].n_weeks == 9 and stats[0].t_val == 2.306


def test_non_monday_start_straddling_week_is_pre(spark):
    start = day("2024-06-06")  # Thursday
    series = {f"M{i}": full_range(wave(100 + 5 * i, phase=2 * i), start) for i in range(1, 5)}
    run = run_for(spark, series, [("A", ["M1"], start, 60)])
    rows = {r.week_number: r.period for r in run.parallel_trends.collect()}
    assert rows[-1] == "pre"
    assert rows[0] == "post"
    assert min(rows) == -53


def test_mean_zero_merchant_is_not_a_candidate(spark):
    series = {f"M{i}": full_range(wave(100 + i, phase=i)) for i in range(1, 5)}
    series["M9"] = full_range(lambda d: 0.0)
    run = run_for(spark, series, [("A", ["M1"], START, 60)])
    controls = {r.control_merchant_id for r in run.matches.collect()}
    assert "M9" not in controls and controls == {"M2", "M3", "M4"}


def test_null_in_treated_array_is_dropped(spark):
    series = {f"M{i}": full_range(wave(100 + i, phase=i)) for i in range(1, 5)}
    run = run_for(spark, series, [("A", ["M1", None], START, 60)])
    assert {r.merchant_id for r in run.treated.collect()} == {"M1"}
    assert len(run.matches.collect()) == 3


def test_equal_residuals_lower_id_wins(spark):
    twin = wave(120, phase=3)
    series = {"M1": full_range(wave(100)), "M7": full_range(twin), "M3": full_range(twin)}
    run = run_for(spark, series, [("A", ["M1"], START, 60)], n=1)
    (m,) = run.matches.collect()
    assert m.control_merchant_id == "M3"


def test_too_few_post_weeks_gives_no_lift_row(spark):
    series = {f"M{i}": full_range(wave(100 + i, phase=i), post=0) for i in range(1, 5)}
    run = run_for(spark, series, [("A", ["M1"], START, 0)])
    assert run.estimate_lift().count() == 0  # one post week -> df 0
    series = {f"M{i}": daily(START - dt.timedelta(days=364), START - dt.timedelta(days=1), wave(90 + i)) for i in range(1, 5)}
    run = run_for(spark, series, [("A", ["M1"], START, 60)])
    assert run.estimate_lift().count() == 0  # no post week at all


def series_of(spark, lifts):
    rows = [("A", "post", i, float(v)) for i, v in enumerate(lifts)]
    return spark.createDataFrame(rows, "intervention_id string, period string, week_number int, lift_pct double")


def test_t_table_edges(spark):
    (r61,) = lift.lift_stats(series_of(spark, [1.0 + (i % 3) for i in range(61)])).collect()
    (r62,) = lift.lift_stats(series_of(spark, [1.0 + (i % 3) for i in range(62)])).collect()
    assert (r61.n_weeks, r61.t_val) == (61, 2.0)
    assert (r62.n_weeks, r62.t_val) == (62, 1.96)


def test_equal_lifts_zero_width_ci(spark):
    (e,) = lift.estimate_lift(series_of(spark, [5.0] * 6)).collect()
    assert e.lift_pct == e.ci_lower == e.ci_upper == 5.0 and e.significant


def test_first_n_weeks_beats_week_range(spark):
    s = series_of(spark, [1, 2, 3, 4, 5, 6, 7, 8])
    (a,) = lift.estimate_lift(s, first_n_weeks=3, week_start=5, week_end=7).collect()
    assert a.n_weeks == 3 and a.lift_pct == 2.0
    (b,) = lift.estimate_lift(s, week_start=5, week_end=7).collect()
    assert b.n_weeks == 3 and b.lift_pct == 7.0


def test_unknown_intervention_gives_no_rows(spark):
    series = {f"M{i}": full_range(wave(100 + i, phase=i)) for i in range(1, 4)}
    p = make_panel(spark, series)
    iv = make_interventions(spark, [("A", ["M1"], START, 60)]).where("intervention_id = 'ZZZ'")
    run = CausalRun(p, intervention_windows(iv), treated_merchants(iv), 10, checkpoint=False)
    assert run.matches.count() == 0
    assert run.estimate_lift().count() == 0


def test_treated_in_one_control_in_another(spark):
    series = {f"M{i}": full_range(wave(100 + i, phase=i)) for i in range(1, 6)}
    run = run_for(spark, series, [("A", ["M1"], START, 60), ("B", ["M2"], START, 60)])
    rows = run.matches.collect()
    a_controls = {r.control_merchant_id for r in rows if r.intervention_id == "A"}
    b_controls = {r.control_merchant_id for r in rows if r.intervention_id == "B"}
    assert "M2" in a_controls and "M1" in b_controls
    assert "M1" not in a_controls and "M2" not in b_controls


def test_missing_weeks_are_not_zeros(spark):
    """A control with a gap matches only on common weeks; its mean uses weeks present."""
    base = wave(100)
    gap = [(d, a) for d, a in full_range(base) if not (day("2023-09-01") <= d <= day("2023-10-31"))]
    series = {"M1": full_range(base), "M2": gap, "M3": full_range(wave(100, phase=40))}
    run = run_for(spark, series, [("A", ["M1"], START, 60)], n=2)
    best = run.matches.orderBy("match_rank").first()
    assert best.control_merchant_id == "M2"
    assert best.common_weeks < 52


def test_scaling_a_merchant_leaves_matches_unchanged(spark):
    series = {f"M{i}": full_range(wave(100 + 7 * i, phase=i)) for i in range(1, 7)}
    run1 = run_for(spark, series, [("A", ["M1"], START, 60)], n=3)
    scaled = dict(series)
    scaled["M4"] = [(d, round(a * 3, 2)) for d, a in series["M4"]]
    run2 = run_for(spark, scaled, [("A", ["M1"], START, 60)], n=3)
    key = lambda r: (r.control_merchant_id, round(r.total_residual, 3))
    assert sorted(map(key, run1.matches.collect())) == sorted(map(key, run2.matches.collect()))


def test_mean_signed_pre_lift_is_zero(spark):
    series = {f"M{i}": full_range(wave(100 + 9 * i, phase=3 * i)) for i in range(1, 7)}
    run = run_for(spark, series, [("A", ["M1", "M2"], START, 60)], n=2)
    (v,) = run.series.where("period = 'pre'").agg(F.avg("lift_pct")).collect()
    assert abs(v[0]) < 1e-9


def test_salted_range_join_equals_broadcast(spark, monkeypatch):
    from liftwise import config
    from liftwise.operators import weekly as W

    series = {f"M{i}": full_range(wave(100 + i, phase=i)) for i in range(1, 6)}
    p = make_panel(spark, series)
    iv = make_interventions(spark, [("A", ["M1"], START, 60), ("B", ["M2"], START - dt.timedelta(days=30), 60)])
    win = intervention_windows(iv)
    fast = sorted(tuple(r) for r in W.weeks_in_windows(p, win, "pre_start", "post_end").collect())
    monkeypatch.setattr(config, "MAX_BROADCAST_WINDOW_WEEK_ROWS", 0)
    salted = sorted(tuple(r) for r in W.weeks_in_windows(p, win, "pre_start", "post_end", salt_buckets=4).collect())
    assert fast == salted and len(fast) > 0


def test_partitioning_changes_nothing(spark):
    series = {f"M{i}": full_range(wave(100 + 11 * i, phase=2 * i)) for i in range(1, 9)}
    ivs = [("A", ["M1", "M2"], START, 60), ("B", ["M3"], START - dt.timedelta(days=17), 60)]
    base = run_for(spark, series, ivs, n=3)
    cols = ["intervention_id", "treated_merchant_id", "control_merchant_id", "match_rank", "total_residual"]
    expected = sorted(tuple(r) for r in base.matches.select(*cols).collect())
    expected_lift = sorted(tuple(r) for r in base.estimate_lift().collect())
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        p = make_panel(spark, series).repartition(5).orderBy(F.rand(7))
        iv = make_interventions(spark, ivs)
        run = CausalRun(p, intervention_windows(iv), treated_merchants(iv), 3, checkpoint=False)
        assert sorted(tuple(r) for r in run.matches.select(*cols).collect()) == expected
        assert sorted(tuple(r) for r in run.estimate_lift().collect()) == expected_lift
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_controls_need_weeks_in_common(spark):
    """A control with two weeks only is the nearest, unless an overlap is asked for."""
    series = {f"M{i}": full_range(wave(100 + 9 * i, phase=3 * i)) for i in range(1, 6)}
    series["SPARSE"] = [(d, a) for d, a in series["M1"] if d >= START - dt.timedelta(days=14)]
    p = make_panel(spark, series)
    iv = make_interventions(spark, [("A", ["M1"], START, 60)])

    def first(**options) -> str:
        run = CausalRun(p, intervention_windows(iv), treated_merchants(iv), 1, checkpoint=False, **options)
        return run.matches.first().control_merchant_id

    assert first() == "SPARSE" and first(min_overlap_weeks=3) != "SPARSE"
    run = CausalRun(p, intervention_windows(iv), treated_merchants(iv), 9, checkpoint=False, min_overlap_weeks=60)
    assert not run.matches.collect()


def test_straddling_week_can_be_dropped(spark):
    series = {f"M{i}": full_range(wave(100 + 9 * i, phase=3 * i)) for i in range(1, 6)}
    p = make_panel(spark, series)
    for shift, gone in ((0, set()), (3, {-1})):
        iv = make_interventions(spark, [("A", ["M1", "M2"], START + dt.timedelta(days=shift), 30)])
        weeks = [
            {r.week_number for r in CausalRun(p, intervention_windows(iv), treated_merchants(iv), 2, checkpoint=False, drop_straddling_week=d).series.collect()}
            for d in (False, True)
        ]
        assert weeks[0] - weeks[1] == gone and weeks[1]
