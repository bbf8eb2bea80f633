"""Metrics API behaviour, SQL/DataFrame parity, quality gates, lookup, recovery."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from conftest import SF001, daily, day, make_interventions, make_panel
from pyspark.sql import functions as F

from liftwise.operators import adhoc, metrics, panel, quality
from liftwise.operators.windows import intervention_windows, treated_merchants
from liftwise.plans.causal import CausalRun
from liftwise.plans.context import context
from liftwise.plans.lookup import lookup_intervention


@pytest.fixture(scope="module")
def ctx(spark):
    return context(spark, SF001)


PARAMS = [
    ("revenue", "1995-01-01", "2001-12-31", None, {}),
    ("transaction_count", "1997-01-01", "1998-06-30", "region", {}),
    ("avg_basket", "1996-01-01", "2000-12-31", "size_band", {"filter_brand": "BrandB"}),
    ("active_merchants", "1999-01-01", "1999-12-31", "location_type", {"filter_region": "asia"}),
]


@pytest.mark.parametrize("metric,start,end,group_by,filters", PARAMS)
def test_sql_function_equals_dataframe(spark, ctx, metric, start, end, group_by, filters):
    args = {"metric": metric, "s": start, "e": end, "g": group_by}
    names = ["filter_location_type", "filter_region", "filter_size_band", "filter_brand"]
    for n in names:
        args[n] = filters.get(n)
    sql = (
        "query_metric(:metric, CAST(:s AS DATE), CAST(:e AS DATE), :g, "
        ":filter_location_type, :filter_region, :filter_size_band, :filter_brand)"
    )
    via_sql = sorted(tuple(r) for r in ctx.warehouse.call(sql, **args).collect())
    via_df = sorted(tuple(r) for r in metrics.query_metric(ctx.gold, metric, start, end, group_by, **filters).collect())
    assert via_sql == via_df


def test_empty_range_gives_zero_rows_even_ungrouped(ctx):
    assert metrics.query_metric(ctx.gold, "revenue", "2001-01-01", "2000-01-01").count() == 0
    assert metrics.query_metric(ctx.gold, "revenue", "1980-01-01", "1980-12-31", "region").count() == 0


def test_unknown_metric_or_dimension_raises(ctx):
    with pytest.raises(ValueError):
        metrics.query_metric(ctx.gold, "profit", "1995-01-01", "1995-12-31")
    with pytest.raises(ValueError):
        metrics.query_metric(ctx.gold, "revenue", "1995-01-01", "1995-12-31", group_by="city")


def test_adhoc_rejects_non_select(spark, ctx):
    with pytest.raises(adhoc.AdhocRejected):
        adhoc.adhoc_sql(spark, "DROP TABLE x", {"transactions_enriched": ctx.gold})
    with pytest.raises(adhoc.AdhocRejected):
        adhoc.adhoc_sql(spark, "SELECT 1; SELECT 2", {"transactions_enriched": ctx.gold})


def test_quality_gates(spark, ctx):
    quality.assert_hidden(ctx.interventions, ["true_effect"])
    with pytest.raises(AssertionError):
        quality.assert_hidden(ctx.sources.interventions, ["true_effect"])
    nulls = {r.column_name: r.null_count for r in quality.null_counts_long(ctx.gold, ["region", "brand"]).collect()}
    assert nulls == {"region": 0, "brand": 0}
    rows = quality.schema_rows(spark, {"gold": ctx.gold}).collect()
    assert [r.column_name for r in rows][:3] == ["merchant_id", "txn_date", "amount"]


def test_lookup_first_match_and_escaping(spark, ctx):
    q = spark.createDataFrame(
        [(1, "Mobile  ORDER"), (2, "nothing here"), (3, "'loyalty%'"), (4, "   ")], "query_id int, query_text string"
    )
    got = {r.query_id: r.intervention_id for r in lookup_intervention(ctx.interventions, q).collect()}
    assert got == {1: "INT_001", 2: None, 3: "INT_002", 4: "INT_001"}


def test_lift_recovery_on_smooth_panel(spark):
    start = day("2024-06-03")
    series = {}
    for i in range(1, 13):
        def f(d, i=i):
            jitter = ((d.toordinal() * 7919 + i * 104729) % 1000) / 1000.0 - 0.5
            return (200 + 15 * i) * (1 + 0.15 * math.sin(d.toordinal() / 11.0) + 0.01 * jitter)

        series[f"M{i:02d}"] = daily(start - dt.timedelta(days=364), start + dt.timedelta(days=60), f)
    p = make_panel(spark, series)
    raw = make_interventions(spark, [("A", ["M01", "M02", "M03"], start, 60)]).withColumn("true_effect", F.lit(0.05))
    injected = panel.inject_lift(p, raw)
    run = CausalRun(injected, intervention_windows(raw), treated_merchants(raw), 5, checkpoint=False)
    (e,) = run.estimate_lift().collect()
    assert abs(e.lift_pct - 5.0) < 0.5
    assert e.ci_lower <= 5.0 <= e.ci_upper and e.significant


def test_inject_lift_only_treated_post(spark):
    p = make_panel(spark, {"M1": [(day("2024-01-01"), 100.0), (day("2024-02-01"), 100.0)], "M2": [(day("2024-02-01"), 10.0)]})
    raw = make_interventions(spark, [("A", ["M1"], day("2024-01-15"), 60)]).withColumn("true_effect", F.lit(0.05))
    got = {(r.merchant_id, str(r.txn_date)): (r.amount, r.txn_count) for r in panel.inject_lift(p, raw).collect()}
    assert got == {("M1", "2024-01-01"): (100.0, 1), ("M1", "2024-02-01"): (105.0, 1), ("M2", "2024-02-01"): (10.0, 1)}


def test_panel_spine_fills_gaps(spark):
    facts = make_panel(spark, {"M1": [(day("2024-01-02"), 5.0)]})
    ents = spark.createDataFrame([("M1",), ("M2",)], "merchant_id string")
    rows = panel.panel_spine(ents, facts, day("2024-01-01"), day("2024-01-03")).collect()
    assert len(rows) == 6
    assert sum(r.amount for r in rows) == 5.0 and sum(r.observed for r in rows) == 1


def test_sample_cohort_is_deterministic_and_weighted(ctx):
    a = [r.merchant_id for r in panel.sample_cohort(ctx.layers.merchants, 5, seed=1).collect()]
    b = [r.merchant_id for r in panel.sample_cohort(ctx.layers.merchants.repartition(3), 5, seed=1).collect()]
    assert a == b and len(a) == 5 and len(set(a)) == 5


@pytest.mark.parametrize("iv", ["INT_001", "INT_002"])
def test_causal_sql_functions_equal_dataframe(spark, ctx, iv):
    w = ctx.published
    run = CausalRun(ctx.gold, ctx.windows, ctx.treated, 10)
    df_lift = [tuple(r)[1:] for r in run.estimate_lift(first_n_weeks=3).where(F.col("intervention_id") == iv).collect()]
    sql_lift = [tuple(r) for r in w.call(f"estimate_lift('{iv}', 10, 3)").collect()]
    assert df_lift == sql_lift
    cols = ["week_number", "treated_avg_revenue", "control_avg_revenue", "lift_pct", "period"]
    df_tr = sorted(tuple(r) for r in run.parallel_trends.where(F.col("intervention_id") == iv).select(*cols).collect())
    sql_tr = sorted(tuple(r) for r in w.call(f"check_parallel_trends('{iv}', 5)").collect())
    df_tr5 = sorted(
        tuple(r)
        for r in CausalRun(ctx.gold, ctx.windows, ctx.treated, 5).parallel_trends.where(F.col("intervention_id") == iv).select(*cols).collect()
    )
    assert sql_tr == df_tr5 and len(df_tr) == len(df_tr5)


def test_approval_gate_closes_lift(spark, ctx):
    from liftwise.plans.causal import causal_report

    decisions = spark.createDataFrame([("INT_001", " Yes "), ("INT_002", "not now")], "intervention_id string, decision string")
    run = CausalRun(ctx.gold, ctx.windows, ctx.treated, 10)
    rows = {r.intervention_id: r for r in causal_report(run, ctx.interventions, decisions).collect()}
    assert rows["INT_001"].approved and not rows["INT_002"].approved
    assert rows["INT_002"].lift_pct is None and rows["INT_002"].n_weeks is None


def test_n_matches_default_and_validation():
    from liftwise.operators.matching import resolve_n_matches

    assert resolve_n_matches(None) == 10 and resolve_n_matches(0) == 10 and resolve_n_matches(3) == 3
    with pytest.raises(ValueError):
        resolve_n_matches(-1)


def test_adhoc_rejects_relations_outside_allow_list(spark, ctx):
    sql = f"SELECT COUNT(*) AS n FROM parquet.`{SF001}/lineitem.parquet`"
    with pytest.raises(adhoc.AdhocRejected):
        adhoc.adhoc_sql(spark, sql, {"transactions_enriched": ctx.gold})
    ok = adhoc.adhoc_sql(spark, "SELECT COUNT(*) AS n FROM transactions_enriched", {"transactions_enriched": ctx.gold})
    assert ok.first().n > 0


def test_inject_lift_overlapping_cohorts_multiply(spark):
    p = make_panel(
        spark,
        {"M1": [(day("2024-01-01"), 100.0), (day("2024-02-01"), 100.0), (day("2024-03-01"), 100.0)]},
    )
    raw = make_interventions(
        spark, [("A", ["M1"], day("2024-01-15"), 60), ("B", ["M1"], day("2024-02-15"), 60)]
    ).withColumn("true_effect", F.when(F.col("intervention_id") == "A", 0.10).otherwise(0.20))
    got = {str(r.txn_date): r.amount for r in panel.inject_lift(p, raw).collect()}
    assert got == {"2024-01-01": 100.0, "2024-02-01": 110.0, "2024-03-01": 132.0}


def test_seasonality_december_bump_and_weekend(spark):
    rows = [
        ("M1", day("2023-12-02"), 100.0, "urban", 6),  # Saturday in December
        ("M2", day("2023-12-02"), 100.0, "campus", 6),
        ("M3", day("2023-06-05"), 100.0, "highway", 1),  # Monday in June
    ]
    df = spark.createDataFrame(rows, "merchant_id string, txn_date date, amount double, location_type string, day_of_week int")
    got = {r.merchant_id: r for r in panel.seasonality_factors(df).collect()}
    assert got["M1"].weekday_factor == 0.70 and got["M2"].weekday_factor == 0.70
    assert abs(got["M1"].annual_factor / got["M2"].annual_factor - 1.10) < 1e-12  # same wave, bump on urban only
    assert got["M3"].weekday_factor == 0.94
    doy = (day("2023-06-05").timetuple().tm_yday - 1) / 365.0
    assert abs(got["M3"].annual_factor - (1 + 0.08 * math.sin(2 * math.pi * (doy - 0.25)))) < 1e-12
    assert abs(got["M3"].deseasonalized_amount - 100.0 / (0.94 * got["M3"].annual_factor)) < 1e-9
