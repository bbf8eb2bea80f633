"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query runs over the whole fixture tables at the given scale; oracles for the
same names live in `liftwise.plans.oracles`. Double columns that are not already
rounded by the method are rounded to a fixed number of decimals so two engines'
summation orders do not change the value hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftwise import config
from liftwise.operators import adhoc, lift, matching, metrics, panel, quality, trends, weekly, windows
from liftwise.plans import causal, medallion, warehouse
from liftwise.plans.context import context
from liftwise.plans.lookup import lookup_intervention as _lookup
from liftwise.session import scratch_path
from liftwise.sources import fixture, tables
from liftwise.streaming.decisions import run_gate

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def _run(spark: SparkSession, sf_dir: str, n_matches: int = 10, gold: DataFrame | None = None) -> causal.CausalRun:
    ctx = context(spark, sf_dir)
    if gold is not None:
        return causal.CausalRun(gold, ctx.windows, ctx.treated, n_matches)
    return causal.CausalRun(ctx.gold, ctx.windows, ctx.treated, n_matches, weekly_table=ctx.layers.weekly)


# ---------------------------------------------------------------- ingest


@query
def bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the three bronze tables as parquet to the shared folder, read them back,
    and return the transactions as read (schema from the files)."""
    src = context(spark, sf_dir).sources
    root = scratch_path(spark, "bronze")
    for name, df in (("merchants", src.merchants), ("transactions", src.transactions), ("interventions", src.interventions)):
        tables.overwrite(df, f"{root}/{name}")
    return tables.read_parquet(spark, f"{root}/transactions", ("merchant_id", "txn_date", "amount", "txn_count"))


@query
def interventions_agent_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = context(spark, sf_dir)
    tables.register_agent_view(spark, ctx.sources.interventions, "interventions_agent_view")
    view = spark.table("interventions_agent_view")
    quality.assert_hidden(view, ["true_effect"])
    return view


@query
def silver_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context(spark, sf_dir).layers.merchants


@query
def silver_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context(spark, sf_dir).layers.transactions


@query
def gold_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context(spark, sf_dir).gold


@query
def silver_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = context(spark, sf_dir).layers.transactions
    return quality.sample_rows(
        tx, ["merchant_id", "txn_date"], ["merchant_id", "txn_date", "year", "month", "day_of_week", "is_weekend"]
    )


# ---------------------------------------------------------------- quality


@query
def dq_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = context(spark, sf_dir)
    counts = quality.row_counts(
        {
            "merchants": ctx.layers.merchants,
            "transactions": ctx.layers.transactions,
            "interventions": ctx.sources.interventions,
            "interventions_agent_view": ctx.interventions,
            "transactions_enriched": ctx.gold,
        },
        expected={"interventions": 2},
    )
    return counts


@query
def dq_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_counts_long(context(spark, sf_dir).gold, config.MERCHANT_DIMENSIONS)


# ---------------------------------------------------------------- metrics


def _metric(metric, start, end, group_by=None, **filters):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return metrics.query_metric(context(spark, sf_dir).gold, metric, start, end, group_by, **filters)

    return run


QUERIES["metric_revenue_total"] = _metric("revenue", "1995-01-01", "2001-12-31")
QUERIES["metric_revenue_by_region"] = _metric("revenue", "1999-01-01", "1999-12-31", "region")
QUERIES["metric_transaction_count"] = _metric("transaction_count", "1998-01-01", "1998-12-31", "size_band")
QUERIES["metric_avg_basket"] = _metric("avg_basket", "1998-07-01", "1999-06-30", "location_type")
QUERIES["metric_active_merchants"] = _metric("active_merchants", "2000-01-01", "2000-12-31", "brand")
QUERIES["metric_filtered"] = _metric(
    "revenue", "1996-01-01", "2000-12-31", "region", filter_location_type="urban", filter_size_band="mid"
)


@query
def monthly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.monthly_trend(context(spark, sf_dir).gold)


ADHOC_EXAMPLE = """
SELECT location_type,
       ROUND(SUM(amount), 2) AS revenue,
       CAST(COUNT(DISTINCT merchant_id) AS BIGINT) AS merchants
FROM transactions_enriched
WHERE txn_date BETWEEN DATE '1999-01-01' AND DATE '1999-03-31'
GROUP BY location_type
"""


@query
def adhoc_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = context(spark, sf_dir).gold
    return adhoc.adhoc_sql(spark, ADHOC_EXAMPLE, {"transactions_enriched": gold})


# ---------------------------------------------------------------- matching


@query
def intervention_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of the promotions of all parts."""
    return windows.intervention_windows(fixture.promotions(spark, sf_dir))


@query
def treated_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context(spark, sf_dir).treated


def _vectors(spark, sf_dir):
    ctx = context(spark, sf_dir)
    return ctx, matching.normalize_vectors(matching.match_vectors(ctx.layers.weekly, ctx.windows))


@query
def control_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx, vecs = _vectors(spark, sf_dir)
    _, controls = matching.split_cohorts(vecs, ctx.treated)
    return controls.select("intervention_id", "merchant_id")


@query
def weekly_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = context(spark, sf_dir)
    rows = weekly.weekly_revenue(ctx.layers.weekly, ctx.windows)
    return rows.withColumn("weekly_revenue", F.round("weekly_revenue", 8))


@query
def normalized_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, vecs = _vectors(spark, sf_dir)
    rows = matching.vectors_as_rows(vecs, "vec", "normalized_revenue")
    return rows.withColumn("normalized_revenue", F.round("normalized_revenue", 8))


@query
def build_control_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.build_control_group(_run(spark, sf_dir).matches)


@query
def cohort_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir).members


@query
def control_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir).weights.withColumn("weight", F.round("weight", 8))


@query
def matches_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.as_json_records(matching.build_control_group(_run(spark, sf_dir).matches))


# ---------------------------------------------------------------- trends


@query
def treated_weekly_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir).treated_avg.withColumn("treated_avg_revenue", F.round("treated_avg_revenue", 6))


@query
def control_weekly_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir).control_avg.withColumn("control_avg_revenue", F.round("control_avg_revenue", 6))


@query
def parallel_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir).parallel_trends


@query
def trend_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = trends.trend_baseline(_run(spark, sf_dir).series)
    return b.withColumn("baseline_ratio", F.round("baseline_ratio", 10))


@query
def trend_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _run(spark, sf_dir).verdict
    return v.withColumn("pre_period_lift", F.round("pre_period_lift", 8))


@query
def trend_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    idx = trends.trend_index(_run(spark, sf_dir).parallel_trends)
    return idx.withColumn("treated_index", F.round("treated_index", 8)).withColumn(
        "control_index", F.round("control_index", 8)
    )


# ---------------------------------------------------------------- lift


@query
def lift_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = lift.lift_stats(lift.post_weeks(_run(spark, sf_dir).series))
    return s.select(
        "intervention_id",
        F.round("mean_lift", 8).alias("mean_lift"),
        F.round("std_lift", 8).alias("std_lift"),
        "n_weeks",
        "t_val",
    )


@query
def estimate_lift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir).estimate_lift()


@query
def lift_first_n_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir).estimate_lift(first_n_weeks=4)


@query
def lift_week_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir).estimate_lift(week_start=2, week_end=6)


# ---------------------------------------------------------------- report


@query
def lookup_intervention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Promotions of all parts, looked up by the parts' names and by the first word of each
    turn of the conversations."""
    return _lookup(fixture.promotions(spark, sf_dir), fixture.lookup_texts(spark, sf_dir))


@query
def causal_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = context(spark, sf_dir)
    return causal.causal_report(_run(spark, sf_dir), ctx.interventions).withColumn(
        "pre_period_lift", F.round("pre_period_lift", 8)
    )


@query
def causal_report_gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report behind a gate whose decisions come as a stream, from the conversations."""
    ctx = context(spark, sf_dir)
    path = scratch_path(spark, "decisions")
    tables.overwrite(fixture.decisions(spark, sf_dir).repartition(4), path)
    gate = run_gate(spark, path)
    return causal.causal_report(_run(spark, sf_dir), ctx.interventions, gate).withColumn(
        "pre_period_lift", F.round("pre_period_lift", 8)
    )


def injected_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = context(spark, sf_dir)
    return panel.inject_lift(ctx.gold, ctx.sources.interventions)


@query
def inject_lift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return injected_gold(spark, sf_dir).select("merchant_id", "txn_date", "amount", "txn_count")


@query
def lift_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimate on the panel with the known effect injected, against the hidden truth."""
    ctx = context(spark, sf_dir)
    est = _run(spark, sf_dir, gold=injected_gold(spark, sf_dir)).estimate_lift()
    truth = ctx.sources.interventions.select("intervention_id", (F.col("true_effect") * 100).alias("true_lift_pct"))
    return est.join(truth, "intervention_id").select(
        "intervention_id",
        "lift_pct",
        "ci_lower",
        "ci_upper",
        "true_lift_pct",
        F.round(F.col("lift_pct") - F.col("true_lift_pct"), 4).alias("error_pct"),
        ((F.col("ci_lower") <= F.col("true_lift_pct")) & (F.col("true_lift_pct") <= F.col("ci_upper"))).alias(
            "covered"
        ),
    )


# ---------------------------------------------------------------- panel


@query
def panel_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = context(spark, sf_dir)
    tx = ctx.layers.transactions
    bounds = tx.agg(F.min("txn_date").alias("lo"), F.max("txn_date").alias("hi")).first()
    return panel.panel_spine(ctx.layers.merchants, tx, bounds["lo"], bounds["hi"])


@query
def seasonality_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = panel.seasonality_factors(context(spark, sf_dir).gold)
    return s.select(
        "merchant_id",
        "txn_date",
        F.round("weekday_factor", 8).alias("weekday_factor"),
        F.round("annual_factor", 8).alias("annual_factor"),
        F.round("deseasonalized_amount", 6).alias("deseasonalized_amount"),
    )


@query
def seasonality_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = panel.seasonality_estimates(context(spark, sf_dir).gold)
    return e.select("location_type", "n_rows", *[F.round(c, 7).alias(c) for c in ("constant", *panel.TERMS)])


@query
def sample_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = context(spark, sf_dir).layers.merchants
    n = 25
    return panel.sample_cohort(m, n).withColumn("sample_key", F.round("sample_key", 8))


# ---------------------------------------------------------------- SQL surface


@query
def tvf_query_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context(spark, sf_dir).warehouse.call(
        "query_metric(metric => :metric, start_date => DATE'1999-01-01', end_date => DATE'1999-12-31', "
        "group_by => :group_by, filter_size_band => :size_band)",
        metric="avg_basket",
        group_by="brand",
        size_band="mid",
    )


@query
def tvf_build_control_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context(spark, sf_dir).published.call("build_control_group('INT_001', 10)")


@query
def tvf_build_control_group_k50(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More controls than are stored: compared in SQL."""
    return context(spark, sf_dir).published.call("build_control_group('INT_001', 50)")


@query
def tvf_parallel_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context(spark, sf_dir).published.call("check_parallel_trends('INT_001', 10)")


@query
def tvf_estimate_lift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context(spark, sf_dir).published.call("estimate_lift('INT_001', 10, NULL, NULL, NULL)")


# ---------------------------------------------------------------- warehouse


@query
def warehouse_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts observed by the refresh's writes, with what it expected and rejected."""
    return context(spark, sf_dir).warehouse.table("quality")


@query
def silver_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions as text, of which some are none (amounts of round hundreds become words,
    the 13th of a month a day that is none): rejected rows by reason, and the good ones."""
    tx = context(spark, sf_dir).layers.transactions
    text = tx.select(
        "merchant_id",
        F.when(F.dayofmonth("txn_date") == 13, F.date_format("txn_date", "yyyy-MM-99")).otherwise(F.date_format("txn_date", "yyyy-MM-dd")).alias("txn_date"),
        F.when(F.col("amount") % 100 < 1, F.lit("n/a")).otherwise(F.col("amount").cast("string")).alias("amount"),
        F.col("txn_count").cast("string").alias("txn_count"),
    )
    typed = warehouse.typed_or_rejected(text, medallion.TRANSACTION_SCHEMA, warehouse.KEYS["transactions"])
    return typed.groupBy(F.coalesce("reason", F.lit("")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("record").alias("n_records"),
        F.sum("txn_count").cast("long").alias("txn_count"),
    )


# ---------------------------------------------------------------- streaming


@query
def gold_stream_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold built incrementally by the streaming refresh from bronze transaction files
    (written from the fixture), read back from the sink: equals the batch gold."""
    from liftwise.streaming.gold_refresh import refresh_once

    ctx = context(spark, sf_dir)
    src = scratch_path(spark, "bronze-tx-stream")
    tables.overwrite(ctx.sources.transactions, src)
    return refresh_once(spark, src, ctx.layers.merchants, scratch_path(spark, "gold-stream"))
