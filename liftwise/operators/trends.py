"""Parallel-trends series: weekly treated mean vs similarity-weighted control mean over
[start - 364, start + post], lift against the mean pre-period ratio.

Only cohort members (treated + matched controls) are read for the trend window: the
members table carries each member's window and joins the weekly panel on merchant_id,
so the range join becomes an equi-join plus a date filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from liftwise import config
from liftwise.functions.columns import (
    cents,
    money_avg,
    period_label,
    relative_week,
    safe_div,
)
from liftwise.functions.joins import broadcast_if_small
from liftwise.operators.weekly import as_weekly, revenue_cents


def cohort_members(treated: DataFrame, matches: DataFrame) -> DataFrame:
    """Treated ids UNION matched control ids, per intervention."""
    controls = matches.select("intervention_id", F.col("control_merchant_id").alias("merchant_id"))
    return treated.select("intervention_id", "merchant_id").unionByName(controls).distinct()


def control_weights(matches: DataFrame) -> DataFrame:
    """Weight of a control = mean of its (rounded) similarity over the treated units it
    matched (controls are shared: matching is with replacement)."""
    return matches.groupBy("intervention_id", F.col("control_merchant_id").alias("merchant_id")).agg(
        F.avg("similarity_score").alias("weight")
    )


def weekly_revenue_members(
    panel: DataFrame, windows: DataFrame, members: DataFrame, bounds=None, max_members: int | None = None
) -> DataFrame:
    """(intervention_id, merchant_id, week_start, weekly_revenue) over the trend window,
    for cohort members only, of a daily or a weekly panel. `max_members` is a proven bound on
    the member rows (treated x (1 + k)); without it the member table is counted before any
    broadcast."""
    spans = windows.select("intervention_id", F.col("pre_start").alias("lo"), F.col("post_end").alias("hi"))
    member_spans = members.join(spans, "intervention_id")
    if max_members is None:
        member_spans = broadcast_if_small(member_spans, config.MAX_BROADCAST_DIMENSION_ROWS)
    elif max_members <= config.MAX_BROADCAST_DIMENSION_ROWS:
        member_spans = F.broadcast(member_spans)
    rows = as_weekly(panel, windows, "pre_start", "post_end", bounds).join(member_spans, "merchant_id")
    near = F.col("week_start").between(F.date_sub("lo", 6), F.col("hi"))
    weekly_revenue = revenue_cents(F.col("lo"), F.col("hi")) / F.lit(100.0)
    return (
        rows.where(near)
        .select("intervention_id", "merchant_id", "week_start", weekly_revenue.alias("weekly_revenue"))
        .where("weekly_revenue IS NOT NULL")
    )


def treated_weekly_avg(weekly: DataFrame, treated: DataFrame) -> DataFrame:
    return (
        weekly.join(treated, ["intervention_id", "merchant_id"], "left_semi")
        .groupBy("intervention_id", "week_start")
        .agg(money_avg(F.col("weekly_revenue")).alias("treated_avg_revenue"))
    )


def control_weekly_avg(weekly: DataFrame, weights: DataFrame) -> DataFrame:
    joined = weekly.join(weights, ["intervention_id", "merchant_id"])
    return joined.groupBy("intervention_id", "week_start").agg(
        safe_div(F.sum(F.col("weekly_revenue") * F.col("weight")), F.sum("weight")).alias("control_avg_revenue")
    )


def trend_series(
    treated_avg: DataFrame,
    control_avg: DataFrame,
    windows: DataFrame,
    n_windows: int | None = None,
    drop_straddling_week: bool = False,
) -> DataFrame:
    """Unrounded weekly series with week_number, period, ratio, baseline and lift_pct. The week in
    which an intervention begins after its Monday counts as before it, although it has treated
    days; `drop_straddling_week` leaves it out."""
    starts = windows.select("intervention_id", "start_date")
    if n_windows is None:
        starts = broadcast_if_small(starts, config.MAX_BROADCAST_INTERVENTION_ROWS)
    elif n_windows <= config.MAX_BROADCAST_INTERVENTION_ROWS:
        starts = F.broadcast(starts)
    t = treated_avg.join(control_avg, ["intervention_id", "week_start"]).join(starts, "intervention_id")
    if drop_straddling_week:
        t = t.where((F.col("week_start") >= F.col("start_date")) | (F.date_add("week_start", 6) < F.col("start_date")))
    ratio = safe_div(F.col("treated_avg_revenue"), F.col("control_avg_revenue"))
    per_iv = Window.partitionBy("intervention_id")
    return (
        t.select(
            "intervention_id",
            "week_start",
            relative_week(F.col("week_start"), F.col("start_date")).alias("week_number"),
            period_label(F.col("week_start"), F.col("start_date")).alias("period"),
            "treated_avg_revenue",
            "control_avg_revenue",
            ratio.alias("ratio"),
        )
        .withColumn("baseline_ratio", F.avg(F.when(F.col("period") == "pre", F.col("ratio"))).over(per_iv))
        .withColumn("lift_pct", (safe_div(F.col("ratio"), F.col("baseline_ratio")) - 1) * 100)
    )


def parallel_trends(series: DataFrame) -> DataFrame:
    """The reference's output: values rounded to 2 (revenue) and 4 (lift) decimals."""
    return series.select(
        "intervention_id",
        "week_number",
        F.round("treated_avg_revenue", 2).alias("treated_avg_revenue"),
        F.round("control_avg_revenue", 2).alias("control_avg_revenue"),
        F.round("lift_pct", 4).alias("lift_pct"),
        "period",
    )


def trend_baseline(series: DataFrame) -> DataFrame:
    return series.groupBy("intervention_id").agg(
        F.avg(F.when(F.col("period") == "pre", F.col("ratio"))).alias("baseline_ratio"),
        F.count(F.when(F.col("period") == "pre", 1)).cast("int").alias("pre_weeks"),
        F.count(F.when(F.col("period") == "post", 1)).cast("int").alias("post_weeks"),
    )


VERDICT_THRESHOLD_PCT = 1.0


def trend_verdict(trends: DataFrame, threshold: float = VERDICT_THRESHOLD_PCT) -> DataFrame:
    """Mean absolute pre-period lift (of the rounded series); holds if strictly below
    the threshold (in percent)."""
    pre = F.when(F.col("period") == "pre", F.abs("lift_pct"))
    return (
        trends.groupBy("intervention_id")
        .agg(F.avg(pre).alias("pre_period_lift"))
        .withColumn("trends_hold", F.coalesce(F.col("pre_period_lift") < threshold, F.lit(False)))
        .withColumn(
            "verdict",
            F.when(F.col("trends_hold"), F.lit("parallel trends holds")).otherwise(
                F.lit("parallel trends may be violated")
            ),
        )
    )


def trend_index(trends: DataFrame) -> DataFrame:
    """Each series divided by its own pre-period mean (chart data)."""
    per_iv = Window.partitionBy("intervention_id")

    def pre_mean(c: str):
        pre = F.when(F.col("period") == "pre", F.col(c))
        return F.sum(cents(pre)).over(per_iv) / (F.count(pre).over(per_iv) * F.lit(100.0))

    t_base, c_base = pre_mean("treated_avg_revenue"), pre_mean("control_avg_revenue")
    return trends.select(
        "intervention_id",
        "week_number",
        "period",
        safe_div(F.col("treated_avg_revenue"), t_base).alias("treated_index"),
        safe_div(F.col("control_avg_revenue"), c_base).alias("control_index"),
    )
