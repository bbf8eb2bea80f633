"""Intervention windows and cohorts, and the bounds of a run over them.

Windows per intervention (dates inclusive):
    match window  [start - 364, start - 1]
    trend window  [start - 364, start + post_window_days]
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftwise import config
from liftwise.functions.columns import week_bucket


def intervention_windows(interventions: DataFrame, match_window_days: int = config.MATCH_WINDOW_DAYS) -> DataFrame:
    return interventions.select(
        "intervention_id",
        "start_date",
        F.date_sub("start_date", match_window_days).alias("pre_start"),
        F.date_sub("start_date", 1).alias("pre_end"),
        F.date_add("start_date", F.col("post_window_days").cast("int")).alias("post_end"),
    )


def treated_merchants(interventions: DataFrame) -> DataFrame:
    """(intervention_id, merchant_id) per cohort member; NULL ids are dropped so they
    cannot empty the control pool."""
    return (
        interventions.select("intervention_id", F.explode("treated_merchant_ids").alias("merchant_id"))
        .where(F.col("merchant_id").isNotNull())
        .dropDuplicates(["intervention_id", "merchant_id"])
    )


@dataclass(frozen=True)
class RunBounds:
    """Sizes and date bounds of a set of interventions, from one small action. Every
    broadcast decision of a causal run is taken against these proven bounds."""

    n_interventions: int
    n_treated: int
    match_first: dt.date | None
    match_last: dt.date | None
    trend_first: dt.date | None
    trend_last: dt.date | None
    match_week_rows: int
    trend_week_rows: int
    match_span_days: int = 0
    cuts: tuple[int, ...] = tuple(range(1, 7))  # days after a Monday at which a window begins or ends

    def window(self, hi: str):
        if hi == "pre_end":
            return self.match_first, self.match_last, self.match_week_rows
        return self.trend_first, self.trend_last, self.trend_week_rows


def run_bounds(windows: DataFrame, treated: DataFrame) -> RunBounds:
    edges = [F.datediff(day, week_bucket(day)) for day in (F.col("pre_start"), F.date_add("pre_end", 1), F.date_add("post_end", 1))]
    per_iv = treated.groupBy("intervention_id").agg(F.count(F.lit(1)).alias("n_t"))
    row = (
        windows.join(per_iv, "intervention_id", "left")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_distinct("intervention_id").alias("n_ids"),
            F.sum(F.coalesce("n_t", F.lit(0))).alias("n_t"),
            F.min("pre_start").alias("lo"),
            F.max("pre_end").alias("mhi"),
            F.max("post_end").alias("thi"),
            F.max(F.datediff("pre_end", "pre_start")).alias("mspan"),
            F.max(F.datediff("post_end", "pre_start")).alias("tspan"),
            F.collect_set(F.array(*edges)).alias("edges"),  # of weekdays: 343 values at most
        )
        .first()
    )
    n = int(row["n"] or 0)
    if n != int(row["n_ids"] or 0):
        raise ValueError("intervention ids must be unique and not null: duplicates would repeat every match")
    return RunBounds(
        n_interventions=n,
        n_treated=int(row["n_t"] or 0),
        match_first=row["lo"],
        match_last=row["mhi"],
        trend_first=row["lo"],
        trend_last=row["thi"],
        match_week_rows=n * (int(row["mspan"] or 0) // 7 + 2),
        trend_week_rows=n * (int(row["tspan"] or 0) // 7 + 2),
        match_span_days=int(row["mspan"] or 0) + 1,
        cuts=tuple(sorted({day for e in row["edges"] for day in e if day})),
    )


def window_summary(windows: DataFrame, lo: str, hi: str):
    """One small action over the windows: (min lo, max hi, upper bound on the rows of the
    intervention x week table)."""
    row = windows.agg(
        F.min(lo).alias("lo"),
        F.max(hi).alias("hi"),
        F.count(F.lit(1)).alias("n"),
        F.max(F.datediff(F.col(hi), F.col(lo))).alias("span"),
    ).first()
    week_rows = int(row["n"] or 0) * ((int(row["span"] or 0)) // 7 + 2)
    return row["lo"], row["hi"], week_rows
