"""Causal pipeline over every intervention at once:

    match (top-k controls) -> cohort weekly series -> trends -> verdict -> gate -> lift

The normalised vectors, the matches and the cohort weekly table are each computed once
and checkpointed to the shared folder, so trends, verdict, lift and report reuse them
instead of recomputing the matching three times.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftwise import config
from liftwise.functions.joins import broadcast_if_small
from liftwise.operators import lift, matching, trends
from liftwise.operators.weekly import as_weekly
from liftwise.operators.windows import RunBounds, run_bounds
from liftwise.session import cut_lineage


@dataclass
class CausalRun:
    panel: DataFrame  # gold fact: merchant_id, txn_date, amount, ...
    windows: DataFrame  # intervention_windows(...)
    treated: DataFrame  # (intervention_id, merchant_id)
    n_matches: int | None = None
    match_window_days: int = config.MATCH_WINDOW_DAYS
    checkpoint: bool = True
    weekly_table: DataFrame | None = None  # the panel's weekly sums, where they are stored
    min_overlap_weeks: int = 1  # that a control has in common with a treated merchant
    drop_straddling_week: bool = False  # the week in which an intervention begins after its Monday

    def _keep(self, df: DataFrame) -> DataFrame:
        return cut_lineage(df) if self.checkpoint else df

    @cached_property
    def bounds(self) -> RunBounds:
        """One small action: counts and date bounds behind every broadcast decision."""
        return run_bounds(self.windows, self.treated)

    @cached_property
    def weeks(self) -> DataFrame:
        """Weekly sums of the panel over all windows: one scan, read by matching and trends."""
        if self.weekly_table is not None:
            return self.weekly_table
        return self._keep(as_weekly(self.panel, self.windows, "pre_start", "post_end", self.bounds))

    @cached_property
    def matches(self) -> DataFrame:
        m = matching.match_controls(
            self.weeks,
            self.windows,
            self.treated,
            self.n_matches,
            self.match_window_days,
            self.checkpoint,
            bounds=self.bounds,
            min_overlap_weeks=self.min_overlap_weeks,
        )
        return self._keep(m)

    @cached_property
    def members(self) -> DataFrame:
        return trends.cohort_members(self.treated, self.matches)

    @cached_property
    def weights(self) -> DataFrame:
        return trends.control_weights(self.matches)

    @cached_property
    def weekly(self) -> DataFrame:
        # Read by both the treated and the control averages: one scan of the trend window.
        k = matching.resolve_n_matches(self.n_matches)
        return self._keep(
            trends.weekly_revenue_members(
                self.weeks, self.windows, self.members, self.bounds, max_members=self.bounds.n_treated * (1 + k)
            )
        )

    @cached_property
    def treated_avg(self) -> DataFrame:
        return trends.treated_weekly_avg(self.weekly, self.treated)

    @cached_property
    def control_avg(self) -> DataFrame:
        return trends.control_weekly_avg(self.weekly, self.weights)

    @cached_property
    def series(self) -> DataFrame:
        # <= ~61 rows per intervention, derived from the checkpointed weekly table:
        # recomputing it is cheaper than another write.
        return trends.trend_series(
            self.treated_avg, self.control_avg, self.windows, self.bounds.n_interventions, self.drop_straddling_week
        )

    @property
    def parallel_trends(self) -> DataFrame:
        return trends.parallel_trends(self.series)

    @property
    def verdict(self) -> DataFrame:
        return trends.trend_verdict(self.parallel_trends)

    def estimate_lift(self, first_n_weeks=None, week_start=None, week_end=None) -> DataFrame:
        return lift.estimate_lift(self.series, first_n_weeks, week_start, week_end)


APPROVAL_WORDS = ("yes", "y", "approve", "approved", "proceed")


DECISION_ORDER = ("decided_at", "turn")


def decision_state(decisions: DataFrame, at: str | None) -> DataFrame:
    """(intervention_id, approved): whether the latest free-text decision reads as approval. Of
    decisions at the same time all must approve, and undated ones count as the latest. One
    aggregation, on a batch or a stream."""
    ok = F.coalesce(F.lower(F.trim(F.col("decision"))).isin(*APPROVAL_WORDS), F.lit(False))
    when = F.col(at) if at else F.lit(0)
    last = F.max(F.struct(when.isNull().alias("undated"), when.alias("at"), (~ok).alias("refused")))
    return decisions.groupBy("intervention_id").agg(last.alias("last")).select("intervention_id", (~F.col("last.refused")).alias("approved"))


def approved(decisions: DataFrame) -> DataFrame:
    """(intervention_id) whose latest decision reads as approval; the latest is by the first of
    the columns `decided_at`, `turn`, and where there is neither, all must approve."""
    if "approved" in decisions.columns:  # a gate's state already
        return decisions.where("approved").select("intervention_id")
    at = next((c for c in DECISION_ORDER if c in decisions.columns), None)
    return decision_state(decisions, at).where("approved").select("intervention_id")


def causal_report(run: CausalRun, interventions: DataFrame, decisions: DataFrame | None = None) -> DataFrame:
    """One row per intervention: cohort sizes, trend verdict, approval, lift.

    Without a decisions table every intervention is approved. Lift columns are NULL
    where the gate is closed or too few post weeks exist.
    """
    meta = interventions.select("intervention_id", "name")
    pairs = run.matches.groupBy("intervention_id").agg(
        F.countDistinct("treated_merchant_id").cast("int").alias("n_treated_matched"),
        F.count(F.lit(1)).cast("int").alias("n_pairs"),
    )
    verdict = run.verdict.select("intervention_id", "pre_period_lift", "trends_hold")
    if decisions is None:
        gate = meta.select("intervention_id", F.lit(True).alias("approved"))
    else:
        ok = broadcast_if_small(approved(decisions), config.MAX_BROADCAST_INTERVENTION_ROWS)
        gate = meta.join(ok.withColumn("approved", F.lit(True)), "intervention_id", "left").select(
            "intervention_id", F.coalesce("approved", F.lit(False)).alias("approved")
        )
    est = run.estimate_lift().join(gate.where("approved"), "intervention_id", "left_semi")
    return (
        meta.join(pairs, "intervention_id", "left")
        .join(verdict, "intervention_id", "left")
        .join(gate, "intervention_id", "left")
        .join(est, "intervention_id", "left")
        .select(
            "intervention_id",
            "name",
            F.coalesce("n_treated_matched", F.lit(0)).alias("n_treated_matched"),
            F.coalesce("n_pairs", F.lit(0)).alias("n_pairs"),
            "pre_period_lift",
            "trends_hold",
            "approved",
            "lift_pct",
            "ci_lower",
            "ci_upper",
            "n_weeks",
            "significant",
        )
    )
