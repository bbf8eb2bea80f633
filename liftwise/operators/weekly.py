"""Weekly revenue as running sums over the days of a week.

`weekly_panel` aggregates the daily rows once per (merchant, Monday week). A week's row keeps
arrays of running sums: entry o is the sum over the week's first o days, so the revenue of any
stretch of days within a week is the difference of two entries. Windows that begin or end
inside a week read the same rows as windows of whole weeks; daily rows are scanned once for any
number of windows, and no daily row is copied per window.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftwise import config
from liftwise.functions.columns import REST, cents, finite, scan_date_range, sub_cents, week_bucket
from liftwise.operators.windows import RunBounds, window_summary

EVERY_DAY = tuple(range(1, 7))
COLUMNS = ("merchant_id", "week_start", "year", "cents", "rests", "days")


def weekly_panel(panel: DataFrame, cuts: Iterable[int] = EVERY_DAY) -> DataFrame:
    """(merchant_id, week_start, year, cents, rests, days): running sums of whole cents, of
    billionths of a cent beyond them, and of the number of amounts. Entries 0 and 7 (nothing,
    and the week) are always there; of the days between, those in `cuts`, else NULL."""
    cuts = sorted(set(cuts) & set(EVERY_DAY))
    amount = F.col("amount")
    values = {"cents": cents(amount), "rests": sub_cents(amount), "days": F.when(finite(amount).isNotNull(), 1)}
    day = F.datediff("txn_date", week_bucket(F.col("txn_date")))
    rows = panel.select("merchant_id", week_bucket(F.col("txn_date")).alias("week_start"), day.alias("day"), *[v.alias(k) for k, v in values.items()])
    sums = [F.sum(F.when(F.col("day") < o, F.col(k)) if o < 7 else F.col(k)).alias(f"{k}_{o}") for k in values for o in (*cuts, 7)]

    def running(name: str) -> Column:
        entries = [F.lit(0).cast("long")]
        entries += [F.coalesce(F.col(f"{name}_{o}"), F.lit(0)) if o in cuts or o == 7 else F.lit(None).cast("long") for o in range(1, 8)]
        return F.array(*entries).alias(name)

    grouped = rows.groupBy("merchant_id", "week_start").agg(*sums)
    return grouped.select("merchant_id", "week_start", F.year("week_start").alias("year"), *[running(k) for k in values])


def is_weekly(panel: DataFrame) -> bool:
    return set(COLUMNS) <= set(panel.columns)


def as_weekly(panel: DataFrame, windows: DataFrame, lo: str, hi: str, bounds: RunBounds | None = None) -> DataFrame:
    """The weekly rows of a panel that the windows [lo, hi] touch; a panel that is weekly
    already is only filtered."""
    first, last, _ = bounds.window(hi) if bounds is not None else window_summary(windows, lo, hi)
    if first is None or last is None:
        return (panel if is_weekly(panel) else weekly_panel(panel)).where(F.lit(False))
    if is_weekly(panel):
        monday = first.fromordinal(first.toordinal() - first.weekday())
        return scan_date_range(panel, monday, last, "week_start")
    return weekly_panel(scan_date_range(panel, first, last), bounds.cuts if bounds is not None else EVERY_DAY)


def _between(name: str, lo: Column, hi: Column) -> Column:
    """Sum of a week's days within [lo, hi], from its running sums."""
    start = F.greatest(F.datediff(lo, F.col("week_start")), F.lit(0))
    end = F.least(F.datediff(hi, F.col("week_start")) + 1, F.lit(7))
    return F.get(F.col(name), end) - F.get(F.col(name), start)


def revenue_cents(lo: Column, hi: Column) -> Column:
    """Revenue of a week's days within [lo, hi] in cents, NULL without an amount there."""
    total = _between("cents", lo, hi) + _between("rests", lo, hi) / F.lit(float(REST))
    return F.when(_between("days", lo, hi) > 0, total)


def weeks_in_windows(
    weekly: DataFrame,
    windows: DataFrame,
    lo: str,
    hi: str,
    salt_buckets: int = 32,
    bounds: RunBounds | None = None,
    key: str = "intervention_id",
) -> DataFrame:
    """(key, merchant_id, week_start, base_week, cents): each merchant's revenue in each window,
    week by week; base_week is the Monday of the window's first week.

    The (window x week) table is broadcast when its proven row bound allows. Beyond that it is
    joined by shuffle on (week_start, salt): a week alone has only a few hundred values, so
    each row gets a salt from its merchant id and the table is replicated once per salt.
    """
    _, _, week_rows = bounds.window(hi) if bounds is not None else window_summary(windows, lo, hi)
    weeks = windows.select(
        key,
        F.col(lo).alias("lo"),
        F.col(hi).alias("hi"),
        F.explode(F.sequence(week_bucket(F.col(lo)), week_bucket(F.col(hi)), F.expr("INTERVAL 7 DAYS"))).alias("week_start"),
    )
    rows = as_weekly(weekly, windows, lo, hi, bounds)
    if week_rows <= config.MAX_BROADCAST_WINDOW_WEEK_ROWS:  # proven bound, no extra count
        joined = rows.join(F.broadcast(weeks), "week_start")
    else:
        salted = rows.withColumn("_salt", F.pmod(F.xxhash64("merchant_id"), F.lit(salt_buckets)).cast("int"))
        weeks = weeks.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
        joined = salted.join(weeks, ["week_start", "_salt"])
    value = revenue_cents(F.col("lo"), F.col("hi"))
    out = joined.select(key, "merchant_id", "week_start", week_bucket(F.col("lo")).alias("base_week"), value.alias("cents"))
    return out.where("cents IS NOT NULL")


def weekly_revenue(panel: DataFrame, windows: DataFrame, window: str = "match") -> DataFrame:
    """(intervention_id, merchant_id, week_start, weekly_revenue) over the match window
    (`window="match"`) or the whole trend window (`window="full"`)."""
    rows = weeks_in_windows(panel, windows, "pre_start", "pre_end" if window == "match" else "post_end")
    return rows.select("intervention_id", "merchant_id", "week_start", (F.col("cents") / 100.0).alias("weekly_revenue"))
