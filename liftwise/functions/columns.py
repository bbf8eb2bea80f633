"""Column expressions used across operators. All are built-in Spark functions, so they
stay inside whole-stage codegen."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def safe_div(numerator: Column, denominator: Column) -> Column:
    """`a / NULLIF(b, 0)`: NULL instead of a division-by-zero error under ANSI mode."""
    return numerator / F.nullif(denominator, F.lit(0))


def week_bucket(day: Column) -> Column:
    """Monday of the week containing `day`, as a DATE."""
    return F.trunc(day, "week")


def iso_weekday(day: Column) -> Column:
    """ISO weekday, 1 = Monday ... 7 = Sunday."""
    return ((F.dayofweek(day) + 5) % 7 + 1).cast("int")


def relative_week(week_start: Column, start_date: Column) -> Column:
    """Weeks from the intervention start, floored toward minus infinity."""
    return F.floor(F.datediff(week_start, start_date) / F.lit(7.0)).cast("int")


def period_label(week_start: Column, start_date: Column) -> Column:
    return F.when(week_start < start_date, F.lit("pre")).otherwise(F.lit("post"))


def similarity(total_residual: Column) -> Column:
    return F.round(F.lit(1.0) / (F.lit(1.0) + total_residual), 4)


def merchant_code(int_key: Column) -> Column:
    """`M%05d` identifiers from integer keys: padded to five digits, never cut."""
    digits = int_key.cast("string")
    return F.concat(F.lit("M"), F.when(F.length(digits) >= 5, digits).otherwise(F.lpad(digits, 5, "0")))


REST = 1_000_000_000  # parts of a cent that are kept beyond it


def finite(amount: Column) -> Column:
    """NaN and infinities are no amounts: NULL, like a missing one."""
    return F.when(F.abs(amount) < F.lit(float("inf")), amount)


def cents(amount: Column) -> Column:
    """Money rounded to integer cents; `sub_cents` is what the rounding leaves."""
    return F.round(finite(amount) * 100).cast("long")


def sub_cents(amount: Column) -> Column:
    """The rest of an amount beyond its cents, in billionths of a cent (0 for cent amounts)."""
    whole = F.round(amount * 100)
    return F.when(whole / 100.0 == amount, F.lit(0).cast("long")).otherwise(
        F.round((finite(amount) * 100 - whole) * REST).cast("long")
    )


def cents_sum(amount: Column) -> Column:
    """SUM of money in cents as a double: integer cents and integer rests summed apart, so the
    sum is independent of partitioning and order and no row is rounded to a cent."""
    return F.sum(cents(amount)) + F.sum(sub_cents(amount)) / F.lit(float(REST))


#: `cents_sum` of the column `amount` as SQL.
CENTS_SUM_SQL = (
    "(sum(bigint(round(if(abs(amount) < double('infinity'), amount, NULL) * 100))) + "
    "sum(if(round(amount * 100) / 100.0D = amount, 0L, "
    "bigint(round((if(abs(amount) < double('infinity'), amount, NULL) * 100 - round(amount * 100)) * "
    f"{REST})))) / {REST}D)"
)


def money_sum(amount: Column) -> Column:
    """Exact SUM of money (to a billionth of a cent), one division at the end."""
    return cents_sum(amount) / F.lit(100.0)


def money_avg(amount: Column) -> Column:
    """Exact AVG of money over the finite values: one correctly rounded division."""
    return cents_sum(amount) / (F.count(finite(amount)) * F.lit(100.0))


def scan_date_range(df: DataFrame, first: dt.date | None, last: dt.date | None, column: str = "txn_date") -> DataFrame:
    """Literal date bounds that reach the scan: a pushed filter on `column`, plus a
    `year` predicate when the frame has one (partition pruning on the gold layout).
    No bounds (no windows) keeps no row."""
    if first is None or last is None:
        return df.where(F.lit(False))
    out = df.where(F.col(column).between(F.lit(first), F.lit(last)))
    if "year" in df.columns:
        out = out.where(F.col("year").between(F.lit(first.year), F.lit(last.year)))
    return out
