"""Parameterised metrics over the gold fact (query_metric) and the monthly roll-up."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftwise import config
from liftwise.functions.columns import CENTS_SUM_SQL, money_sum, scan_date_range


#: The metrics as SQL over gold rows, for the DataFrame and the SQL interface alike.
METRIC_SQL = {
    "revenue": f"round({CENTS_SUM_SQL} / 100.0D, 2)",
    "transaction_count": "sum(txn_count)",
    "avg_basket": f"round({CENTS_SUM_SQL} / nullif(sum(txn_count) * 100.0D, 0), 2)",
    "active_merchants": "count(DISTINCT merchant_id)",
}


def _metric_expr(metric: str) -> Column:
    if metric not in METRIC_SQL:
        raise ValueError(f"unknown metric {metric!r}; expected one of {config.METRICS}")
    return F.expr(METRIC_SQL[metric])


def _as_date(value: str | dt.date) -> dt.date:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def query_metric(
    gold: DataFrame,
    metric: str,
    start_date: str | dt.date,
    end_date: str | dt.date,
    group_by: str | None = None,
    filter_location_type: str | None = None,
    filter_region: str | None = None,
    filter_size_band: str | None = None,
    filter_brand: str | None = None,
) -> DataFrame:
    """(dimension STRING, metric_value DOUBLE), one row per dimension value.

    Only the requested aggregate is planned; absent filters add no predicate, present
    ones reach the parquet scan as pushed filters. Grouping by a constant keeps the
    reference's zero-rows-on-empty-input behaviour even when ungrouped.
    """
    if group_by is not None and group_by not in config.MERCHANT_DIMENSIONS:
        raise ValueError(f"unknown group_by {group_by!r}")
    df = scan_date_range(gold, _as_date(start_date), _as_date(end_date))
    for column, value in (
        ("location_type", filter_location_type),
        ("region", filter_region),
        ("size_band", filter_size_band),
        ("brand", filter_brand),
    ):
        if value is not None:
            df = df.where(F.col(column) == F.lit(value))
    dim = F.col(group_by) if group_by else F.lit(None).cast("string")
    return (
        df.groupBy(dim.alias("dimension"))
        .agg(_metric_expr(metric).cast("double").alias("metric_value"))
        .orderBy(F.col("dimension").asc_nulls_first())
    )


def monthly_trend(gold: DataFrame, group_by: str | None = None) -> DataFrame:
    """Revenue, transactions and active merchants per calendar month (and dimension)."""
    keys = ["year", "month"] + ([group_by] if group_by else [])
    return gold.groupBy(*keys).agg(
        F.round(money_sum(F.col("amount")), 2).alias("revenue"),
        F.sum("txn_count").cast("long").alias("transaction_count"),
        F.count_distinct("merchant_id").cast("long").alias("active_merchants"),
    )
