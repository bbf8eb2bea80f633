from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    ckpt = tempfile.mkdtemp(prefix="liftwise-test-ckpt-")
    spark = (
        SparkSession.builder.master("local[*]")
        .appName("liftwise-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.checkpoint.dir", ckpt)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


def day(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def make_panel(spark, series: dict[str, list[tuple[dt.date, float]]]):
    """Gold-like panel (merchant_id, txn_date, amount, txn_count) from exact values."""
    rows = [(m, d, float(a), 1) for m, pts in series.items() for d, a in pts]
    return spark.createDataFrame(rows, "merchant_id string, txn_date date, amount double, txn_count int")


def make_interventions(spark, rows):
    """rows: (id, treated ids, start date, post_window_days)."""
    data = [(i, f"name_{i}", list(t), s, 90, p) for i, t, s, p in rows]
    schema = (
        "intervention_id string, name string, treated_merchant_ids array<string>, "
        "start_date date, pre_window_days bigint, post_window_days bigint"
    )
    return spark.createDataFrame(data, schema)


def daily(start: dt.date, end: dt.date, fn) -> list[tuple[dt.date, float]]:
    out, d = [], start
    while d <= end:
        out.append((d, round(fn(d), 2)))
        d += dt.timedelta(days=1)
    return out
