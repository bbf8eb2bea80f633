"""Task sizes that do not grow with the tables."""

from __future__ import annotations

import datetime as dt

from liftwise import config
from liftwise.sources import fixture


def test_transactions_take_as_many_tasks_as_rows_ask_for(spark, tmp_path, monkeypatch):
    day = dt.date(1999, 1, 1)
    rows = [(k % 40, k % 7, 1.25 * k, day + dt.timedelta(days=k % 90)) for k in range(6000)]
    spark.createDataFrame(rows, "l_suppkey long, l_orderkey long, l_extendedprice double, l_shipdate date").write.parquet(str(tmp_path / "lineitem.parquet"))
    before = sorted(fixture.transactions(spark, str(tmp_path)).collect())
    monkeypatch.setattr(config, "SOURCE_ROWS_PER_TASK", 100)
    out = fixture.transactions(spark, str(tmp_path))
    assert out.rdd.getNumPartitions() == 60 and sorted(out.collect()) == before


def test_a_bucket_of_gold_fits_a_task():
    """About 600 bytes a row while a bucket is summed by weeks; 3,600 MB is the limit of a task."""
    assert config.BUCKET_ROWS * 600 < 1_000_000_000
