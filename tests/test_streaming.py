"""Streaming refresh: incremental, exactly-once across restarts."""

from __future__ import annotations

import tempfile

from conftest import day

from liftwise.streaming.gold_refresh import start_refresh


def test_refresh_picks_up_new_files_once(spark):
    base = tempfile.mkdtemp(prefix="liftwise-stream-")
    src, sink, ckpt = f"{base}/src", f"{base}/sink", f"{base}/ckpt"
    merchants = spark.createDataFrame(
        [("M1", "urban", "asia", "mid", "BrandA", day("1994-01-01"))],
        "merchant_id string, location_type string, region string, size_band string, brand string, onboarded_date date",
    )
    schema = "merchant_id string, txn_date date, amount double, txn_count int"
    spark.createDataFrame([("M1", day("2024-01-01"), 10.0, 1), ("M2", day("2024-01-02"), 5.0, 2)], schema).write.mode(
        "append"
    ).parquet(src)
    start_refresh(spark, src, merchants, sink, ckpt).awaitTermination()
    assert spark.read.parquet(sink).count() == 2
    spark.createDataFrame([("M1", day("2024-02-05"), 7.5, 3)], schema).write.mode("append").parquet(src)
    start_refresh(spark, src, merchants, sink, ckpt).awaitTermination()
    rows = spark.read.parquet(sink).collect()
    assert len(rows) == 3
    by_day = {str(r.txn_date): r for r in rows}
    assert by_day["2024-02-05"].day_of_week == 1 and by_day["2024-02-05"].region == "asia"
    assert by_day["2024-01-02"].region is None  # left join keeps unmatched facts
