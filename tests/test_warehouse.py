"""Catalog tables: versions, checks, rejects, functions in other sessions, plans."""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import subprocess
import sys

import pytest
from conftest import SF001, make_interventions
from pyspark.sql import functions as F

from liftwise.functions import sql_functions
from liftwise.plans.context import context
from liftwise.plans.medallion import TRANSACTION_SCHEMA
from liftwise.plans.warehouse import KEYS, RefreshFailed, Warehouse, typed_or_rejected
from liftwise.session import scratch_path

MERCHANTS = "merchant_id string, location_type string, region string, size_band string, brand string, onboarded_date string"
TRANSACTIONS = "merchant_id string, txn_date string, amount string, txn_count string, note string"


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture
def small(spark):
    merchants = spark.createDataFrame([(f"M{i}", "mall", "west", "small", "BrandA", "2020-01-01") for i in range(4)], MERCHANTS)
    days = [(f"M{i}", f"2024-0{m}-1{i}", f"{i + m}.50", "2", None) for i in range(4) for m in (1, 2)]
    tx = spark.createDataFrame(days, TRANSACTIONS)
    iv = make_interventions(spark, [("A", ["M0", None], dt.date(2024, 2, 5), 20)])
    return merchants, tx, iv


def new(spark, name: str) -> Warehouse:
    return Warehouse(spark, f"wh_{name}", scratch_path(spark, name), buckets=2)


def test_refresh_replaces_and_a_failed_one_leaves_the_old(spark, small):
    merchants, tx, iv = small
    w = new(spark, "replace")
    w.refresh(merchants, tx, iv, expected={"merchants": 4, "transactions": 8, "interventions": 1, "cohorts": 1})
    assert w.table("transactions_enriched").count() == 8 and w.table("cohorts").collect()[0].merchant_id == "M0"
    before = sorted(r.tableName for r in w.sql("SHOW TABLES IN {s}").collect())
    more = tx.unionAll(tx.limit(1).withColumn("txn_date", F.lit("2024-03-01")))
    for wrong in ({"merchants": 5}, {"transactions": 8}, {"transactions_weekly": 1}, {"nothing": 1}):
        with pytest.raises(RefreshFailed):
            w.refresh(merchants, more, iv, expected=wrong)
    with pytest.raises(RefreshFailed, match="transactions_enriched"):  # a merchant twice multiplies gold
        w.refresh(merchants.unionAll(merchants.limit(1)), more, iv)
    assert sorted(r.tableName for r in w.sql("SHOW TABLES IN {s}").collect()) == before
    assert w.table("transactions_enriched").count() == 8
    w.refresh(merchants, more, iv)
    assert w.table("transactions_enriched").count() == 9 and spark.table("wh_replace.quality").where("passed").count() == 6
    assert len(w.sql("SHOW TABLES IN {s}").collect()) == len(before)  # the old version is gone


def test_rejects_keep_the_record_and_the_good_rows(spark, small):
    merchants, tx, iv = small
    bad = [("M1", "2024-13-01", "1.0", "1", "x"), (None, "2024-01-01", "1.0", "1", None), ("M2", "2024-01-02", "NaN", "1", None), ("M2", None, "1,5", "many", None)]
    w = new(spark, "rejects")
    w.refresh(merchants, tx.unionAll(spark.createDataFrame(bad, TRANSACTIONS)), iv, expected={"transactions": 8}, max_rejected=4)
    got = {r.reason: r.record for r in w.table("rejects").collect()}
    assert set(got) == {"txn_date: not a date", "merchant_id: missing", "amount: not a number", "txn_date: missing; amount: not a double; txn_count: not a int"}
    assert got["txn_date: not a date"] == '{"merchant_id":"M1","txn_date":"2024-13-01","amount":"1.0","txn_count":"1","note":"x"}'
    (q,) = w.table("quality").where("table_name = 'transactions'").collect()
    assert (q.n_rows, q.n_rejected, q.passed) == (8, 4, True)
    with pytest.raises(RefreshFailed, match="rejected"):
        w.refresh(merchants, spark.createDataFrame(bad, TRANSACTIONS), iv, max_rejected=3)


def test_empty_tables_and_clashing_columns(spark, small):
    merchants, tx, iv = small
    w = new(spark, "empty")
    w.refresh(merchants.where("false"), tx.where("false"), iv.where("false"), n_matches=3)
    assert not w.table("transactions_enriched").count() and not w.table("matches").count()
    named = tx.select("*", *[F.lit(1).alias(c) for c in ("rejected", "reason", "record", "row", "why", "year")])
    typed = typed_or_rejected(named, TRANSACTION_SCHEMA, KEYS["transactions"])
    assert typed.columns == ["merchant_id", "txn_date", "amount", "txn_count", "rejected", "reason", "record"] and not typed.where("rejected").count()


def test_a_new_session_calls_all_functions(spark):
    ctx = context(spark, SF001)
    s, other = ctx.published.schema, spark.newSession()
    assert not [f for f in other.catalog.listFunctions() if f.name == "build_control_group" and f.isTemporary]
    other.sql(f"USE {s}")
    calls = {
        "query_metric('revenue', DATE'1999-01-01', DATE'1999-12-31', group_by => 'region')": 5,
        "build_control_group('INT_001')": 9,
        "check_parallel_trends('INT_001', 10)": 40,
        "estimate_lift('INT_001', 10, week_start => 1, week_end => 4)": 1,
        "estimate_lift('none')": 0,
        "build_control_group('none', 99)": 0,
    }
    for call, least in calls.items():
        n = other.sql(f"SELECT * FROM {call}").count()
        assert n >= least and (n == 0) == (least == 0), call


def test_functions_return_their_order(spark):
    w = context(spark, SF001).published
    rows = w.call(f"check_parallel_trends('INT_002', 5)").collect()
    assert [r.week_number for r in rows] == sorted(r.week_number for r in rows) and len(rows) > 40
    for n in (10, 50):
        rows = w.call(f"build_control_group('INT_001', {n})").collect()
        assert rows == sorted(rows, key=lambda r: (r.treated_merchant_id, -r.similarity_score, r.control_merchant_id))
    rows = w.call(f"query_metric('revenue', DATE'1999-01-01', DATE'1999-12-31', 'brand')").collect()
    assert [r.dimension for r in rows] == sorted(r.dimension for r in rows)


def test_trends_of_more_controls_than_are_stored(spark):
    from liftwise.plans.causal import CausalRun

    ctx = context(spark, SF001)
    run = CausalRun(ctx.gold, ctx.windows, ctx.treated, 12)
    want = sorted(tuple(r)[1:] for r in run.parallel_trends.where("intervention_id = 'INT_001'").collect())
    got = ctx.published.call(f"check_parallel_trends('INT_001', 12)").collect()
    assert sorted(tuple(r) for r in got) == want
    want = [tuple(r)[1:] for r in run.estimate_lift().where("intervention_id = 'INT_001'").collect()]
    assert [tuple(r) for r in ctx.published.call(f"estimate_lift('INT_001', 12)").collect()] == want


def test_plans_of_the_functions(spark):
    """No scan of daily gold, weekly sums pruned by year, no join on the intervention alone, no
    exchange of bucketed gold for its weekly sums."""
    ctx = context(spark, SF001)
    for call in ("check_parallel_trends('INT_001', 10)", "estimate_lift('INT_001', 50)", "build_control_group('INT_001', 50)"):
        text = plan_text(ctx.published.call(call))
        assert "transactions_enriched" not in text and "NestedLoop" not in text and "Cartesian" not in text
        for block in text.split("\n\n"):
            if block.lstrip().startswith("(") and "Scan parquet" in block and "transactions_weekly" in block:
                assert "year" in block.split("PartitionFilters: [")[1].split("]")[0]
        keys = [line for line in text.split("\n") if line.startswith(("Left keys", "Right keys"))]
        assert not [k for k in keys if k.split("[1]: [")[-1].startswith("intervention_id#") and "match_vectors" in k]
    from liftwise.operators.weekly import weekly_panel

    with_gold = plan_text(weekly_panel(ctx.gold))
    assert "Exchange" not in with_gold.replace("ReusedExchange", "") and "Bucketed: true" in with_gold


def test_package_reaches_python_workers(tmp_path):
    """From another folder, without PYTHONPATH."""
    code = f"""
import importlib.util, os, sys
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("__spark_entry__", {__file__!r}.rsplit("/tests/", 1)[0] + "/__spark_entry__.py")
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").config("spark.sql.warehouse.dir", {str(tmp_path)!r}).getOrCreate()
q = m.queries()
print("rows", [q[k](spark, {SF001!r}).count() for k in ("build_control_group", "op9_packing") if k in q])
"""
    env = {k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "rows [" in out.stdout, out.stderr[-3000:]
