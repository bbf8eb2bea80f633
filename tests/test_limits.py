"""Values at and beyond the sizes and shapes the sample data has."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from conftest import SF001, make_interventions
from pyspark.sql import functions as F

from liftwise.functions import columns, sql_functions
from liftwise.operators import adhoc, matching, panel, windows
from liftwise.plans import causal, lookup
from liftwise.plans.context import context
from liftwise.sources import tables


def test_merchant_code_pads_but_never_cuts(spark):
    df = spark.createDataFrame([(7,), (99_999,), (100_000,), (100_007,)], "k long")
    got = [r[0] for r in df.select(columns.merchant_code(F.col("k"))).collect()]
    assert got == ["M00007", "M99999", "M100000", "M100007"]


def test_amounts_below_a_cent_are_summed(spark):
    df = spark.range(1000).select(F.lit(0.004).alias("a"))
    total, mean = df.agg(columns.money_sum(F.col("a")), columns.money_avg(F.col("a"))).first()
    assert total == pytest.approx(4.0, abs=1e-12) and mean == pytest.approx(0.004, abs=1e-12)


def test_amounts_far_below_a_cent_and_no_amounts(spark):
    df = spark.createDataFrame([(4e-7,)] * 1000 + [(float("nan"),), (float("inf"),), (None,), (-3.25,)], "a double")
    total, mean = df.agg(columns.money_sum(F.col("a")), columns.money_avg(F.col("a"))).first()
    assert total == pytest.approx(4e-4 - 3.25, abs=1e-12) and mean == pytest.approx(total / 1001, abs=1e-15)
    cents = [0.01, 0.1, 0.29, 1.15, 1234567.89, 8.2e12 + 0.25]  # exact: no rest beyond the cents
    got = spark.createDataFrame([(x,) for x in cents], "a double").agg(F.sum(columns.sub_cents(F.col("a"))), columns.cents_sum(F.col("a"))).first()
    assert got[0] == 0 and got[1] == 1 + 10 + 29 + 115 + 123456789 + 820_000_000_000_025


def test_weeks_below_a_cent_are_not_rounded(spark):
    start = dt.date(2020, 1, 6)
    rows = [("M1", start + dt.timedelta(days=7 * k), x, 1) for k, x in enumerate((0.004, 0.008, 0.012))]
    gold = spark.createDataFrame(rows, "merchant_id string, txn_date date, amount double, txn_count int")
    win = spark.createDataFrame([("I", start, start + dt.timedelta(days=20))], "intervention_id string, pre_start date, pre_end date")
    (v,) = matching.normalize_vectors(matching.match_vectors(gold, win)).collect()
    assert v.vec[:3] == pytest.approx([0.5, 1.0, 1.5])


def test_injected_amounts_are_rounded_once(spark):
    p = spark.createDataFrame([("M1", dt.date(2020, 1, 1), 0.105, 1)], "merchant_id string, txn_date date, amount double, txn_count int")
    raw = make_interventions(spark, [("A", ["M1"], dt.date(2019, 1, 1), 30)]).withColumn("true_effect", F.lit(0.1))
    assert panel.inject_lift(p, raw).first().amount == 0.12  # 0.1155, not 0.11 * 1.1 = 0.121


def test_windows_wider_than_the_default_keep_every_week(spark):
    start = dt.date(2020, 1, 6)
    rows = [("M1", start + dt.timedelta(days=7 * k), 1.0, 1) for k in range(104)]
    gold = spark.createDataFrame(rows, "merchant_id string, txn_date date, amount double, txn_count int")
    win = spark.createDataFrame(
        [("I", start, start + dt.timedelta(days=727))], "intervention_id string, pre_start date, pre_end date"
    )
    vec = matching.window_vectors(gold, win).first().weekly_cents
    assert sum(x is not None for x in vec) == 104


def test_spine_keeps_facts_of_unknown_merchants(spark):
    day = dt.date(2020, 1, 1)
    facts = spark.createDataFrame([("A", day, 1.0, 1), ("X", day, 2.0, 1)], "merchant_id string, txn_date date, amount double, txn_count int")
    out = panel.panel_spine(spark.createDataFrame([("A",)], "merchant_id string"), facts, day, day + dt.timedelta(days=1))
    assert sorted((r.merchant_id, r.amount) for r in out.collect()) == [("A", 0.0), ("A", 1.0), ("X", 2.0)]


def test_unlisted_location_types_have_the_default_factors(spark):
    rows = [("A", dt.date(2020, 1, 1), 2.0, 3, "airport"), ("B", dt.date(2020, 1, 1), 2.0, 3, None)]
    gold = spark.createDataFrame(rows, "merchant_id string, txn_date date, amount double, day_of_week int, location_type string")
    a, b = sorted(panel.seasonality_factors(gold).collect(), key=lambda r: r.merchant_id)
    assert a.weekday_factor == 1.0 and a.annual_factor == pytest.approx(1 + 0.03 * np.sin(-0.6 * np.pi))
    assert (b.weekday_factor, b.annual_factor) == (1.0, 1.0)


def test_adhoc_reads_named_views_only(spark):
    full = spark.createDataFrame([("I", "n", 0.05)], "intervention_id string, name string, true_effect double")
    full.createOrReplaceTempView("full_table")
    views = {"v": full.select("intervention_id", "name")}
    assert adhoc.adhoc_sql(spark, "WITH c AS (SELECT * FROM v) SELECT ';' AS s, count(*) AS n FROM c", views).first().s == ";"
    for sql in (
        "SELECT true_effect FROM full_table",
        "SELECT name, (SELECT max(true_effect) FROM full_table) FROM v",
        "WITH full_table AS (SELECT * FROM full_table) SELECT * FROM full_table",
        "SELECT * FROM v JOIN (SELECT 1 AS x) full_table, full_table",
        f"SELECT * FROM parquet.`{SF001}/supplier.parquet`",
        "SELECT * FROM range(3)",
        "WITH c AS (SELECT 1 AS x) INSERT INTO full_table SELECT * FROM c",
    ):
        with pytest.raises(adhoc.AdhocRejected):
            adhoc.adhoc_sql(spark, sql, views)


def test_adhoc_leaks_are_refused(spark):
    """Names and functions that lead to other relations, classes, files or sessions."""
    full = spark.createDataFrame([("I", "n", 0.05)], "intervention_id string, name string, true_effect double")
    full.createOrReplaceTempView("full_table")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION leak() RETURNS DOUBLE RETURN (SELECT max(true_effect) FROM full_table)")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION leaks() RETURNS TABLE (x DOUBLE) RETURN SELECT true_effect FROM full_table")
    spark.range(1).createOrReplaceTempView("v")  # the caller's own view of an allowed name
    views = {"v": full.select("intervention_id", "name")}
    for sql in (
        "SELECT true_effect FROM IDENTIFIER('full_table')",
        "SELECT true_effect FROM IDENTIFIER('full' || '_table')",
        "SELECT leak() FROM v",
        "SELECT * FROM leaks()",
        "SELECT v.*, x FROM v, LATERAL leaks()",
        "SELECT reflect('java.lang.System', 'getProperty', 'user.home')",
        "SELECT java_method('java.lang.System', 'getProperty', 'user.home') FROM v",
        "SELECT IDENTIFIER('reflect')('java.lang.System', 'getProperty', 'user.home')",
        "SELECT input_file_name() FROM v",
        "SELECT name FROM v WHERE EXISTS (SELECT 1 FROM full_table)",
        "SELECT name FROM v WHERE name IN (SELECT name FROM full_table)",
        "SELECT max(leak()) OVER (ORDER BY name) FROM v",
        "SELECT builtin.reflect('java.lang.System', 'getProperty', 'user.home')",
        "FROM v SELECT TRANSFORM(name) USING 'cat' AS (x)",
        "TABLE full_table",
        "SET spark.sql.ansi.enabled=false",
        "EXPLAIN SELECT * FROM v",
        "",
    ):
        with pytest.raises(adhoc.AdhocRejected):
            adhoc.adhoc_sql(spark, sql, views).collect()
    assert spark.table("v").columns == ["id"] and spark.table("full_table").count() == 1


def test_adhoc_takes_ordinary_queries(spark):
    rows = [("a", dt.date(2020, 1, 31), 1.5), ("a", dt.date(2020, 2, 1), None), ("b", dt.date(2021, 2, 1), 4.0)]
    views = {"V": spark.createDataFrame(rows, "k string, d date, x double"), "w": spark.createDataFrame([("a", 1)], "k string, n int")}
    for sql, want in {
        "SELECT k, round(sum(x), 1) AS s FROM v GROUP BY k HAVING sum(x) > 2 ORDER BY k": [("b", 4.0)],
        "WITH m AS (SELECT date_trunc('month', d) AS m, count(*) AS n FROM v GROUP BY 1) SELECT max(n) FROM m": [(1,)],
        "SELECT v.k, n FROM v LEFT JOIN w ON v.k = w.k WHERE d >= DATE'2020-02-01' ORDER BY 1": [("a", 1), ("b", None)],
        "SELECT k FROM v WHERE x = (SELECT max(x) FROM v) UNION SELECT k FROM w ORDER BY k LIMIT 1": [("a",)],
        "SELECT k, row_number() OVER (PARTITION BY k ORDER BY d) AS r FROM v WHERE k IN ('a', 'c') ORDER BY r": [("a", 1), ("a", 2)],
        "SELECT CASE WHEN x IS NULL THEN 'none' ELSE upper(k) END AS y FROM v WHERE k LIKE 'a%' AND year(d) = 2020 ORDER BY y": [("A",), ("none",)],
        "SELECT * FROM VALUES (1), (2) AS t(a) WHERE a BETWEEN 2 AND 3": [(2,)],
        "SELECT 1 + 1": [(2,)],
        "SELECT count(DISTINCT k) FILTER (WHERE x > 1) FROM (SELECT * FROM v) s": [(2,)],
        "SELECT z FROM w LATERAL VIEW explode(array(1, 2)) e AS z ORDER BY z DESC": [(2,), (1,)],
    }.items():
        assert [tuple(r) for r in adhoc.adhoc_sql(spark, sql, views).collect()] == want, sql


def test_agent_view_leaves_no_full_view(spark):
    ctx = context(spark, SF001)
    tables.register_agent_view(spark, ctx.sources.interventions, "only_agent")
    assert "true_effect" not in spark.table("only_agent").columns
    assert not [t.name for t in spark.catalog.listTables() if "raw" in t.name]


def test_duplicate_interventions_raise(spark):
    iv = make_interventions(spark, [("I", ["A"], dt.date(2020, 1, 1), 30)] * 2)
    with pytest.raises(ValueError, match="unique"):
        windows.run_bounds(windows.intervention_windows(iv), windows.treated_merchants(iv))


def test_lookup_takes_wildcards_literally(spark):
    view = spark.createDataFrame([("I1", "mobileXorder"), ("I2", "mobile_order a\\b")], "intervention_id string, name string")
    asked = spark.createDataFrame([(1, "mobile_order"), (2, "a\\b"), (3, "nope")], "query_id int, query_text string")
    got = {r.query_id: r.intervention_id for r in lookup.lookup_intervention(view, asked).collect()}
    assert got == {1: "I2", 2: "I2", 3: None}


def test_the_latest_decision_counts(spark):
    rows = [("A", "yes", 1), ("A", "no", 2), ("B", "no", 1), ("B", "Approve ", 2), ("C", "yes", 1), ("C", "no", 1), ("D", None, 1)]
    d = spark.createDataFrame(rows, "intervention_id string, decision string, turn int")
    assert [r[0] for r in causal.approved(d).collect()] == ["B"]
    assert not causal.approved(d.drop("turn")).collect()


def test_sql_function_takes_more_matches_than_stored(spark):
    ctx = context(spark, SF001)
    def called(n: int) -> list[tuple]:
        return [tuple(r) for r in ctx.warehouse.call(f"build_control_group('INT_001', {n})").collect()]

    try:
        sql_functions.publish(ctx.warehouse, 2)
        few, many = called(2), called(4)
        assert len(many) > len(few) and set(few) <= set(many)
        sql_functions.publish(ctx.warehouse, 4)
        assert many == called(4)  # in the order of the function, too
        assert not called(0)
    finally:
        sql_functions.publish(ctx.warehouse)


def test_ties_leave_a_block_k_at_a_time():
    t = [[1.0, 1.0]] * 30
    c = [[1.0, 1.0]] * 40
    ids = [f"M{i:03d}" for i in range(40)][::-1]
    ti, ci, dist, _ = matching.block_top_k([f"T{i}" for i in range(30)], t, ids, c, 10)
    assert len(ti) == 300 and not dist.any()
    assert {ids[k] for k in ci} == {f"M{i:03d}" for i in range(10)}
