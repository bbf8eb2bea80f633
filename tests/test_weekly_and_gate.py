"""Weekly running sums against brute force, the decision stream, the name index."""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from liftwise.operators import matching, trends, weekly
from liftwise.operators.windows import run_bounds
from liftwise.plans import causal, lookup
from liftwise.streaming import decisions

RND = random.Random(3)
START = dt.date(2023, 1, 1)


@pytest.fixture(scope="module")
def panel(spark):
    rows = [
        (f"M{m}", START + dt.timedelta(days=d), RND.choice((None, 0.004, 1.25, float("nan"), round(RND.uniform(0, 900), 2))), 1)
        for m in range(6)
        for d in range(480)
        if RND.random() < 0.6
    ]
    rows += RND.sample(rows, 40)  # days with several rows
    return rows, spark.createDataFrame(rows, "merchant_id string, txn_date date, amount double, txn_count int")


@pytest.fixture(scope="module")
def spans(spark):
    """Windows that begin and end on every weekday, one within a week, one of a single day."""
    out = [(f"W{k}", START + dt.timedelta(days=20 + k), START + dt.timedelta(days=90 + 3 * k)) for k in range(9)]
    out += [("in", dt.date(2023, 5, 9), dt.date(2023, 5, 11)), ("day", dt.date(2023, 5, 10), dt.date(2023, 5, 10)), ("none", dt.date(2030, 1, 1), dt.date(2030, 2, 1))]
    rows = [(k, lo, lo, hi, hi) for k, lo, hi in out]
    return out, spark.createDataFrame(rows, "intervention_id string, start_date date, pre_start date, pre_end date, post_end date")


def brute(rows, spans) -> dict:
    sums: dict = defaultdict(list)
    for k, lo, hi in spans:
        for m, d, x, _ in rows:
            if lo <= d <= hi and x is not None and x == x:
                sums[k, m, d - dt.timedelta(days=d.weekday())].append(x)
    return {k: sum(v) * 100 for k, v in sums.items()}


def test_stretches_of_weeks_equal_brute_force(panel, spans):
    rows, df = panel
    windows, w = spans
    want = brute(rows, windows)
    for source in (df, weekly.weekly_panel(df)):  # daily rows, or stored weekly sums
        got = {(r.intervention_id, r.merchant_id, r.week_start): r.cents for r in weekly.weeks_in_windows(source, w, "pre_start", "pre_end").collect()}
        assert got == pytest.approx(want, abs=1e-6) and len(got) == len(want)
    got = weekly.weekly_revenue(df, w, "full").collect()
    assert {(r.intervention_id, r.merchant_id, r.week_start): r.weekly_revenue * 100 for r in got} == pytest.approx(want, abs=1e-6)


def test_only_the_cuts_that_windows_need(spark, panel, spans):
    rows, df = panel
    _, w = spans
    none = spark.createDataFrame([], "intervention_id string, merchant_id string")
    mondays = w.where("intervention_id = 'W1'").withColumn("pre_start", F.lit(dt.date(2023, 1, 23))).withColumn("pre_end", F.lit(dt.date(2023, 3, 5))).withColumn("post_end", F.lit(dt.date(2023, 3, 19)))
    assert run_bounds(mondays, none).cuts == ()
    assert run_bounds(w, none).cuts == (1, 2, 3, 4, 5, 6)
    some = weekly.weekly_panel(df, (3,)).first()
    assert [x is None for x in some.cents] == [False, True, True, False, True, True, True, False]
    bounds = run_bounds(mondays, none)
    got = weekly.weeks_in_windows(df, mondays, "pre_start", "pre_end", bounds=bounds).count()
    assert got == len(brute(rows, [("W1", dt.date(2023, 1, 23), dt.date(2023, 3, 5))]))


def test_members_weeks(spark, panel, spans):
    rows, df = panel
    windows, w = spans
    members = spark.createDataFrame([(k, m) for k, _, _ in windows for m in ("M1", "M4", "gone")], "intervention_id string, merchant_id string")
    want = {k: v for k, v in brute(rows, windows).items() if k[1] in ("M1", "M4")}
    for source in (df, weekly.weekly_panel(df)):
        got = trends.weekly_revenue_members(source, w, members).collect()
        assert {(r.intervention_id, r.merchant_id, r.week_start): r.weekly_revenue * 100 for r in got} == pytest.approx(want, abs=1e-6)


def test_one_scan_of_gold_for_any_number_of_starts(spark, spans):
    from conftest import SF001

    from liftwise.plans.context import context

    gold = context(spark, SF001).gold
    starts = [(f"I{k}", dt.date(1999, 1, 4) + dt.timedelta(days=k)) for k in range(30)]
    w = spark.createDataFrame(starts, "intervention_id string, start_date date").select("*", F.date_sub("start_date", 364).alias("pre_start"), F.date_sub("start_date", 1).alias("pre_end"), F.date_add("start_date", 30).alias("post_end"))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        matching.match_vectors(gold, w).explain()
    assert buf.getvalue().count("FileScan parquet") == 1


def test_empty_panel_and_no_windows(panel, spans):
    _, df = panel
    _, w = spans
    assert not weekly.weeks_in_windows(df.where("false"), w, "pre_start", "pre_end").collect()
    assert not weekly.weeks_in_windows(df, w.where("false"), "pre_start", "pre_end").collect()
    assert not weekly.weekly_panel(df.where("false")).collect()


def test_gate_is_the_latest_decision_and_resumes(spark, tmp_path):
    src, gate, ckpt = (str(tmp_path / x) for x in ("src", "gate", "ckpt"))

    def add(rows) -> dict:
        spark.createDataFrame(rows, decisions.DECISION_SCHEMA).write.mode("append").parquet(src)
        return {r.intervention_id: r.approved for r in decisions.run_gate(spark, src, gate, ckpt).collect()}

    (tmp_path / "src").mkdir()
    assert not decisions.run_gate(spark, src, gate, ckpt).collect()  # no decision yet
    assert add([("A", "yes", 5), ("B", "no", 5), ("C", "Approve", 1)]) == {"A": True, "B": False, "C": True}
    assert add([("A", "no", 4), ("B", "proceed ", 6), ("D", None, 1)]) == {"A": True, "B": True, "C": True, "D": False}  # A's came late
    assert add([("A", "no", 5), ("C", "no", None)]) == {"A": False, "B": True, "C": False, "D": False}  # ties and undated refusals close
    assert {r.intervention_id: r.approved for r in decisions.run_gate(spark, src, gate, ckpt).collect()} == {"A": False, "B": True, "C": False, "D": False}  # nothing new
    assert sorted(r[0] for r in causal.approved(decisions.current_gate(spark, gate)).collect()) == ["B"]


def test_undated_decisions_count_as_the_latest(spark):
    rows = [("A", "yes", 1), ("A", "no", None), ("B", "no", 1), ("B", "yes", None)]
    assert [r[0] for r in causal.approved(spark.createDataFrame(rows, "intervention_id string, decision string, turn int")).collect()] == ["B"]


def brute_lookup(names: list[tuple], text: str | None) -> str | None:
    if text is None:
        return None
    tokens = text.replace("'", "").replace("%", "").lower().split()
    for i, name in sorted((i, n) for i, n in names if n is not None):
        at = 0
        for t in tokens:
            at = name.lower().find(t, at)
            if at < 0:
                break
            at += len(t)
        else:
            return i
    return None


def test_lookup_equals_brute_force_without_nested_loops(spark):
    words = ["mobile", "order", "Pilot", "a_b", "x\\y", "é", "loyalty", "ab"]
    names = [(f"I{k:03d}", "_".join(RND.choice(words) for _ in range(RND.randint(1, 4)))) for k in range(200)] + [("I999", None), ("I998", "")]
    texts = ["", "  ", "'%'", None, "nothing", "a", "É", "MOBILE  order", "order mobile pilot", "b_m", "x\\y", "bile_ord", "'pilot' 100%", "abab", "a a a"]
    texts += [" ".join(RND.choice(words)[: RND.randint(1, 7)] for _ in range(RND.randint(1, 3))) for _ in range(150)]
    view = spark.createDataFrame(names, "intervention_id string, name string")
    asked = spark.createDataFrame(list(enumerate(texts)), "query_id int, query_text string")
    out = lookup.lookup_intervention(view, asked)
    assert {r.query_id: r.intervention_id for r in out.collect()} == {k: brute_lookup(names, t) for k, t in enumerate(texts)}
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain()
    assert "NestedLoop" not in buf.getvalue() and "Cartesian" not in buf.getvalue()
    assert {r.intervention_id for r in lookup.lookup_intervention(view.where("false"), asked).collect()} == {None}
