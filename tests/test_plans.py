"""Plan audit: the physical plans of all registered queries, checked for the shapes
that do not survive scale."""

from __future__ import annotations

import contextlib
import io

import pytest
from conftest import SF001

from __spark_entry__ import queries

# None is allowed one.
NESTED_LOOP_OK: set[str] = set()


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("key", sorted(queries()))
def test_no_cartesian_or_unexpected_nested_loop(spark, key):
    text = plan_text(queries()[key](spark, SF001))
    assert "CartesianProduct" not in text
    if key not in NESTED_LOOP_OK:
        assert "BroadcastNestedLoopJoin" not in text


def _gold_scans_pruned(text):
    scans = [blk for blk in text.split("\n\n") if blk.lstrip().startswith("(") and "Scan parquet" in blk and "transactions_enriched" in blk]
    assert scans
    for blk in scans:
        assert "PartitionFilters: [" in blk and "year" in blk
        assert "PushedFilters: [" in blk and "txn_date" in blk
        schema = blk.split("ReadSchema:")[1]
        assert "brand" not in schema and "onboarded_date" not in schema


def test_gold_scans_are_pruned(spark):
    from liftwise.operators import matching, metrics, trends
    from liftwise.plans.causal import CausalRun
    from liftwise.plans.context import context

    ctx = context(spark, SF001)
    _gold_scans_pruned(plan_text(metrics.query_metric(ctx.gold, "revenue", "1999-01-01", "1999-12-31", "region")))
    _gold_scans_pruned(plan_text(matching.match_vectors(ctx.gold, ctx.windows)))
    run = CausalRun(ctx.gold, ctx.windows, ctx.treated, 10)
    _gold_scans_pruned(plan_text(trends.weekly_revenue_members(ctx.gold, ctx.windows, run.members)))


def test_top_k_is_partial_then_final(spark):
    from liftwise.operators import matching
    from liftwise.plans.context import context

    ctx = context(spark, SF001)
    vecs = matching.normalize_vectors(matching.match_vectors(ctx.gold, ctx.windows)).select(
        "intervention_id", "merchant_id", "vec"
    )
    t, c = matching.split_cohorts(vecs, ctx.treated)
    text = plan_text(matching.rank_candidates(matching.candidate_pairs(t, c, 10), 10))
    assert text.count("WindowGroupLimit") >= 2
    assert "MapInPandas" in text


def test_sql_metric_prunes_by_year(spark):
    text = plan_text(queries()["tvf_query_metric"](spark, SF001))
    scans = [blk for blk in text.split("\n\n") if blk.lstrip().startswith("(") and "Scan parquet" in blk and "transactions_enriched" in blk]
    assert scans
    for blk in scans:
        assert "PartitionFilters: [" in blk and "year" in blk.split("PartitionFilters: [")[1].split("]")[0]
        assert "region" not in blk.split("ReadSchema:")[1]
