"""The SQL comparison of a cohort with all merchants."""

from __future__ import annotations

import datetime as dt

import numpy as np
from conftest import make_interventions

from liftwise.functions import sql_functions
from liftwise.operators import matching
from liftwise.plans.warehouse import Warehouse
from liftwise.session import scratch_path


def test_sql_comparison_ranks_only_what_the_cuts_leave(spark):
    """All controls of a cohort by SQL, from vectors with gaps, against the kernel; ranked are
    pairs within the cut of the first chunks."""
    r = np.random.default_rng(4)
    w = Warehouse(spark, "wh_cuts", scratch_path(spark, "cuts"), buckets=2)
    start = dt.date(2023, 1, 2)
    ids = [f"M{k:03d}" for k in range(150)]
    merchants = spark.createDataFrame([(m, "mall", "west", "small", "BrandA", "2020-01-01") for m in ids], "merchant_id string, location_type string, region string, size_band string, brand string, onboarded_date string")
    days = [(m, str(start + dt.timedelta(days=7 * k)), f"{100 * (1 + r.random()):.2f}", "1") for m in ids for k in range(52) if r.random() < 0.8]
    tx = spark.createDataFrame(days, "merchant_id string, txn_date string, amount string, txn_count string")
    w.refresh(merchants, tx, make_interventions(spark, [("A", ids[:9], start + dt.timedelta(days=364), 20)]))
    try:
        sql_functions.publish(w, 1)
        for n in (3, 12, 200):
            got = sorted(tuple(x) for x in w.call(f"build_control_group('A', {n})").collect())
            want = matching.build_control_group(w.run(n).matches).drop("intervention_id").collect()
            assert got == sorted(tuple(x) for x in want) and len(got) == 9 * min(n, 141)
        assert "residual <= cut" in sql_functions.ALL_MATCHES and "zip_with" not in sql_functions.ALL_MATCHES
    finally:
        spark.sql("DROP SCHEMA wh_cuts CASCADE")
