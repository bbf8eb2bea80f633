"""Every registered query against its DuckDB oracle (driver-style comparison) at sf 0.001."""

from __future__ import annotations

import os
import sys

import pytest
from conftest import SF001

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from oracle_check import digest, duck  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402

KEYS = sorted(queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = queries()[key](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    sql = oracle_sql().get(key)
    if sql is None:
        assert rows and len(set(df.columns)) == len(df.columns)
        return
    res = con.execute(sql)
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    assert len(rows) == len(o_rows)
    assert digest(df.columns, rows)[0] == digest(o_cols, o_rows)[0]


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "lift_pct" in df.columns
