"""Data-quality gates, each one aggregation job over the whole table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def row_counts(tables: Mapping[str, DataFrame], expected: Mapping[str, int] | None = None) -> DataFrame:
    """(table_name, n_rows, expected_rows, matches_expected): the per-table counts as a
    union of single-row aggregates (one job, each table scanned once)."""
    parts = [
        df.agg(F.count(F.lit(1)).cast("long").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    exp = expected or {}
    spark = out.sparkSession
    schema = T.StructType([T.StructField("table_name", T.StringType()), T.StructField("expected_rows", T.LongType())])
    expectations = spark.createDataFrame([(k, int(v)) for k, v in exp.items()], schema)
    return out.join(F.broadcast(expectations), "table_name", "left").select(
        "table_name",
        "n_rows",
        "expected_rows",
        F.when(F.col("expected_rows").isNull(), F.lit(None).cast("boolean"))
        .otherwise(F.col("n_rows") == F.col("expected_rows"))
        .alias("matches_expected"),
    )


def null_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One row, one count per column of NULLs (a broken left join shows up here)."""
    return df.select([F.count(F.when(F.col(c).isNull(), F.lit(1))).cast("long").alias(c) for c in columns])


def null_counts_long(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(column_name, null_count) rows: the same single scan, unpivoted."""
    cols = list(columns)
    wide = null_counts(df, cols)
    return wide.unpivot([], cols, "column_name", "null_count")


def hidden_columns(view: DataFrame, hidden: Iterable[str]) -> list[str]:
    """Columns that must be absent but are present (empty list = pass)."""
    return [c for c in hidden if c in view.columns]


def assert_hidden(view: DataFrame, hidden: Iterable[str]) -> None:
    leaked = hidden_columns(view, hidden)
    if leaked:
        raise AssertionError(f"columns visible in view: {leaked}")


def schema_rows(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, position, column_name, data_type, nullable) for each table."""
    rows = [
        (name, i, f.name, f.dataType.simpleString(), bool(f.nullable))
        for name, df in tables.items()
        for i, f in enumerate(df.schema.fields)
    ]
    schema = "table_name string, position int, column_name string, data_type string, nullable boolean"
    return spark.createDataFrame(rows, schema)


def sample_rows(df: DataFrame, order_by: list[str], columns: list[str], n: int = 5) -> DataFrame:
    """A deterministic n-row sample (ordered top-n)."""
    return df.orderBy(*order_by).select(*columns).limit(n)
