"""Sources and sinks: parquet scan with schema check, idempotent overwrite, the
column-restricted interventions view, and JSON records."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftwise import config


def read_parquet(spark: SparkSession, path: str, required: Iterable[str] = ()) -> DataFrame:
    """Scan parquet (schema from the files) and fail fast if a required column is missing."""
    df = spark.read.parquet(path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{path}: missing columns {missing}")
    return df


def overwrite(
    df: DataFrame,
    path: str,
    fmt: str = config.TABLE_FORMAT,
    partition_by: Iterable[str] = (),
) -> None:
    """Idempotent full replace of a table's files, schema included."""
    writer = df.write.mode("overwrite").format(fmt).option("overwriteSchema", "true")
    cols = list(partition_by)
    if cols:
        writer = writer.partitionBy(*cols)
    writer.save(path)


def agent_view(interventions: DataFrame) -> DataFrame:
    """Explicit column list (never `*`), so the oracle column cannot surface."""
    return interventions.select(*config.AGENT_VIEW_COLUMNS)


def register_agent_view(spark: SparkSession, interventions: DataFrame, name: str) -> None:
    """Only the restricted view gets a name; the full table has none."""
    agent_view(interventions).createOrReplaceTempView(name)


def as_json_records(df: DataFrame) -> DataFrame:
    """One JSON object per row (the records a client downloads)."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("record"))
