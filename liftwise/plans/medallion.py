"""Bronze -> silver -> gold refresh as DataFrame plans."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from liftwise import config
from liftwise.functions.columns import iso_weekday
from liftwise.functions.joins import broadcast_if_small
from liftwise.operators.weekly import weekly_panel
from liftwise.sources import tables


# Names and types of the typed layer (fixed values).
MERCHANT_SCHEMA = (
    "merchant_id string, location_type string, region string, size_band string, brand string, onboarded_date date"
)
TRANSACTION_SCHEMA = "merchant_id string, txn_date date, amount double, txn_count int"


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """The columns of a schema, in its order and types; a value that is none of its type fails."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in T.StructType.fromDDL(ddl)])


def silver_merchants(bronze_merchants: DataFrame) -> DataFrame:
    return conform(bronze_merchants, MERCHANT_SCHEMA)


def with_calendar(transactions: DataFrame) -> DataFrame:
    weekday = iso_weekday(F.col("txn_date"))
    calendar = {"year": F.year("txn_date"), "month": F.month("txn_date"), "day_of_week": weekday, "is_weekend": weekday >= 6}
    return transactions.withColumns(calendar)


def silver_transactions(bronze_transactions: DataFrame) -> DataFrame:
    return with_calendar(conform(bronze_transactions, TRANSACTION_SCHEMA))


def gold_enriched(silver_tx: DataFrame, silver_m: DataFrame) -> DataFrame:
    """Left join fact -> merchant attributes, fixed column order. The dimension is
    broadcast only when its row count is under the bound."""
    dim = broadcast_if_small(silver_m, config.MAX_BROADCAST_DIMENSION_ROWS)
    return silver_tx.join(dim, "merchant_id", "left").select(*config.GOLD_COLUMNS)


@dataclass(frozen=True)
class Layers:
    merchants: DataFrame
    transactions: DataFrame
    gold: DataFrame
    weekly: DataFrame


def build(bronze_merchants: DataFrame, bronze_transactions: DataFrame) -> Layers:
    m = silver_merchants(bronze_merchants)
    t = silver_transactions(bronze_transactions)
    gold = gold_enriched(t, m)
    return Layers(m, t, gold, weekly_panel(gold))


def refresh(
    bronze_merchants: DataFrame,
    bronze_transactions: DataFrame,
    root: str,
    fmt: str = config.TABLE_FORMAT,
) -> Layers:
    """Write silver, gold and the weekly sums of gold under `root` and return DataFrames that
    read them back. Gold is partitioned by year/month so date-bounded queries prune files."""
    spark = bronze_merchants.sparkSession
    layers = build(bronze_merchants, bronze_transactions)
    tables.overwrite(layers.merchants, f"{root}/silver/merchants", fmt)
    tables.overwrite(layers.transactions, f"{root}/silver/transactions", fmt)
    m = spark.read.format(fmt).load(f"{root}/silver/merchants")
    t = spark.read.format(fmt).load(f"{root}/silver/transactions")
    # Range-partition on (year, month, merchant) before the partitioned write: each task
    # writes a contiguous key range, so files ~ tasks + months (not tasks x months), and
    # rows of a merchant sit together in row groups. No explicit count: AQE sizes it.
    gold_rows = gold_enriched(t, m).repartitionByRange("year", "month", "merchant_id")
    tables.overwrite(gold_rows, f"{root}/gold/transactions_enriched", fmt, ("year", "month"))
    gold = spark.read.format(fmt).load(f"{root}/gold/transactions_enriched").select(
        *config.GOLD_COLUMNS
    )
    tables.overwrite(weekly_panel(gold), f"{root}/gold/transactions_weekly", fmt, ("year",))
    weekly = spark.read.format(fmt).load(f"{root}/gold/transactions_weekly")
    return Layers(m, t, gold, weekly)
