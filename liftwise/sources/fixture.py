"""The reference's three source tables, derived from the driver's TPC-H-style parquet.

merchants      <- supplier x nation x region
transactions   <- lineitem grouped by supplier and ship date
interventions  <- fixed metadata rows + cohorts chosen from supplier keys

The same mapping exists as DuckDB CTEs in `liftwise.plans.oracles`.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from liftwise import config
from liftwise.functions.columns import merchant_code
from liftwise.session import default_parallelism

# Fixed values of the fixture mapping (must equal the oracle's CTEs).
LOCATION_TYPES = ("urban", "suburban", "highway", "mall", "campus")
BRANDS = ("BrandA", "BrandB", "BrandC", "BrandD")
SMALL_BELOW = 2500
MID_BELOW = 6500
ONBOARD_EPOCH = "1995-01-01"

# Interventions: (id, name, cohort rule s_suppkey % 10 == r, start, pre days, post days, true effect)
INTERVENTIONS = (
    ("INT_001", "mobile_order_pilot", 3, dt.date(1999, 6, 7), 90, 60, 0.05),
    ("INT_002", "loyalty_app_launch", 7, dt.date(2000, 3, 16), 90, 60, 0.0),
)

INTERVENTION_SCHEMA = T.StructType(
    [
        T.StructField("intervention_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("cohort_mod", T.IntegerType()),
        T.StructField("start_date", T.DateType()),
        T.StructField("pre_window_days", T.LongType()),
        T.StructField("post_window_days", T.LongType()),
        T.StructField("true_effect", T.DoubleType()),
    ]
)


@dataclass(frozen=True)
class Sources:
    merchants: DataFrame
    transactions: DataFrame
    interventions: DataFrame
    cohorts: DataFrame


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    # nation (25 rows) and region (5 rows) have a fixed size in this schema.
    nation = F.broadcast(_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"))
    region = F.broadcast(_table(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    loc_idx = F.floor(F.col("s_nationkey") / 5).cast("int")
    brand_idx = ((F.col("s_suppkey") + F.floor(F.col("s_suppkey") / 10)) % 4).cast("int")
    location = F.element_at(F.array(*[F.lit(v) for v in LOCATION_TYPES]), loc_idx + 1)
    brand = F.element_at(F.array(*[F.lit(v) for v in BRANDS]), brand_idx + 1)
    return (
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        .join(region, F.col("n_regionkey") == region.r_regionkey)
        .select(
            merchant_code(F.col("s_suppkey")).alias("merchant_id"),
            location.alias("location_type"),
            F.lower("r_name").alias("region"),
            F.when(F.col("s_acctbal") < SMALL_BELOW, "small")
            .when(F.col("s_acctbal") < MID_BELOW, "mid")
            .otherwise("large")
            .alias("size_band"),
            brand.alias("brand"),
            F.date_sub(
                F.lit(ONBOARD_EPOCH).cast("date"),
                (F.lit(31) + (F.col("s_suppkey") * 37) % 690).cast("int"),
            ).alias("onboarded_date"),
        )
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per supplier per ship day: exact cents revenue and distinct orders."""
    li = _table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_orderkey", "l_extendedprice", F.col("l_shipdate").cast("date").alias("txn_date")
    )
    # As many tasks as the rows ask for, whatever the session's number of shuffle partitions.
    n_tasks = max(default_parallelism(spark), -(-li.count() // config.SOURCE_ROWS_PER_TASK))
    return (
        li.repartition(n_tasks, "l_suppkey", "txn_date")
        .groupBy("l_suppkey", "txn_date")
        .agg(
            # exact cents as a long sum (same value as a DECIMAL(18,2) sum cast to double)
            (F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")) / F.lit(100.0)).alias("amount"),
            F.count_distinct("l_orderkey").cast("int").alias("txn_count"),
        )
        .select(merchant_code(F.col("l_suppkey")).alias("merchant_id"), "txn_date", "amount", "txn_count")
    )


def intervention_metadata(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(INTERVENTIONS), INTERVENTION_SCHEMA)


def cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(intervention_id, merchant_id), a row per member: cohorts of any size."""
    meta = intervention_metadata(spark).select("intervention_id", "cohort_mod")
    supplier = _table(spark, sf_dir, "supplier").select("s_suppkey")
    return supplier.join(F.broadcast(meta), (F.col("s_suppkey") % 10) == F.col("cohort_mod")).select(
        "intervention_id", merchant_code(F.col("s_suppkey")).alias("merchant_id")
    )


def interventions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw interventions: one row each, with the cohort as a sorted array of merchant ids, as
    the source delivers it. The engine reads `cohorts`."""
    meta = intervention_metadata(spark)
    cohorts_ = cohorts(spark, sf_dir).groupBy("intervention_id").agg(
        F.array_sort(F.collect_list("merchant_id")).alias("treated_merchant_ids")
    )
    return meta.join(cohorts_, "intervention_id", "left").select(
        "intervention_id",
        "name",
        F.coalesce("treated_merchant_ids", F.array().cast("array<string>")).alias(
            "treated_merchant_ids"
        ),
        "start_date",
        "pre_window_days",
        "post_window_days",
        "true_effect",
    )


def promotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interventions derived from the tables, one per part: named after it, beginning on the
    first day it was shipped, with a window after it as long as its size in weeks."""
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    first = _table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.min("l_shipdate").cast("date").alias("start_date"))
    digits = F.col("p_partkey").cast("string")
    code = F.concat(F.lit("PRM_"), F.when(F.length(digits) < 7, F.lpad(digits, 7, "0")).otherwise(digits))
    return part.join(first, "p_partkey").select(
        code.alias("intervention_id"),
        F.concat_ws("_", F.regexp_replace("p_name", " ", "_"), "p_type", F.col("p_partkey") % 100).alias("name"),
        "start_date",
        F.lit(90).cast("long").alias("pre_window_days"),
        (F.col("p_size") * 7).cast("long").alias("post_window_days"),
    )


def lookup_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query_id, query_text): names of parts, quoted or cut short, and words of conversations."""
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    name, third = F.col("p_name"), F.col("p_partkey") % 3
    text = (
        F.when(third == 0, F.concat(F.lit("'"), F.upper(name), F.lit("' "), "p_type"))
        .when(third == 1, F.concat(F.substring_index(name, " ", 1), F.lit(" 100% "), F.col("p_partkey") % 100))
        .otherwise(F.substring(name, 2, 4))
    )
    turns = _table(spark, sf_dir, "conversations")
    word = F.regexp_extract(F.col("text"), "[A-Za-z]+", 0)
    of_turns = turns.select((-1 - F.col("conv_id") * 100 - F.col("turn")).cast("long").alias("query_id"), word.alias("query_text"))
    return part.select(F.col("p_partkey").cast("long").alias("query_id"), text.alias("query_text")).unionAll(of_turns)


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(intervention_id, decision, decided_at): a decision of each user turn, on one intervention
    by the conversation's number and in words by the text's length."""
    turns = _table(spark, sf_dir, "conversations").where("role = 'user'")
    odd, n = F.col("conv_id") % 2 == 1, F.length("text")
    return turns.select(
        F.when(odd, "INT_001").otherwise("INT_002").alias("intervention_id"),
        F.when(odd == (n % 10 != 0), " Yes").otherwise("not now").alias("decision"),
        (F.col("conv_id") * 100 + F.col("turn")).cast("long").alias("decided_at"),
    )


def load(spark: SparkSession, sf_dir: str) -> Sources:
    return Sources(
        merchants=merchants(spark, sf_dir),
        transactions=transactions(spark, sf_dir),
        interventions=interventions(spark, sf_dir),
        cohorts=cohorts(spark, sf_dir),
    )
