"""Post-period lift: mean weekly lift, two-sided 95 % t interval, significance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Two-sided 95 % critical t by degrees of freedom 1..60, then 1.960
# for df > 60 (stored as df 61). Three decimals, as published in standard tables.
T_CRITICAL = (
    (1, 12.706), (2, 4.303), (3, 3.182), (4, 2.776), (5, 2.571), (6, 2.447), (7, 2.365),
    (8, 2.306), (9, 2.262), (10, 2.228), (11, 2.201), (12, 2.179), (13, 2.160), (14, 2.145),
    (15, 2.131), (16, 2.120), (17, 2.110), (18, 2.101), (19, 2.093), (20, 2.086), (21, 2.080),
    (22, 2.074), (23, 2.069), (24, 2.064), (25, 2.060), (26, 2.056), (27, 2.052), (28, 2.048),
    (29, 2.045), (30, 2.042), (31, 2.040), (32, 2.037), (33, 2.035), (34, 2.032), (35, 2.030),
    (36, 2.028), (37, 2.026), (38, 2.024), (39, 2.023), (40, 2.021), (41, 2.020), (42, 2.018),
    (43, 2.017), (44, 2.015), (45, 2.014), (46, 2.013), (47, 2.012), (48, 2.011), (49, 2.010),
    (50, 2.009), (51, 2.008), (52, 2.007), (53, 2.006), (54, 2.005), (55, 2.004), (56, 2.003),
    (57, 2.002), (58, 2.002), (59, 2.001), (60, 2.000), (61, 1.960),
)
MAX_DF = 61


def t_table(spark: SparkSession) -> DataFrame:
    schema = T.StructType([T.StructField("df", T.IntegerType()), T.StructField("t_val", T.DoubleType())])
    return spark.createDataFrame(list(T_CRITICAL), schema)


def post_weeks(series: DataFrame, first_n_weeks: int | None = None, week_start: int | None = None, week_end: int | None = None) -> DataFrame:
    """Post-period weeks kept for the estimate. `first_n_weeks` (counting weeks that
    have data) takes precedence; otherwise the inclusive week-number range applies."""
    post = series.where(F.col("period") == "post").select("intervention_id", "week_number", "lift_pct")
    if first_n_weeks is not None:
        rn = F.row_number().over(Window.partitionBy("intervention_id").orderBy("week_number"))
        return post.withColumn("rn", rn).where(F.col("rn") <= first_n_weeks).drop("rn")
    if week_start is not None:
        post = post.where(F.col("week_number") >= week_start)
    if week_end is not None:
        post = post.where(F.col("week_number") <= week_end)
    return post


def lift_stats(weeks: DataFrame) -> DataFrame:
    """mean / sample sd of lift and n = weeks counted (NULL lifts count in n only),
    with the critical t for df = n - 1 (capped at the 1.960 row). n <= 1 gives no row."""
    stats = weeks.groupBy("intervention_id").agg(
        F.avg("lift_pct").alias("mean_lift"),
        F.stddev_samp("lift_pct").alias("std_lift"),
        F.count(F.lit(1)).cast("int").alias("n_weeks"),
    )
    tt = F.broadcast(t_table(weeks.sparkSession))
    return stats.join(tt, F.least(F.col("n_weeks") - 1, F.lit(MAX_DF)) == tt.df).drop("df")


def estimate(stats: DataFrame) -> DataFrame:
    half = F.col("t_val") * F.col("std_lift") / F.sqrt(F.col("n_weeks"))
    lo, hi = F.col("mean_lift") - half, F.col("mean_lift") + half
    return stats.select(
        "intervention_id",
        F.round("mean_lift", 4).alias("lift_pct"),
        F.round(lo, 4).alias("ci_lower"),
        F.round(hi, 4).alias("ci_upper"),
        "n_weeks",
        F.when((lo > 0) | (hi < 0), F.lit(True)).otherwise(F.lit(False)).alias("significant"),
    )


def estimate_lift(series: DataFrame, first_n_weeks: int | None = None, week_start: int | None = None, week_end: int | None = None) -> DataFrame:
    return estimate(lift_stats(post_weeks(series, first_n_weeks, week_start, week_end)))
