"""Panel preparation: dense spine, calendar seasonality, known-lift injection and
weighted cohort sampling. All are row-wise Column expressions or one join with a
small table; randomness comes from a hash of the key, so results do not depend on
partitioning or task retries."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from liftwise import config
from liftwise.functions.columns import finite, iso_weekday, money_avg
from liftwise.functions.joins import broadcast_if_small


def panel_spine(entities: DataFrame, facts: DataFrame, start, end) -> DataFrame:
    """Dense (merchant_id, txn_date) for every entity and every day in [start, end];
    missing days get amount 0 and txn_count 0 and `observed = false`. Facts in the range
    whose merchant is not among the entities stay, on their own days.

    Each entity row generates its own days (`sequence`), then one equi-join on
    (merchant_id, txn_date) brings in the facts.
    """
    days = entities.select(
        "merchant_id",
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("txn_date"),
    )
    f = facts.where(F.col("txn_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    f = f.select("merchant_id", "txn_date", "amount", "txn_count", F.lit(True).alias("observed"))
    return days.join(f, ["merchant_id", "txn_date"], "full_outer").select(
        "merchant_id",
        "txn_date",
        F.coalesce("amount", F.lit(0.0)).alias("amount"),
        F.coalesce("txn_count", F.lit(0)).alias("txn_count"),
        F.coalesce("observed", F.lit(False)).alias("observed"),
    )


# Fixed values (calendar seasonality by location type). Other types have no weekday factor
# and the wave of OTHER_WAVE; rows without a type have no factors.
OTHER_WAVE = (0.03, 0.3)
WEEKDAY_FACTORS = {  # location_type: (weekday, weekend)
    "urban": (1.12, 0.70),
    "campus": (1.12, 0.70),
    "suburban": (0.98, 1.05),
    "mall": (0.96, 1.10),
    "highway": (0.94, 1.15),
}
ANNUAL_WAVES = {  # location_type: (amplitude, phase) of 1 + a * sin(2 pi (doy - phase))
    "urban": (0.04, 0.5),
    "campus": (0.04, 0.5),
    "highway": (0.08, 0.25),
    "suburban": (0.03, 0.3),
    "mall": (0.03, 0.3),
}
DECEMBER_BUMP = 1.10
DECEMBER_BUMP_TYPES = ("mall", "urban")


def _by_location(loc: Column, table: dict, pick, other) -> Column:
    expr = None
    for name, value in table.items():
        expr = (F.when(loc == name, pick(value)) if expr is None else expr.when(loc == name, pick(value)))
    return expr.otherwise(other)


def seasonality_factors(gold: DataFrame) -> DataFrame:
    """Per row: weekday factor, annual factor (with the December bump) and the
    de-seasonalised amount = amount / (weekday * annual)."""
    loc = F.col("location_type")
    weekend = F.col("day_of_week") >= 6
    weekday = F.when(loc.isNull(), F.lit(1.0)).otherwise(
        _by_location(loc, WEEKDAY_FACTORS, lambda v: F.when(weekend, F.lit(v[1])).otherwise(F.lit(v[0])), F.lit(1.0))
    )
    doy = (F.dayofyear("txn_date") - 1) / F.lit(365.0)

    def curve(v):
        return F.lit(1.0) + F.lit(v[0]) * F.sin(F.lit(2 * math.pi) * (doy - F.lit(v[1])))

    wave = F.when(loc.isNull(), F.lit(1.0)).otherwise(_by_location(loc, ANNUAL_WAVES, curve, curve(OTHER_WAVE)))
    annual = F.when(loc.isin(*DECEMBER_BUMP_TYPES) & (F.month("txn_date") == 12), wave * DECEMBER_BUMP).otherwise(wave)
    return gold.select(
        "merchant_id",
        "txn_date",
        weekday.alias("weekday_factor"),
        annual.alias("annual_factor"),
        (F.col("amount") / (weekday * annual)).alias("deseasonalized_amount"),
    )


def inject_lift(panel: DataFrame, interventions: DataFrame, effect_col: str = "true_effect") -> DataFrame:
    """Multiply amount and txn_count of treated rows on/after each start by (1 + effect),
    rounding amount to cents (exact decimal, half up) and counts to >= 1.

    A merchant in several cohorts gets the product of the effects that have started: the
    schedule is a row per merchant and span of days with its product, so a panel row meets one
    of them at most. It is broadcast if its counted size allows.
    """
    cohort = interventions.select(
        F.explode("treated_merchant_ids").alias("merchant_id"), "start_date", F.col(effect_col).alias("effect")
    ).where(F.col("merchant_id").isNotNull())
    starts = cohort.groupBy("merchant_id", "start_date").agg(F.product(F.lit(1.0) + F.col("effect")).alias("step"))
    per_merchant = Window.partitionBy("merchant_id").orderBy("start_date")
    schedule = starts.select(
        F.col("merchant_id").alias("_merchant"),
        F.col("start_date").alias("_from"),
        F.lead("start_date").over(per_merchant).alias("_until"),
        F.product("step").over(per_merchant).alias("_m"),
    )
    schedule = broadcast_if_small(schedule, config.MAX_BROADCAST_DIMENSION_ROWS)
    day = F.col("txn_date")
    started = (day >= F.col("_from")) & (F.col("_until").isNull() | (day < F.col("_until")))
    joined = panel.join(schedule, (F.col("merchant_id") == F.col("_merchant")) & started, "left")
    new_amount = F.round(F.col("amount").cast("decimal(27,11)") * F.col("_m").cast("decimal(10,8)"), 2).cast("double")
    new_count = F.greatest(F.lit(1), F.round(F.col("txn_count") * F.col("_m")).cast("int"))
    values = {"amount": new_amount, "txn_count": new_count}
    return joined.select(
        *[F.when(F.col("_m").isNotNull(), values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in panel.columns]
    )


#: Terms of the seasonal model besides the constant: the weekend, the year's wave, December.
TERMS = ("weekend", "sin_year", "cos_year", "december")


def _solved(names: list[str]) -> list[tuple[str, Column]]:
    """Gaussian elimination of the symmetric system in the columns s_i_j (i <= j) with the right
    side s_i_y, as steps of (column, expression) that give x_i: a few columns per row, no loop
    over rows. A pivot of 0 (a term that does not vary) leaves its coefficient 0."""
    n = len(names)

    def at(i: int, j: int | str) -> str:
        return f"s_{i}_{j}" if j == "y" or i <= j else f"s_{j}_{i}"

    a: dict = {(i, j): F.col(at(i, j)) for i in range(n) for j in [*range(n), "y"]}
    steps = []
    for p in range(n):
        for i in range(p + 1, n):
            ratio = F.when(F.abs(F.col(at(p, p)) if p == 0 else F.col(f"e{p}_{p}_{p}")) > 1e-9, a[i, p] / a[p, p]).otherwise(F.lit(0.0))
            for j in [*range(p + 1, n), "y"]:
                name = f"e{p + 1}_{i}_{j}"
                steps.append((name, a[i, j] - ratio * a[p, j]))
        for i in range(p + 1, n):
            for j in [*range(p + 1, n), "y"]:
                a[i, j] = F.col(f"e{p + 1}_{i}_{j}")
    for i in reversed(range(n)):
        rest = a[i, "y"]
        for j in range(i + 1, n):
            rest = rest - a[i, j] * F.col(f"x_{j}")
        steps.append((f"x_{i}", F.when(F.abs(a[i, i]) > 1e-9, rest / a[i, i]).otherwise(F.lit(0.0))))
    return steps


def seasonality_estimates(gold: DataFrame) -> DataFrame:
    """(location_type, n_rows, constant, weekend, sin_year, cos_year, december): least squares of
    amounts relative to their merchant's mean, per location type.

    The normal equations are sums per location type (one aggregation after the merchants'
    means); solving them is arithmetic on the columns of that one row. Rows without a type or
    a finite amount, and merchants whose mean is 0, take no part.
    """
    rows = gold.select("merchant_id", "txn_date", "location_type", finite(F.col("amount")).alias("amount"))
    rows = rows.where("amount IS NOT NULL AND location_type IS NOT NULL")
    means = rows.groupBy("merchant_id").agg(money_avg(F.col("amount")).alias("mean")).where("mean <> 0")
    angle = F.lit(2 * math.pi / 365.0) * (F.dayofyear("txn_date") - 1)
    terms = {
        "weekend": (iso_weekday(F.col("txn_date")) >= 6).cast("double"),
        "sin_year": F.sin(angle),
        "cos_year": F.cos(angle),
        "december": (F.month("txn_date") == 12).cast("double"),
    }
    x = rows.join(means, "merchant_id").select("location_type", F.lit(1.0).alias("constant"), *[v.alias(k) for k, v in terms.items()], (F.col("amount") / F.col("mean")).alias("y"))
    names = ["constant", *TERMS]
    sums = [F.sum(F.col(a) * F.col(b)).alias(f"s_{i}_{j}") for i, a in enumerate(names) for j, b in enumerate(names) if i <= j]
    sums += [F.sum(F.col(a) * F.col("y")).alias(f"s_{i}_y") for i, a in enumerate(names)]
    system = x.groupBy("location_type").agg(F.count(F.lit(1)).alias("n_rows"), *sums)
    for name, value in _solved(names):
        system = system.withColumn(name, value)
    return system.select("location_type", "n_rows", *[F.col(f"x_{i}").alias(n) for i, n in enumerate(names)])


# Selection weights of the pilot cohort.
LOCATION_WEIGHTS = {"urban": 3.0, "campus": 2.0, "suburban": 2.0, "mall": 1.0, "highway": 0.5}
SIZE_WEIGHTS = {"small": 0.5, "mid": 2.0, "large": 3.0}


def _lookup(col: str, table: dict) -> Column:
    expr = None
    for k, v in table.items():
        expr = F.when(F.col(col) == k, F.lit(v)) if expr is None else expr.when(F.col(col) == k, F.lit(v))
    return expr


def sample_cohort(merchants: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """Weighted sample without replacement (Efraimidis-Spirakis): key = -ln(u) / w with
    u uniform from a hash of (seed, merchant_id); the n smallest keys win. The top-n
    is the feature, so it is a limit (per-partition top-n, then merged)."""
    weight = _lookup("location_type", LOCATION_WEIGHTS) * _lookup("size_band", SIZE_WEIGHTS)
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("merchant_id")).cast("binary")), 1, 13), 16, 10)
    u = (bits.cast("double") + 0.5) / float(1 << 52)
    return (
        merchants.select("merchant_id", weight.alias("weight"))
        .where(F.col("weight") > 0)
        .withColumn("sample_key", -F.log(u) / F.col("weight"))
        .orderBy("sample_key", "merchant_id")
        .limit(n)
    )
