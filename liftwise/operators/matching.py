"""Nearest-control matching on mean-normalised weekly revenue (k-NN with replacement).

Semantics (per intervention):
  * weekly revenue over the match window, per merchant and Monday week;
  * each merchant's weeks divided by its mean over the weeks it has rows in;
  * residual(t, c) = sum over weeks both have of |t_w - c_w|; pairs with no common
    week have no residual; a NULL residual (mean 0) is not a candidate;
  * for each treated unit, the n smallest residuals among merchants not treated in
    this intervention, ties broken by control id; score = round(1 / (1 + r), 4).

Plan:
  1. weekly sums of the panel (one scan for all windows, see `weekly`; or the weekly
     table itself), read per distinct match window and collected into a fixed-width
     vector per (window, merchant): slot i = week i of the window; bounded by 53.
  2. normalisation is array arithmetic on that row (no join back to the means).
  3. treated vectors are cut into blocks per intervention and the window's merchants
     into chunks by a hash of the merchant id, once per window (interventions sharing
     a window share the chunks; each one's own cohort is masked in the kernel); each
     (treated block, control chunk) pair is one row, and a NumPy kernel turns it into
     the k best controls of every treated unit in the block. Treated blocks are
     broadcast when their counted size is under a byte budget, otherwise replicated
     across chunks by an equi-join on (window, chunk), so no join key concentrates an
     intervention in one task.
  4. a final row_number per treated unit over the partial top-k lists (Spark plans
     it as a partial + final WindowGroupLimit).
  No (treated x control x week) rows exist at any point. Within a block pair, sums over
  groups of weeks bound residuals from below, and pairs beyond the current k-th are
  passed over (exact; `pruning_counts` reports how many).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from liftwise import config
from liftwise.functions.columns import safe_div, similarity
from liftwise.functions.joins import broadcast_if_small
from liftwise.operators.weekly import weeks_in_windows
from liftwise.session import cut_lineage, default_parallelism


def n_slots(match_window_days: int = config.MATCH_WINDOW_DAYS) -> int:
    """Monday weeks a window of that many days can touch (52 or 53 for 364)."""
    return (match_window_days + 6) // 7 + 1


def weekly_cents(panel: DataFrame, windows: DataFrame, bounds=None) -> DataFrame:
    """(pre_start, merchant_id, slot, base_week, cents): exact weekly revenue per distinct
    match window (keyed by its first day), one row per week a merchant has amounts in.
    `panel` is daily, or weekly already."""
    shared = windows.select("pre_start", "pre_end")
    if bounds is not None and bounds.n_interventions <= config.MAX_BROADCAST_INTERVENTION_ROWS:
        # Metadata under a proven row bound: de-duplicate in one partition, no shuffle.
        shared = shared.coalesce(1)
    shared = shared.distinct()
    rows = weeks_in_windows(panel, shared, "pre_start", "pre_end", bounds=bounds, key="pre_start")
    slot = (F.datediff(F.col("week_start"), F.col("base_week")) / 7).cast("int")
    return rows.select("pre_start", "merchant_id", slot.alias("slot"), "base_week", "cents")


def window_vectors(
    panel: DataFrame, windows: DataFrame, match_window_days: int = config.MATCH_WINDOW_DAYS, bounds=None
) -> DataFrame:
    """(pre_start, merchant_id, base_week, weekly_cents): weekly revenue over each distinct
    match window as array<double> of exact cents aligned to the week slots, NULL where
    the merchant has no amount that week. A vector depends on the window only, not on the
    cohort, so interventions that share a window share one scan and one aggregation.
    Each group holds at most `n_slots` weeks."""
    if bounds is None:
        span = windows.agg(F.max(F.datediff("pre_end", "pre_start"))).first()[0]
    else:
        span = bounds.match_span_days - 1
    width = n_slots(max(match_window_days, (span or 0) + 1))  # as wide as the widest window
    weekly = weekly_cents(panel, windows, bounds)
    entries = F.map_from_entries(F.collect_list(F.struct("slot", "cents")))
    return (
        weekly.groupBy("pre_start", "merchant_id")
        .agg(F.min("base_week").alias("base_week"), entries.alias("by_slot"))
        .select(
            "pre_start",
            "merchant_id",
            "base_week",
            F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.try_element_at("by_slot", i)).alias(
                "weekly_cents"
            ),
        )
    )


def attach_interventions(vectors: DataFrame, windows: DataFrame, bounds=None) -> DataFrame:
    """Key window vectors by intervention (join on the window's first day; the
    intervention table is broadcast under its row bound)."""
    ivs = windows.select("intervention_id", "pre_start")
    if bounds is None:
        ivs = broadcast_if_small(ivs, config.MAX_BROADCAST_INTERVENTION_ROWS)
    elif bounds.n_interventions <= config.MAX_BROADCAST_INTERVENTION_ROWS:
        ivs = F.broadcast(ivs)
    return vectors.join(ivs, "pre_start").drop("pre_start")


def match_vectors(
    panel: DataFrame, windows: DataFrame, match_window_days: int = config.MATCH_WINDOW_DAYS, bounds=None
) -> DataFrame:
    """(intervention_id, merchant_id, base_week, weekly_cents) for every intervention."""
    return attach_interventions(window_vectors(panel, windows, match_window_days, bounds), windows, bounds)


def normalize_vectors(vectors: DataFrame) -> DataFrame:
    """Adds `weekly` (revenue as double), mean_revenue (exact, over weeks present) and
    `vec` = weekly / NULLIF(mean, 0)."""
    present = F.filter("weekly_cents", lambda x: x.isNotNull())
    total = F.aggregate(present, F.lit(0.0), lambda acc, x: acc + x)
    return (
        vectors.withColumn("mean_revenue", safe_div(total, F.size(present) * F.lit(100.0)))
        .withColumn("weekly", F.transform("weekly_cents", lambda x: x / F.lit(100.0)))
        .withColumn("vec", F.transform("weekly", lambda x: safe_div(x, F.col("mean_revenue"))))
    )


def vectors_as_rows(vectors: DataFrame, value: str, alias: str) -> DataFrame:
    """Long form (intervention_id, merchant_id, week_start, <alias>) of an array column."""
    return (
        vectors.select("intervention_id", "merchant_id", "base_week", F.posexplode(value).alias("slot", alias))
        .where(F.col(alias).isNotNull())
        .select(
            "intervention_id",
            "merchant_id",
            F.date_add("base_week", F.col("slot") * 7).alias("week_start"),
            alias,
        )
    )


def split_cohorts(normalized: DataFrame, treated: DataFrame, n_treated: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Treated vectors and control vectors (merchants not treated in that intervention).
    The cohort table is broadcast under the row bound (`n_treated` if known, else counted)."""
    cohort = treated.select("intervention_id", "merchant_id")
    if n_treated is None:
        cohort = broadcast_if_small(cohort, config.MAX_BROADCAST_DIMENSION_ROWS)
    elif n_treated <= config.MAX_BROADCAST_DIMENSION_ROWS:
        cohort = F.broadcast(cohort)
    keys = ["intervention_id", "merchant_id"]
    return normalized.join(cohort, keys, "left_semi"), normalized.join(cohort, keys, "left_anti")


CANDIDATE_SCHEMA = T.StructType(
    [
        T.StructField("intervention_id", T.StringType()),
        T.StructField("treated_merchant_id", T.StringType()),
        T.StructField("control_merchant_id", T.StringType()),
        T.StructField("total_residual", T.DoubleType()),
        T.StructField("common_weeks", T.IntegerType()),
    ]
)


def _stack(vectors) -> np.ndarray:
    return np.vstack([np.asarray(v, dtype=np.float64) for v in vectors])


TILE_CELLS = 1 << 17  # 1 MB of float64 per working buffer (measured best of 64 KB..4 MB)


GROUP_WEEKS = 4  # weeks whose sums bound a pair's residual from below
DENSE_SHARE = 0.2  # of pairs left by the bounds: beyond it a tile is computed whole


def _group_sums(values: np.ndarray, ok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums over groups of weeks, and which groups a vector has whole."""
    pad = -values.shape[1] % GROUP_WEEKS
    shape = (len(values), -1, GROUP_WEEKS)
    whole = np.pad(ok, ((0, 0), (0, pad))).reshape(shape)
    return np.pad(values, ((0, 0), (0, pad))).reshape(shape).sum(axis=2), whole.all(axis=2)


def _lower_bounds(t_sums, t_whole, c_sums, c_whole) -> np.ndarray:
    """A lower bound of every pair's residual: the differences of the sums over those groups of
    weeks that both vectors have whole (less a margin for rounding)."""
    bound = np.zeros((len(t_sums), len(c_sums)))
    for g in range(t_sums.shape[1]):
        a, b = t_whole[:, g], c_whole[:, g]
        if a.any() and b.any():
            d = np.abs(t_sums[:, g, None] - c_sums[None, :, g])
            d[~a, :] = 0.0
            d[:, ~b] = 0.0
            bound += d
    return bound * (1 - 1e-9) - 1e-12


def _residuals(t0, t_ok, c0, c_ok, ti, ci) -> np.ndarray:
    """Residuals of the given pairs, weeks in order."""
    out = np.zeros(len(ti))
    for w in range(t0.shape[1]):
        out += np.abs(t0[ti, w] - c0[ci, w]) * (t_ok[ti, w] & c_ok[ci, w])
    return out


def block_top_k(t_ids, t_vecs, c_ids, c_vecs, k: int, exclude=None, min_overlap: int = 1, counts: dict | None = None):
    """Exact partial top-k of one (treated block, control chunk) pair.

    Returns (treated index, control index, residual, common weeks) for every control
    whose residual is within the k smallest of its treated row, ties at the cut by
    control id as in the final ranking. Controls whose id is in `exclude`
    (merchants treated in this intervention) are not candidates, nor are those with fewer
    than `min_overlap` weeks in common.

    Pairs whose lower bound is beyond the k-th of the residuals computed first (those of the
    smallest bounds) are passed over; where the bounds leave too many pairs, the rest of the
    block is computed whole. `counts` gets the numbers of pairs and of pairs computed.
    """
    tv, cv = _stack(t_vecs), _stack(c_vecs)
    t_ok, c_ok = ~np.isnan(tv), ~np.isnan(cv)
    t0, c0 = np.where(t_ok, tv, 0.0), np.where(c_ok, cv, 0.0)
    t_sums, t_whole = _group_sums(t0, t_ok)
    c_sums, c_whole = _group_sums(c0, c_ok)
    c_weeks = c_ok.astype(np.float32).T
    first = 2 * k  # pairs of a treated row whose residuals give the cut
    prune = cv.shape[0] > 8 * k
    computed = 0
    usable = np.ones(cv.shape[0], bool)
    if exclude is not None and len(exclude):
        usable = ~np.isin(np.asarray(c_ids, dtype=object), np.asarray(exclude, dtype=object))
    # Treated rows in tiles so the working buffers stay in cache and no array holds all pairs;
    # weeks in order within a tile, so every pair is summed in the same order.
    tile = max(1, TILE_CELLS // max(1, cv.shape[0]))
    kept = []
    for r0 in range(0, tv.shape[0], tile):
        r1 = min(r0 + tile, tv.shape[0])
        dense = True
        if prune:
            bound = _lower_bounds(t_sums[r0:r1], t_whole[r0:r1], c_sums, c_whole)
            bound[:, ~usable] = np.inf
            near = np.argpartition(bound, first - 1, axis=1)[:, :first]
            rows = np.repeat(np.arange(r0, r1), first)
            d = _residuals(t0, t_ok, c0, c_ok, rows, near.ravel())
            overlap = (t_ok[rows] & c_ok[near.ravel()]).sum(axis=1)
            valid = (overlap >= min_overlap) & usable[near.ravel()]
            cut = np.sort(np.where(valid, d, np.inf).reshape(near.shape), axis=1)[:, k - 1 : k]
            ti, ci = np.nonzero(bound <= cut)
            computed += len(rows)
            dense = len(ti) > DENSE_SHARE * bound.size
        if dense:
            prune = False  # these vectors are too noisy for the bounds
            acc = np.zeros((r1 - r0, cv.shape[0]))
            computed += acc.size
            buf = np.empty_like(acc)
            for w in range(tv.shape[1]):
                a, b = t_ok[r0:r1, w], c_ok[:, w]
                if not a.any() or not b.any():
                    continue
                np.subtract(t0[r0:r1, w, None], c0[None, :, w], out=buf)
                np.abs(buf, out=buf)
                if not a.all():
                    buf[~a, :] = 0.0
                if not b.all():
                    buf[:, ~b] = 0.0
                acc += buf
        else:
            acc = np.full((r1 - r0, cv.shape[0]), np.inf)
            acc[ti, ci] = _residuals(t0, t_ok, c0, c_ok, ti + r0, ci)
            computed += len(ti)
        # Weeks both have, for every pair of the tile (exact: counts are small integers).
        common = (t_ok[r0:r1].astype(np.float32) @ c_weeks).astype(np.int32)
        common[:, ~usable] = 0
        common[np.isinf(acc) | (common < min_overlap)] = 0  # passed over (never among the k), or too few
        keep = common > 0
        if cv.shape[0] > k:
            masked = np.where(keep, acc, np.inf)
            keep &= masked <= np.partition(masked, k - 1, axis=1)[:, k - 1 : k]
        ti, ci = np.nonzero(keep)
        kept.append((ti + r0, ci, acc[ti, ci], common[ti, ci]))
    if counts is not None:
        n_pairs = tv.shape[0] * cv.shape[0]
        counts["pairs"] = counts.get("pairs", 0) + n_pairs
        counts["computed"] = counts.get("computed", 0) + min(computed, n_pairs)
    ti, ci, dist, common = (np.concatenate(x) for x in zip(*kept, strict=True))
    if len(ti) > k * tv.shape[0] or (np.bincount(ti, minlength=1) > k).any():
        # ties at the cut: the smaller control ids, so at most k leave the block per treated
        place = np.empty(cv.shape[0], np.int64)
        place[np.argsort(np.asarray(c_ids, dtype=object), kind="stable")] = np.arange(cv.shape[0])
        order = np.lexsort((place[ci], dist, ti))
        ti, ci, dist, common = ti[order], ci[order], dist[order], common[order]
        nth = np.arange(len(ti)) - np.searchsorted(ti, ti)
        ti, ci, dist, common = ti[nth < k], ci[nth < k], dist[nth < k], common[nth < k]
    return ti, ci, dist, common


def _counts_kernel(k: int):
    def run(batches):
        for pdf in batches:
            rows = []
            for iid, t_ids, t_vecs, c_ids, c_vecs, ex_ids in zip(
                pdf["intervention_id"], pdf["t_ids"], pdf["t_vecs"], pdf["c_ids"], pdf["c_vecs"], pdf["ex_ids"]
            ):
                n: dict = {"pairs": 0, "computed": 0}
                if len(t_ids) and len(c_ids):
                    block_top_k(t_ids, t_vecs, c_ids, c_vecs, k, ex_ids, counts=n)
                rows.append((iid, n["pairs"], n["computed"]))
            yield pd.DataFrame(rows, columns=["intervention_id", "n_pairs", "n_computed"])

    return run


def _kernel(k: int, min_overlap: int = 1):
    def run(batches):
        for pdf in batches:
            parts = []
            for iid, t_ids, t_vecs, c_ids, c_vecs, ex_ids in zip(
                pdf["intervention_id"], pdf["t_ids"], pdf["t_vecs"], pdf["c_ids"], pdf["c_vecs"], pdf["ex_ids"]
            ):
                if len(t_ids) == 0 or len(c_ids) == 0:
                    continue
                ti, ci, dist, common = block_top_k(t_ids, t_vecs, c_ids, c_vecs, k, ex_ids, min_overlap)
                parts.append(
                    pd.DataFrame(
                        {
                            "intervention_id": iid,
                            "treated_merchant_id": np.asarray(t_ids, dtype=object)[ti],
                            "control_merchant_id": np.asarray(c_ids, dtype=object)[ci],
                            "total_residual": dist,
                            "common_weeks": common.astype(np.int32),
                        }
                    )
                )
            if parts:
                yield pd.concat(parts, ignore_index=True)

    return run


def _blocks(vecs: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    items = F.collect_list(F.struct(F.col("merchant_id").alias("id"), F.col("vec").alias("v")))
    return (
        vecs.groupBy(*keys)
        .agg(items.alias("items"))
        .select(*keys, F.col("items.id").alias(f"{prefix}_ids"), F.col("items.v").alias(f"{prefix}_vecs"))
    )


def _hash_block(n_col: str):
    return F.pmod(F.xxhash64("merchant_id"), F.col(n_col)).cast("int")


def pruning_counts(treated_vecs: DataFrame, pool_vecs: DataFrame, k: int, **options) -> DataFrame:
    """(intervention_id, n_pairs, n_computed): how many treated x control pairs there are, and of
    how many the residual is computed (the others are beyond their lower bounds)."""
    pairs = candidate_pairs(treated_vecs, pool_vecs, k, kernel=False, **options)
    done = pairs.mapInPandas(_counts_kernel(k), "intervention_id string, n_pairs long, n_computed long")
    return done.groupBy("intervention_id").agg(F.sum("n_pairs").alias("n_pairs"), F.sum("n_computed").alias("n_computed"))


def candidate_pairs(
    treated_vecs: DataFrame,
    pool_vecs: DataFrame,
    k: int,
    treated_block_rows: int = config.TREATED_BLOCK_ROWS,
    control_chunk_rows: int = config.CONTROL_CHUNK_ROWS,
    broadcast_bytes: int = config.TREATED_BROADCAST_BYTES,
    pool_key: str = "intervention_id",
    exclusions: DataFrame | None = None,
    max_exclusions: int | None = None,
    kernel: bool = True,
    min_overlap_weeks: int = 1,
) -> DataFrame:
    """Partial top-k candidates per treated unit (see module docstring, step 3).

    `treated_vecs` has (intervention_id, merchant_id, vec, <pool_key>); `pool_vecs` has
    (<pool_key>, merchant_id, vec), the candidate controls of every intervention in the
    pool. With the default pool key each intervention has its own pool (controls
    already exclude its cohort). With a shared pool (e.g. the match window) the pool's
    chunks are built once for all interventions on it, and `exclusions`
    (intervention_id, merchant_id) lists the ids each intervention may not use as
    controls; they travel with the block pair (hashed into the same chunks) and are
    masked by the kernel, so the result stays exact. Without `kernel`, the block pairs.
    """
    spark = treated_vecs.sparkSession
    tv = treated_vecs.withColumn("_pool", F.col(pool_key))
    pv = pool_vecs.withColumn("_pool", F.col(pool_key))
    t_stats = tv.groupBy("intervention_id", "_pool").agg(
        F.count(F.lit(1)).alias("n_t"), F.max(F.size("vec")).alias("width")
    )
    p_stats = pv.groupBy("_pool").agg(F.count(F.lit(1)).alias("n_c"))
    stats = t_stats.join(p_stats, "_pool")
    # One row per intervention: metadata-sized, summarised in one small job.
    summary = stats.agg(
        F.count(F.lit(1)).alias("n_iv"),
        F.countDistinct("_pool").alias("n_pools"),
        F.sum("n_t").alias("n_t"),
        F.sum(F.ceil(F.col("n_t") / treated_block_rows)).alias("n_tb"),
        F.sum(F.ceil(F.col("n_c") / control_chunk_rows)).alias("n_cb"),  # at least the chunks of all pools
        F.max("width").alias("width"),
    ).first()
    n_iv = summary["n_iv"] or 0
    if n_iv == 0:
        if kernel:
            return spark.createDataFrame([], CANDIDATE_SCHEMA)
        empty = "intervention_id string, t_ids array<string>, t_vecs array<array<double>>, c_ids array<string>, c_vecs array<array<double>>, ex_ids array<string>"
        return spark.createDataFrame([], empty)
    small = n_iv <= config.MAX_BROADCAST_INTERVENTION_ROWS  # pools <= interventions
    n_pools, n_tb = int(summary["n_pools"]), int(summary["n_tb"])
    tasks_per_pool = max(1, -(-2 * default_parallelism(spark) // n_pools))
    # A task's Arrow batch holds at most so many block pairs. A chunk meets its treated blocks
    # in groups of that size: it is dealt out once per group, before the pairs are formed.
    row_bytes = (treated_block_rows + control_chunk_rows) * (int(summary["width"] or 1) * 8 + 64)
    most = max(1, KERNEL_BATCH_BYTES // row_bytes)
    n_groups = max(1, -(-n_tb // most))
    n_rows = (int(summary["n_cb"]) + n_pools * tasks_per_pool) * n_groups
    n_tasks = max(min(n_rows, 2 * default_parallelism(spark)), -(-n_rows * min(n_tb, most) // most))
    iv_stats = stats.select(
        "intervention_id", "_pool", F.ceil(F.col("n_t") / treated_block_rows).cast("int").alias("n_tb")
    )
    pool_stats = p_stats.select(  # already one row per pool: no de-duplication needed
        "_pool",
        F.greatest(F.ceil(F.col("n_c") / control_chunk_rows), F.least(F.col("n_c"), F.lit(tasks_per_pool)))
        .cast("int")
        .alias("n_cb"),
    )
    if small:
        iv_stats, pool_stats = F.broadcast(iv_stats), F.broadcast(pool_stats)
    t_blocks = _blocks(
        tv.join(iv_stats, ["intervention_id", "_pool"]).withColumn("tb", _hash_block("n_tb")),
        ["intervention_id", "_pool", "tb"],
        "t",
    ).withColumn("_group", F.pmod(F.xxhash64("intervention_id", "tb"), F.lit(n_groups)).cast("int"))
    c_blocks = _blocks(pv.join(pool_stats, "_pool").withColumn("cb", _hash_block("n_cb")), ["_pool", "cb"], "c")
    c_blocks = c_blocks.withColumn("_group", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1)))).repartition(n_tasks)

    treated_bytes = int(summary["n_t"]) * (int(summary["width"] or 0) * 8 + 64)
    if treated_bytes <= broadcast_bytes:
        pairs = c_blocks.join(F.broadcast(t_blocks), ["_pool", "_group"])
    else:
        replicated = t_blocks.join(pool_stats, "_pool").withColumn(
            "cb", F.explode(F.sequence(F.lit(0), F.col("n_cb") - 1))
        )
        pairs = c_blocks.join(replicated.drop("n_cb"), ["_pool", "_group", "cb"])
    if exclusions is None:
        pairs = pairs.withColumn("ex_ids", F.array().cast("array<string>"))
    else:
        ex = (
            exclusions.select("intervention_id", "merchant_id")
            .join(iv_stats.select("intervention_id", "_pool"), "intervention_id")
            .join(pool_stats, "_pool")
            .withColumn("cb", _hash_block("n_cb"))
            .groupBy("intervention_id", "cb")
            .agg(F.collect_list("merchant_id").alias("ex_ids"))
        )
        if max_exclusions is None:
            ex = broadcast_if_small(ex, config.MAX_BROADCAST_DIMENSION_ROWS)
        elif max_exclusions <= config.MAX_BROADCAST_DIMENSION_ROWS:
            ex = F.broadcast(ex)
        pairs = pairs.join(ex, ["intervention_id", "cb"], "left").withColumn(
            "ex_ids", F.coalesce("ex_ids", F.array().cast("array<string>"))
        )
    pairs = pairs.select("intervention_id", "t_ids", "t_vecs", "c_ids", "c_vecs", "ex_ids")
    return pairs.mapInPandas(_kernel(k, max(1, min_overlap_weeks)), CANDIDATE_SCHEMA) if kernel else pairs


KERNEL_BATCH_BYTES = 16 * 1024 * 1024  # in Python a multiple of it, in each worker


def rank_candidates(candidates: DataFrame, n_matches: int) -> DataFrame:
    w = Window.partitionBy("intervention_id", "treated_merchant_id").orderBy(
        F.col("total_residual").asc(), F.col("control_merchant_id").asc()
    )
    return (
        candidates.withColumn("match_rank", F.row_number().over(w))
        .where(F.col("match_rank") <= n_matches)
        .withColumn("similarity_score", similarity(F.col("total_residual")))
    )


def resolve_n_matches(n_matches: int | None) -> int:
    n = n_matches or config.DEFAULT_N_MATCHES
    if n < 0:
        raise ValueError("n_matches must be positive")
    return int(n)


def match_controls(
    panel: DataFrame,
    windows: DataFrame,
    treated: DataFrame,
    n_matches: int | None = None,
    match_window_days: int = config.MATCH_WINDOW_DAYS,
    checkpoint: bool = True,
    bounds=None,
    min_overlap_weeks: int = 1,
) -> DataFrame:
    """(intervention_id, treated_merchant_id, control_merchant_id, total_residual,
    common_weeks, match_rank, similarity_score) for every intervention in `windows`. Residuals
    add up the weeks both have, so sparse controls look closer: `min_overlap_weeks` leaves out
    those with fewer weeks in common."""
    k = resolve_n_matches(n_matches)
    shared = normalize_vectors(window_vectors(panel, windows, match_window_days, bounds))
    shared = shared.select("pre_start", "merchant_id", "vec")
    if checkpoint:
        shared = cut_lineage(shared)
    # Treated vectors: the cohort keyed by its window, joined to the shared vectors.
    n_treated = bounds.n_treated if bounds is not None else None
    cohort = treated.select("intervention_id", "merchant_id").join(
        windows.select("intervention_id", "pre_start"), "intervention_id"
    )
    if n_treated is None:
        cohort = broadcast_if_small(cohort, config.MAX_BROADCAST_DIMENSION_ROWS)
    elif n_treated <= config.MAX_BROADCAST_DIMENSION_ROWS:
        cohort = F.broadcast(cohort)
    t_vecs = shared.join(cohort, ["pre_start", "merchant_id"])
    # Controls: every merchant of the window, chunked once per window; each
    # intervention's own cohort is masked in the kernel.
    pairs = candidate_pairs(
        t_vecs, shared, k, pool_key="pre_start", exclusions=treated, max_exclusions=n_treated, min_overlap_weeks=min_overlap_weeks
    )
    return rank_candidates(pairs, k)


def build_control_group(matches: DataFrame) -> DataFrame:
    """The public columns and the intervention id of the batch form, in the order of the SQL form."""
    rows = matches.select("intervention_id", "treated_merchant_id", "control_merchant_id", "similarity_score")
    return rows.orderBy("intervention_id", "treated_merchant_id", F.desc("similarity_score"), "control_merchant_id")
