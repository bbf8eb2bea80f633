"""Settings shared by the pipeline. Values here are defaults; every operator takes
them as keyword arguments as well."""

from __future__ import annotations

# Table format for persisted layers. Delta is not on this classpath; parquet keeps
# the same overwrite-with-schema semantics through saveAsTable / write.mode("overwrite").
TABLE_FORMAT = "parquet"

# Matching window: [start - 364, start - 1], hard-wired in the method (52 whole weeks
# before a Monday start).
MATCH_WINDOW_DAYS = 364

# Nearest controls per treated unit when the caller gives none (0 also means default).
DEFAULT_N_MATCHES = 10

# Columns of the denormalised fact, in order.
GOLD_COLUMNS = (
    "merchant_id",
    "txn_date",
    "amount",
    "txn_count",
    "year",
    "month",
    "day_of_week",
    "is_weekend",
    "location_type",
    "region",
    "size_band",
    "brand",
    "onboarded_date",
)

MERCHANT_DIMENSIONS = ("location_type", "region", "size_band", "brand")
METRICS = ("revenue", "transaction_count", "avg_basket", "active_merchants")

# Columns the agent-facing view of interventions exposes; `true_effect` is withheld.
AGENT_VIEW_COLUMNS = (
    "intervention_id",
    "name",
    "treated_merchant_ids",
    "start_date",
    "pre_window_days",
    "post_window_days",
)

# Size bounds behind every explicit broadcast (rows, counted before the hint).
MAX_BROADCAST_DIMENSION_ROWS = 2_000_000
MAX_BROADCAST_INTERVENTION_ROWS = 200_000
# (intervention x week) rows: ~60 bytes each, so 2M rows is ~120 MB.
MAX_BROADCAST_WINDOW_WEEK_ROWS = 2_000_000

# Catalog tables: gold rows in a bucket of merchants, over all months (a bucket is written, and
# summed by weeks, in one task: some 600 MB for so many), and chunks of the merchants among which
# SQL spreads a comparison with all of them.
BUCKET_ROWS = 1_000_000
SQL_CHUNKS = 64
SQL_CUT_CHUNKS = 4  # of them, whose pairs give the cuts for all

# Rows of the source fact that one task aggregates to daily transactions.
SOURCE_ROWS_PER_TASK = 1_000_000

# Matching kernel blocking: treated vectors per block, control vectors per chunk, and
# the byte budget under which all treated vectors are broadcast instead of shuffled.
TREATED_BLOCK_ROWS = 2048
CONTROL_CHUNK_ROWS = 2048
TREATED_BROADCAST_BYTES = 256 * 1024 * 1024
