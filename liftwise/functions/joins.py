"""Join helpers: broadcast only behind a counted size bound, shuffle join beyond it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast when `df` has at most `max_rows` rows, else leave the choice
    to the planner (sort-merge or shuffled hash join; AQE may still convert it once
    the real shuffle size is known).

    Only call this on small, cheap inputs (dimension tables, intervention metadata,
    checkpointed results): the check runs a count.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
