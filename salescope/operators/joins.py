"""Join helpers: broadcast only behind a checked size bound."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def has_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    Reads at most ``max_rows + 1`` rows, so the check stays cheap even when
    the answer is no.
    """
    return df.limit(max_rows + 1).count() <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Mark ``df`` for broadcast only when its row count is proven small.

    Beyond the bound the frame is returned unmarked, and the join falls back
    to whatever the planner picks (sort-merge, or a runtime broadcast by AQE
    when the measured size is under ``spark.sql.autoBroadcastJoinThreshold``).
    """
    return F.broadcast(df) if has_at_most(df, max_rows) else df
