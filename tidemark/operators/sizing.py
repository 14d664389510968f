"""Size checks that guard every broadcast.

A side is broadcast only when a bounded probe proves it small: ``limit(n + 1).count()``
stops scanning once ``n + 1`` rows are seen, so the check itself is bounded work. Beyond the
bound the caller gets the plain frame and Spark/AQE plan a shuffle join instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a key-only side we are willing to ship to every executor.
DEFAULT_BROADCAST_ROWS = 2_000_000


def row_count_at_most(df: DataFrame, n: int) -> bool:
    return df.limit(n + 1).count() <= n


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` if it has at most ``max_rows`` rows, else ``df`` unchanged."""
    return F.broadcast(df) if row_count_at_most(df, max_rows) else df
