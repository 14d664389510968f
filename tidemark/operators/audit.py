"""Batch statistics and quality audits — each one a single aggregate pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def batch_stats_by_asset(df: DataFrame, asset: str = "asset", ts: str = "timestamp") -> DataFrame:
    """Rows and first/last timestamp per asset."""
    return df.groupBy(F.col(asset).alias("asset")).agg(
        F.count(F.lit(1)).alias("n"), F.min(ts).alias("first_hour"), F.max(ts).alias("last_hour"))


def batch_stats_total(df: DataFrame, asset: str = "asset") -> DataFrame:
    """Rows and distinct assets of a combined batch."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(asset).alias("assets"))


def latest_by_asset(df: DataFrame, asset: str = "asset", ts: str = "published_at") -> DataFrame:
    return df.groupBy(F.col(asset).alias("asset")).agg(F.max(ts).alias("latest"))


def dedup_audit(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in and rows surviving a dedup on ``keys`` (removed = rows_in - rows_kept)."""
    return df.agg(F.count(F.lit(1)).alias("rows_in"),
                  F.count_distinct(F.struct(*keys)).alias("rows_kept"))


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (must be empty on a stored keyed table)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def not_null_counts(df: DataFrame, cols: Sequence[str], by: str | None = None,
                    names: dict[str, str] | None = None) -> DataFrame:
    """NULL count per column (optionally per group) in one pass."""
    names = names or {}
    aggs = [(F.count(F.lit(1)) - F.count(c)).alias(names.get(c, f"null_{c}")) for c in cols]
    return (df.groupBy(by) if by else df).agg(*aggs)


def top_n_per_group(df: DataFrame, group: str, order: Sequence, n: int) -> DataFrame:
    """Newest-first top ``n`` rows per group.

    ``row_number() <= n`` lets Spark plan a WindowGroupLimit on both sides of the shuffle, so
    at most ``n`` rows per group leave each map task even when one group is huge.
    """
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")
