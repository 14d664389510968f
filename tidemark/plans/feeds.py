"""The driver tables re-read as the engine's feeds.

``events``    -> price feed (asset = event_type, raw time = ts, close = value,
                 seq = event_id), market feed (one snapshot per event) and a keyed news feed
                 (url = user_id, headline = props); two arrival batches:
                 event_id % 3 = 0 -> batch 1, else batch 0 (every row is in one of them).
``documents`` -> news text (asset = source, headline = text).
``embeddings``-> chart arrays.
Everything is a projection of the given tables, so the work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FEED_SOURCE = "feed"
FEED_ASSETS = ["click", "view", "purchase"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _batch(two_batches: bool):
    if two_batches:
        return F.when(F.col("event_id") % 3 == 0, F.lit(1)).otherwise(F.lit(0)).cast("long")
    return F.lit(0).cast("long")


def price_feed(events: DataFrame, two_batches: bool = False) -> DataFrame:
    return events.select(
        F.col("event_type").alias("asset"), F.col("ts").alias("timestamp"),
        F.col("value").alias("close"), F.lit(None).cast("double").alias("market_cap"),
        F.lit(None).cast("double").alias("volume"), F.lit(FEED_SOURCE).alias("source"),
        _batch(two_batches).alias("batch_id"), F.col("event_id").alias("seq"))


def market_feed(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("ts").alias("timestamp"), F.col("value").alias("btc_dominance"),
        F.lit(None).cast("double").alias("total_market_cap_usd"),
        F.lit(None).cast("double").alias("total_volume_usd"), F.lit(FEED_SOURCE).alias("source"),
        F.lit(0).cast("long").alias("batch_id"), F.col("event_id").alias("seq"))


def news_feed(events: DataFrame, two_batches: bool = False) -> DataFrame:
    return events.select(
        F.col("event_type").alias("asset"), F.col("props").alias("headline"),
        F.col("user_id").cast("string").alias("url"), F.col("ts").alias("published_at"),
        F.lit(0).cast("long").alias("votes_positive"), F.lit(0).cast("long").alias("votes_negative"),
        F.lit(FEED_SOURCE).alias("source"),
        _batch(two_batches).alias("batch_id"), F.col("event_id").alias("seq"))
