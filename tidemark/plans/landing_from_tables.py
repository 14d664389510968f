"""Landing envelopes derived (by Spark) from the driver tables, for end-to-end runs.

``events``    -> price-chart payloads, one per (asset, block of 256 consecutive event ids),
                 points in event order; caps = value x 1000, volumes one point short (ragged).
                 In 'error' payloads, points whose event id is a multiple of 97 get a NULL value
                 (the payload is quarantined as invalid), and 'signup' payloads of every 13th
                 block are cut short (-> unparseable). Nothing is filtered out.
              -> global-market payloads, one per hour (btc = max value, cap = min value,
                 volume = event count: order-independent, exactly reproducible values).
``documents`` -> news payloads, one per (source, block of 100 doc ids); title = the whole text,
                 url = digest of the text (copies share it), published = doc_id minutes.
Payload size is bounded by the block size, never by a key's total row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHART_BLOCK = 256
NEWS_BLOCK = 100   # <= 100 articles per payload whatever the skew of sources


def price_envelopes(events: DataFrame) -> DataFrame:
    ms = (F.unix_micros(F.col("ts").cast("timestamp")) / 1000).cast("long")
    value = F.when((F.col("event_type") == "error") & (F.col("event_id") % 97 == 0),
                   F.lit(None).cast("double")).otherwise(F.col("value"))
    pts = events.select(
        F.col("event_type").alias("asset"), (F.col("event_id") / CHART_BLOCK).cast("long").alias("block"),
        F.struct(F.col("event_id").alias("i"), ms.cast("double").alias("t"), value.alias("v")).alias("pt"),
        F.col("ts"))
    blocks = pts.groupBy("asset", "block").agg(F.sort_array(F.collect_list("pt")).alias("pts"),
                                               F.max("ts").alias("last_ts"))
    pair = lambda f: F.transform("pts", lambda p: F.array(p["t"], f(p)))
    prices = pair(lambda p: p["v"])
    caps = pair(lambda p: p["v"] * 1000)
    vols = F.slice(pair(lambda p: p["v"] * 10), F.lit(1), F.greatest(F.size("pts") - 1, F.lit(1)))
    body = F.to_json(F.struct(prices.alias("prices"), caps.alias("market_caps"), vols.alias("total_volumes")))
    cut = (F.col("asset") == "signup") & (F.col("block") % 13 == 0)
    payload = F.when(cut, F.substring(body, 1, 20)).otherwise(body)
    return blocks.select("asset", F.col("last_ts").cast("timestamp").alias("ingest_ts"),
                         F.col("block").alias("batch_id"), payload.alias("payload"))


def market_envelopes(events: DataFrame) -> DataFrame:
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    g = events.groupBy(hour.alias("hour")).agg(
        F.max("value").alias("btc"), F.min("value").alias("cap"), F.count(F.lit(1)).alias("vol"),
        F.max("ts").alias("last_ts"))
    m = lambda k, v: F.create_map(F.lit(k), v.cast("double"))
    body = F.to_json(F.struct(F.struct(m("btc", F.col("btc")).alias("market_cap_percentage"),
                                       m("usd", F.col("cap")).alias("total_market_cap"),
                                       m("usd", F.col("vol")).alias("total_volume")).alias("data")))
    return g.select(F.lit(None).cast("string").alias("asset"),
                    F.col("last_ts").cast("timestamp").alias("ingest_ts"),
                    (F.unix_seconds(F.col("hour")) / 3600).cast("long").alias("batch_id"),
                    body.alias("payload"))


def news_envelopes(documents: DataFrame) -> DataFrame:
    art = F.struct(F.col("text").alias("TITLE"),
                   F.concat(F.lit("https://news.example/"), F.sha2("text", 256)).alias("URL"),
                   (F.lit(1704067200) + F.col("doc_id") * 60).alias("PUBLISHED_ON"))
    docs = documents.select(F.col("source").alias("asset"),
                            (F.col("doc_id") / NEWS_BLOCK).cast("long").alias("block"),
                            F.struct(F.col("doc_id").alias("i"), art.alias("a")).alias("d"))
    blocks = docs.groupBy("asset", "block").agg(F.sort_array(F.collect_list("d")).alias("ds"))
    body = F.to_json(F.struct(F.transform("ds", lambda d: d["a"]).alias("Data")))
    return blocks.select("asset", F.timestamp_seconds(F.lit(1704067200) + F.col("block") * 1200)
                         .alias("ingest_ts"), F.col("block").alias("batch_id"), body.alias("payload"))
