"""Queries over mechanisms beside the main ingest: VARIANT payloads, many windows in one read, stateful streams.
Their inputs are derived from the driver tables by Spark, and each has SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.window import read_windows
from tidemark.plans.feeds import table
from tidemark.plans.landing_from_tables import NEWS_BLOCK
from tidemark.session import ensure_utc, scratch_path
from tidemark.sources.variant import shred_news_variant
from tidemark.streaming.stateful import first_seen, hourly_last, latest_updates, run_updates

FILES = 6            # landing files of the streaming queries, one per trigger
STATE_PARTITIONS = 8


def variant_envelopes(documents: DataFrame) -> DataFrame:
    """News payloads of every document, with URL missing, null or given and PUBLISHED_ON missing, a number, numeric text
    or null, by the document's number."""
    title = F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("TITLE")))
    seconds = (F.lit(1704067200) + F.col("doc_id") * 60).cast("string")
    url = F.when(F.col("doc_id") % 3 == 0, "").when(F.col("doc_id") % 3 == 1, ',"URL":null') \
        .otherwise(F.concat(F.lit(',"URL":"https://n/'), "doc_id", F.lit('"')))
    published = F.when(F.col("doc_id") % 4 == 0, "").when(F.col("doc_id") % 4 == 1, F.concat(F.lit(',"PUBLISHED_ON":'), seconds)) \
        .when(F.col("doc_id") % 4 == 2, F.concat(F.lit(',"PUBLISHED_ON":"'), seconds, F.lit('"'))).otherwise(',"PUBLISHED_ON":null')
    article = F.concat(F.expr("substring({0}, 1, length({0}) - 1)".format("__title")), url, published, F.lit("}"))
    docs = documents.withColumn("__title", title).select(
        F.col("source").alias("asset"), (F.col("doc_id") / NEWS_BLOCK).cast("long").alias("batch_id"),
        F.struct(F.col("doc_id").alias("i"), article.alias("a")).alias("d"))
    # at most NEWS_BLOCK articles a payload, whatever the skew of sources
    blocks = docs.groupBy("asset", "batch_id").agg(F.sort_array(F.collect_list("d")).alias("ds"))
    body = F.concat(F.lit('{"Data":['), F.concat_ws(",", F.transform("ds", lambda d: d["a"])), F.lit("]}"))
    return blocks.select("asset", F.timestamp_seconds(F.lit(1704067200) + F.col("batch_id") * 1200).alias("ingest_ts"),
                         "batch_id", body.alias("payload"))


def q_variant_null_vs_missing(spark: SparkSession, sf: str) -> DataFrame:
    ensure_utc(spark)
    rows = shred_news_variant(variant_envelopes(table(spark, sf, "documents")))
    return rows.select("asset", "batch_id", "seq", "url", "url_state", "published_kind",
                       F.col("published_at").cast("timestamp_ntz").alias("published_at"))


def q_read_many_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Around every purchase the views of four hours, around every signup all events of one hour."""
    ensure_utc(spark)
    events = table(spark, sf, "events")
    around = lambda kind, asset, minutes: events.where(F.col("event_type") == kind).select(
        F.col("event_id").alias("request_id"), F.lit(asset).cast("string").alias("asset"),
        F.expr(f"ts - interval {minutes} minutes").alias("start"), F.expr(f"ts + interval {minutes} minutes").alias("end"))
    requests = around("purchase", "view", 120).unionByName(around("signup", None, 30))
    return read_windows(events.select("event_id", "event_type", "ts"), requests, "ts", "event_type", totals={
        "n": ("count", None), "first_id": ("min", "event_id"), "last_id": ("max", "event_id")})


def _in_two_runs(spark: SparkSession, sf: str, name: str, make) -> str:
    """Events landed in ``FILES`` files of mixed arrival, half of them before a first run of the stream that ``make``
    builds, the rest before a second run from the same checkpoint."""
    ensure_utc(spark)
    root = scratch_path(spark, name)
    events = table(spark, sf, "events").select("event_id", "event_type", "ts", "value", "user_id")
    for half in (0, 1):
        part = events.where((F.col("event_id") % FILES >= FILES // 2) == F.lit(half == 0))  # the later ids of each block first
        part.repartition(FILES // 2, "event_id").write.mode("append").parquet(f"{root}/landing")
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", "1").parquet(f"{root}/landing")
        run_updates(make(stream), f"{root}/out", f"{root}/checkpoint", STATE_PARTITIONS)
    return root


def q_stream_stateful_hourly(spark: SparkSession, sf: str) -> DataFrame:
    def make(stream):
        rows = stream.select(F.col("event_type").alias("asset"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("timestamp"),
                             F.col("value").alias("close"), F.col("event_id").alias("seq"))
        return hourly_last(rows, ["asset", "timestamp"], ["seq"], ["close"])

    root = _in_two_runs(spark, sf, "stateful-hourly", make)
    return latest_updates(spark, f"{root}/out", ["asset", "timestamp"])


def q_stream_first_seen_keys(spark: SparkSession, sf: str) -> DataFrame:
    root = _in_two_runs(spark, sf, "first-seen", lambda stream: first_seen(
        stream.select(F.col("event_type").alias("asset"), F.col("user_id").cast("string").alias("url")), ["asset", "url"]))
    return spark.read.parquet(f"{root}/out").select("asset", "url")


MECHANISM_QUERIES = {
    "variant_null_vs_missing": q_variant_null_vs_missing,
    "read_many_windows": q_read_many_windows,
    "stream_stateful_hourly": q_stream_stateful_hourly,
    "stream_first_seen_keys": q_stream_first_seen_keys,
}

MECHANISM_SQL = {
    "variant_null_vs_missing": f"""
with d as (select source asset, doc_id, text, doc_id // {NEWS_BLOCK} batch_id,
                  row_number() over (partition by source, doc_id // {NEWS_BLOCK} order by doc_id) - 1 seq from documents)
select asset, batch_id, seq,
       case doc_id % 3 when 0 then '' when 2 then 'https://n/' || doc_id end url,
       case doc_id % 3 when 0 then 'missing' when 1 then 'null' else 'value' end url_state,
       case doc_id % 4 when 0 then 'missing' when 1 then 'number' when 2 then 'text' else 'null' end published_kind,
       case doc_id % 4 when 0 then timestamp '1970-01-01 00:00:00' when 1 then make_timestamp((1704067200 + doc_id * 60) * 1000000)
            else make_timestamp((1704067200 + batch_id * 1200) * 1000000) end published_at
from d where text <> ''""",
    "read_many_windows": """
select request_id, count(*) n, min(e.event_id) first_id, max(e.event_id) last_id
from (select event_id request_id, ts from events where event_type = 'purchase') r
join (select * from events where event_type = 'view') e on e.ts between r.ts - interval 120 minutes and r.ts + interval 120 minutes
group by 1
union all
select request_id, count(*), min(e.event_id), max(e.event_id)
from (select event_id request_id, ts from events where event_type = 'signup') r
join events e on e.ts between r.ts - interval 30 minutes and r.ts + interval 30 minutes group by 1""",
    "stream_stateful_hourly": """
select event_type asset, date_trunc('hour', ts) "timestamp", arg_max(value, event_id) "close", max(event_id) seq
from events group by 1, 2""",
    "stream_first_seen_keys": "select distinct event_type asset, cast(user_id as varchar) url from events",
}
