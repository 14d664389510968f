"""Query catalog: each inventory operator bound to the driver tables, with its SQL oracle.

Every callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame built from this
repo's operators; ``ORACLE_SQL`` holds the equivalent DuckDB SQL over the same tables.
Timestamps in the driver tables are wall-clock UTC (``timestamp_ntz``) and stay so.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.nested import get_or, vote_counts
from tidemark.functions.timefn import (
    epoch_millis_to_ts, epoch_seconds_to_ts, floor_hour, floor_hour_ntz, iso_utc_text, parse_utc,
)
from tidemark.operators import audit
from tidemark.operators.harmonise import (
    allowlist_audit, asset_dim, filter_assets, floor_timestamps, harmonise_market,
    harmonise_news, harmonise_price, lookback, map_symbols, reject_assets, skip_empty_text,
)
from tidemark.operators.merge import (
    first_per_key, first_wins_tagged, last_wins_tagged, latest_per_key,
)
from tidemark.operators.window import window_filter
from tidemark.plans import feeds
from tidemark.plans.feeds import FEED_ASSETS, table
from tidemark.plans.report import critical_gate_frame
from tidemark.session import ensure_utc
from tidemark.sources.shred import zip_by_position

PRICE_KEY = ["asset", "timestamp"]
ARRIVAL = ["batch_id", "seq"]
PROPS_MAP = T.MapType(T.StringType(), T.StringType())


def _events(spark, sf):
    ensure_utc(spark)
    return table(spark, sf, "events")


# --- merges ------------------------------------------------------------------------------

def q_hourly_last_wins(spark, sf):
    h = harmonise_price(feeds.price_feed(_events(spark, sf)), ["click", "view"])
    return latest_per_key(h, PRICE_KEY, ARRIVAL).select("asset", "timestamp", "close")


def _upserted_prices(spark, sf):
    h = harmonise_price(feeds.price_feed(_events(spark, sf), two_batches=True), FEED_ASSETS)
    return last_wins_tagged(h, F.col("batch_id") == 1, PRICE_KEY, ARRIVAL)


def q_upsert_two_batches(spark, sf):
    return _upserted_prices(spark, sf).select("asset", F.col("timestamp").alias("hr"), "close")


def _market_table(spark, sf):
    h = harmonise_market(feeds.market_feed(_events(spark, sf)))
    return latest_per_key(h, ["timestamp"], ARRIVAL)


def q_market_hourly_upsert(spark, sf):
    return _market_table(spark, sf).select(F.col("timestamp").alias("hr"),
                                           F.col("btc_dominance").alias("value"))


def _news_table(spark, sf):
    h = harmonise_news(feeds.news_feed(_events(spark, sf), two_batches=True), FEED_ASSETS)
    return first_wins_tagged(h, F.col("batch_id") == 1, ["asset", "url"], ARRIVAL)


def q_insert_ignore_two_batches(spark, sf):
    return _news_table(spark, sf).select("asset", "url", "seq")


# whole texts are compared by digest and length: the text itself never leaves the scan
TEXT_KEY = ["source", "text_digest", "text_length"]


def _text_keyed(spark, sf):
    return table(spark, sf, "documents").select("source", "doc_id", "n_chars", F.sha2("text", 256).alias("text_digest"),
                                                F.length("text").alias("text_length"))


def q_dedup_keep_first(spark, sf):
    return first_per_key(_text_keyed(spark, sf), TEXT_KEY, ["doc_id"]).select("source", "doc_id", "n_chars")


def q_dedup_audit(spark, sf):
    return audit.dedup_audit(_text_keyed(spark, sf), TEXT_KEY)


# --- shredding / nested access ------------------------------------------------------------

def q_chart_positional_zip(spark, sf):
    emb = table(spark, sf, "embeddings")
    z = zip_by_position(emb, ["vec_id"], F.col("embedding"),
                        {"mc": F.slice(F.col("embedding"), F.lit(1), F.lit(3))}, value_name="v")
    return z.select("vec_id", "pos", "v", "mc")


def q_json_nested_default(spark, sf):
    m = F.from_json(F.col("props"), PROPS_MAP)
    return _events(spark, sf).select("event_id", get_or(m, "k", "0").alias("k"))


def q_vote_counts(spark, sf):
    m = F.from_json(F.col("props"), PROPS_MAP)
    v = vote_counts(m, up_key="UPVOTES", down_key="k")
    return _events(spark, sf).select("event_id", v["votes_positive"].alias("up"),
                                     v["votes_negative"].alias("down"))


def q_news_shred_skip_empty(spark, sf):
    return skip_empty_text(table(spark, sf, "documents"), "text").select("doc_id")


# --- harmonise ---------------------------------------------------------------------------

def q_allowlist_filter(spark, sf):
    ev = _events(spark, sf).withColumnRenamed("event_type", "asset")
    return filter_assets(ev, FEED_ASSETS).select("event_id", "asset")


def q_harmonise_price(spark, sf):
    h = harmonise_price(feeds.price_feed(_events(spark, sf)), FEED_ASSETS)
    return h.select("asset", F.col("timestamp").alias("ts_hour"), "close", "market_cap", "source")


def q_harmonise_market(spark, sf):
    h = harmonise_market(feeds.market_feed(_events(spark, sf)))
    return h.select("timestamp", F.col("btc_dominance").alias("value"), "source")


def q_harmonise_news(spark, sf):
    h = harmonise_news(feeds.news_feed(_events(spark, sf)), FEED_ASSETS)
    return h.select("asset", "timestamp", F.col("seq").alias("event_id"))


def q_allowlist_audit(spark, sf):
    return allowlist_audit(_events(spark, sf), FEED_ASSETS, col="event_type")


SYMBOLS = {"click": "c-1", "view": "v-1", "purchase": "p-1"}


def q_symbol_map_join(spark, sf):
    dim = asset_dim(spark, SYMBOLS)
    return map_symbols(_events(spark, sf), dim, col="event_type") \
        .select("event_id", F.col("vendor_id").alias("coin_id"))


def q_unknown_symbol_reject(spark, sf):
    return reject_assets(_events(spark, sf), asset_dim(spark, SYMBOLS), col="event_type") \
        .select("event_id", "event_type")


# --- windowed reads ----------------------------------------------------------------------

def q_read_price_window(spark, sf):
    w = window_filter(_events(spark, sf), "2024-01-02 00:00:00", "2024-01-03 00:00:00",
                      asset="click", ts_col="ts", asset_col="event_type")
    return w.select("event_id", "event_type", "ts")


def q_read_market_window(spark, sf):
    w = window_filter(_market_table(spark, sf), "2024-01-02 00:00:00", "2024-01-03 00:00:00")
    return w.select(F.col("timestamp").alias("hr"), F.col("btc_dominance").alias("value"))


def q_read_news_window(spark, sf):
    w = window_filter(_news_table(spark, sf), "2024-01-01 00:00:00", "2024-01-03 00:00:00",
                      asset="click")
    return w.select("asset", "url", "seq", F.col("timestamp").alias("hr"))


def q_lookback_days(spark, sf):
    as_of = F.lit("2024-01-30 00:00:00").cast("timestamp_ntz")
    return lookback(_events(spark, sf), "ts", as_of, days=1).select("event_id")


# --- scalar functions --------------------------------------------------------------------

def q_floor_hour(spark, sf):
    return _events(spark, sf).select("event_id", floor_hour_ntz("ts").alias("h"))


def q_epoch_millis_floor(spark, sf):
    ms = F.lit(1704067200000) + F.col("event_id") * 1000
    return _events(spark, sf).select(
        "event_id", floor_hour(epoch_millis_to_ts(ms)).cast("timestamp_ntz").alias("t"))


def q_epoch_seconds_to_utc(spark, sf):
    s = F.lit(1704067200) + F.col("event_id")
    return _events(spark, sf).select("event_id", epoch_seconds_to_ts(s).cast("timestamp_ntz").alias("t"))


def q_parse_text_timestamp(spark, sf):
    sep = F.when(F.col("event_id") % 2 == 0, F.lit(" ")).otherwise(F.lit("T"))
    text = F.concat(F.date_format("ts", "yyyy-MM-dd"), sep, F.lit("05:07:00"))
    return _events(spark, sf).select(
        "event_id", parse_utc(text, strict=False).cast("timestamp_ntz").alias("t"))


def q_iso_utc_text(spark, sf):
    return _events(spark, sf).select("event_id", iso_utc_text(floor_hour_ntz("ts")).alias("s"))


# --- sources, stats, audits --------------------------------------------------------------

def q_union_assets(spark, sf):
    # one scan of the whole landing set, assets selected by membership (no per-asset re-read)
    ev = _events(spark, sf).withColumnRenamed("event_type", "asset")
    return filter_assets(ev, ["click", "view"]).select("event_id")


def _floored_feed(spark, sf):
    return floor_timestamps(feeds.price_feed(_events(spark, sf)), "timestamp")


def q_batch_stats_by_asset(spark, sf):
    return audit.batch_stats_by_asset(_floored_feed(spark, sf))


def q_batch_stats_total(spark, sf):
    return audit.batch_stats_total(feeds.price_feed(_events(spark, sf)))


def q_news_latest_by_asset(spark, sf):
    return audit.latest_by_asset(feeds.news_feed(_events(spark, sf)), ts="published_at")


def q_key_uniqueness_audit(spark, sf):
    v = audit.key_violations(_floored_feed(spark, sf), PRICE_KEY)
    return v.select("asset", F.col("timestamp").alias("hr"), "n")


def q_not_null_audit(spark, sf):
    return audit.not_null_counts(feeds.price_feed(_events(spark, sf)), ["close", "timestamp"],
                                 by="asset", names={"close": "null_close", "timestamp": "null_ts"})


def q_top20_per_asset(spark, sf):
    f = feeds.news_feed(_events(spark, sf))
    top = audit.top_n_per_group(f, "asset", [F.col("published_at").desc(), F.col("seq").desc()], 20)
    return top.select("asset", F.col("seq").alias("event_id"))


def q_critical_gate(spark, sf):
    # per-source status (a source is ok when it delivered rows), then the critical gate
    status = _events(spark, sf).groupBy(F.col("event_type").alias("source")) \
        .agg((F.count(F.lit(1)) > 0).alias("ok"))
    return critical_gate_frame(status, ["click", "view"])


QUERIES = {
    "hourly_last_wins": q_hourly_last_wins,
    "upsert_two_batches": q_upsert_two_batches,
    "market_hourly_upsert": q_market_hourly_upsert,
    "insert_ignore_two_batches": q_insert_ignore_two_batches,
    "dedup_keep_first": q_dedup_keep_first,
    "dedup_audit": q_dedup_audit,
    "chart_positional_zip": q_chart_positional_zip,
    "json_nested_default": q_json_nested_default,
    "vote_counts": q_vote_counts,
    "news_shred_skip_empty": q_news_shred_skip_empty,
    "allowlist_filter": q_allowlist_filter,
    "harmonise_price": q_harmonise_price,
    "harmonise_market": q_harmonise_market,
    "harmonise_news": q_harmonise_news,
    "allowlist_audit": q_allowlist_audit,
    "symbol_map_join": q_symbol_map_join,
    "unknown_symbol_reject": q_unknown_symbol_reject,
    "read_price_window": q_read_price_window,
    "read_market_window": q_read_market_window,
    "read_news_window": q_read_news_window,
    "lookback_days": q_lookback_days,
    "floor_hour": q_floor_hour,
    "epoch_millis_floor": q_epoch_millis_floor,
    "epoch_seconds_to_utc": q_epoch_seconds_to_utc,
    "parse_text_timestamp": q_parse_text_timestamp,
    "iso_utc_text": q_iso_utc_text,
    "union_assets": q_union_assets,
    "batch_stats_by_asset": q_batch_stats_by_asset,
    "batch_stats_total": q_batch_stats_total,
    "news_latest_by_asset": q_news_latest_by_asset,
    "key_uniqueness_audit": q_key_uniqueness_audit,
    "not_null_audit": q_not_null_audit,
    "top20_per_asset": q_top20_per_asset,
    "critical_gate": q_critical_gate,
}

_H = "date_trunc('hour', ts)"
_FEED_IN = "('click','view','purchase')"
_BATCH = "case when event_id % 3 = 0 then 1 else 0 end"
_MARKET = (f"with r as (select {_H} hr, value, row_number() over (partition by {_H} "
           f"order by event_id desc) rn from events)")
_NEWS = (f"with b as (select event_type asset, cast(user_id as varchar) url, event_id seq, {_H} hr, "
         f"{_BATCH} batch from events where event_type in {_FEED_IN}), "
         f"r as (select *, row_number() over (partition by asset, url order by batch, seq) rn from b)")

ORACLE_SQL = {
    "hourly_last_wins":
        f"select event_type asset, {_H} \"timestamp\", arg_max(value, event_id) \"close\" "
        f"from events where event_type in ('click','view') group by 1, 2",
    "upsert_two_batches":
        f"with b as (select event_type asset, {_H} hr, value \"close\", event_id seq, {_BATCH} batch "
        f"from events where event_type in {_FEED_IN}), r as (select *, row_number() over "
        f"(partition by asset, hr order by batch desc, seq desc) rn from b) "
        f"select asset, hr, \"close\" from r where rn = 1",
    "market_hourly_upsert": f"{_MARKET} select hr, value from r where rn = 1",
    "insert_ignore_two_batches": f"{_NEWS} select asset, url, seq from r where rn = 1",
    "dedup_keep_first":
        "with r as (select source, doc_id, n_chars, row_number() over (partition by source, text "
        "order by doc_id) rn from documents) select source, doc_id, n_chars from r where rn = 1",
    "dedup_audit":
        "select count(*) rows_in, count(distinct (source, text)) rows_kept from documents",
    "chart_positional_zip":
        "select vec_id, cast(i - 1 as int) pos, embedding[i] v, embedding[1:3][i] mc from "
        "(select vec_id, embedding, unnest(range(1, len(embedding) + 1)) i from embeddings)",
    "json_nested_default":
        "select event_id, coalesce(json_extract_string(props, '$.k'), '0') k from events",
    "vote_counts":
        "select event_id, cast(coalesce(json_extract_string(props, '$.UPVOTES'), '0') as int) up, "
        "cast(coalesce(json_extract_string(props, '$.k'), '0') as int) down from events",
    "news_shred_skip_empty":
        "select doc_id from documents where text is not null and text <> ''",
    "allowlist_filter":
        f"select event_id, event_type asset from events where event_type in {_FEED_IN}",
    "harmonise_price":
        f"select event_type asset, {_H} ts_hour, value \"close\", cast(null as double) market_cap, "
        f"'feed' source from events where event_type in {_FEED_IN}",
    "harmonise_market": f"select {_H} \"timestamp\", value, 'feed' source from events",
    "harmonise_news":
        f"select event_type asset, {_H} \"timestamp\", event_id from events "
        f"where event_type in {_FEED_IN}",
    "allowlist_audit":
        f"select count(*) rows_in, cast(sum(case when event_type in {_FEED_IN} then 1 else 0 end) "
        f"as bigint) rows_kept from events",
    "symbol_map_join":
        "select e.event_id, m.coin_id from events e join (values ('click','c-1'), ('view','v-1'), "
        "('purchase','p-1')) m(asset, coin_id) on e.event_type = m.asset",
    "unknown_symbol_reject":
        "select event_id, event_type from events e anti join (values ('click'), ('view'), "
        "('purchase')) m(asset) on e.event_type = m.asset",
    "read_price_window":
        "select event_id, event_type, ts from events where event_type = 'click' and ts between "
        "timestamp '2024-01-02 00:00:00' and timestamp '2024-01-03 00:00:00'",
    "read_market_window":
        f"{_MARKET} select hr, value from r where rn = 1 and hr between "
        f"timestamp '2024-01-02 00:00:00' and timestamp '2024-01-03 00:00:00'",
    "read_news_window":
        f"{_NEWS} select asset, url, seq, hr from r where rn = 1 and asset = 'click' and hr between "
        f"timestamp '2024-01-01 00:00:00' and timestamp '2024-01-03 00:00:00'",
    "lookback_days":
        "select event_id from events where ts >= timestamp '2024-01-30 00:00:00' - interval 1 day",
    "floor_hour": f"select event_id, {_H} h from events",
    "epoch_millis_floor":
        "select event_id, date_trunc('hour', make_timestamp((1704067200000 + event_id * 1000) * 1000)) t "
        "from events",
    "epoch_seconds_to_utc":
        "select event_id, make_timestamp((1704067200 + event_id) * 1000000) t from events",
    "parse_text_timestamp":
        "select event_id, try_cast(concat(cast(cast(ts as date) as varchar), "
        "case when event_id % 2 = 0 then ' ' else 'T' end, '05:07:00') as timestamp) t from events",
    "iso_utc_text":
        f"select event_id, strftime({_H}, '%Y-%m-%dT%H:%M:%S+00:00') s from events",
    "union_assets":
        "select event_id from events where event_type = 'click' union all "
        "select event_id from events where event_type = 'view'",
    "batch_stats_by_asset":
        f"select event_type asset, count(*) n, min({_H}) first_hour, max({_H}) last_hour "
        f"from events group by event_type",
    "batch_stats_total": "select count(*) n, count(distinct event_type) assets from events",
    "news_latest_by_asset": "select event_type asset, max(ts) latest from events group by 1",
    "key_uniqueness_audit":
        f"select event_type asset, {_H} hr, count(*) n from events group by 1, 2 having count(*) > 1",
    "not_null_audit":
        "select event_type asset, count(*) - count(value) null_close, count(*) - count(ts) null_ts "
        "from events group by event_type",
    "top20_per_asset":
        "with r as (select event_type asset, event_id, row_number() over (partition by event_type "
        "order by ts desc, event_id desc) rn from events) select asset, event_id from r where rn <= 20",
    "critical_gate":
        "select count(*) filter (where event_type = 'click') > 0 and "
        "count(*) filter (where event_type = 'view') > 0 ok from events",
}
