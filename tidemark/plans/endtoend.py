"""End-to-end queries: landing payloads derived from the driver tables go through the
whole ingest (classify/quarantine -> shred -> harmonise -> keyed merge into tables); stored
tables, windows of them, the run report and the quarantine are returned. Every one has SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.plans import landing_from_tables as L
from tidemark.plans.arrival_log import LogStore
from tidemark.plans.feeds import table
from tidemark.plans.ingest import ingest_source, report_frame, require_stored, run_ingest
from tidemark.plans.store import TableStore
from tidemark.session import ensure_utc, scratch_path
from tidemark.sources import shred
from tidemark.sources.landing import landed_from_frame, quarantine_counts
from tidemark.streaming.stream import run_stream_to_completion

PRICE_ASSETS = ["click", "view", "purchase", "error"]          # 'signup' is not supported
NEWS_ASSETS = [f"src{i}" for i in range(18)]                   # src18, src19 not supported


def envelopes(spark: SparkSession, sf: str):
    ev, docs = table(spark, sf, "events"), table(spark, sf, "documents")
    return L.price_envelopes(ev), L.market_envelopes(ev), L.news_envelopes(docs)


def ingest_into_store(spark: SparkSession, sf: str, store: TableStore | None = None,
                      kinds=("price", "market", "news")):
    ensure_utc(spark)
    store = store or TableStore(spark, scratch_path(spark, "store"))
    store.create_tables([{"price": S.PRICE, "market": S.MARKET, "news": S.NEWS}[k] for k in kinds])
    price, market, news = envelopes(spark, sf)
    results = run_ingest(spark, store, price=price if "price" in kinds else None,
                         market=market if "market" in kinds else None,
                         news=news if "news" in kinds else None,
                         assets={"price": PRICE_ASSETS, "news": NEWS_ASSETS})
    return store, results


def _whole_store(spark: SparkSession, sf: str, kind: str) -> TableStore:
    """A store with the one source's landing in it."""
    store, results = ingest_into_store(spark, sf, kinds=(kind,))
    require_stored(next(r for r in results if r.source == kind))
    return store


def _stored(spark, sf, spec, kind):
    store = _whole_store(spark, sf, kind)
    cols = [F.col(c).cast("timestamp_ntz").alias(c) if c == "timestamp" else F.col(c)
            for c in spec.columns_no_id]
    return store.read(spec).select(*cols)


def q_stored_price_table(spark: SparkSession, sf: str) -> DataFrame:
    return _stored(spark, sf, S.PRICE, "price")


def q_stored_market_table(spark: SparkSession, sf: str) -> DataFrame:
    return _stored(spark, sf, S.MARKET, "market")


def q_stored_news_table(spark: SparkSession, sf: str) -> DataFrame:
    return _stored(spark, sf, S.NEWS, "news")


# Two landings with overlapping keys: payloads of the later one (odd batches) are handled first, the
# earlier ones (even batches) last, into tables that already hold rows. News also lands an odd
# batch's articles again under a later batch number, so that stored keys are met (IGNORE).
AGAIN = 1_000_000_000


def two_landings(kind: str, landed: DataFrame) -> list[DataFrame]:
    odd, even = landed.where("batch_id % 2 = 1"), landed.where("batch_id % 2 = 0")
    if kind == "news":
        return [odd, even.unionByName(odd.withColumn("batch_id", F.col("batch_id") + AGAIN))]
    if kind == "market":
        # the earlier snapshot of an hour lands last, with other values, and must not win
        older = landed.withColumn("batch_id", F.col("batch_id") - 1) \
            .withColumn("payload", F.regexp_replace("payload", '"btc":', '"btc":7'))
        return [odd, even.unionByName(older)]
    return [odd, even]


def _two_batches(spark: SparkSession, sf: str, kind: str, spec: S.TableSpec) -> TableStore:
    ensure_utc(spark)
    store = TableStore(spark, scratch_path(spark, "store"))
    store.create_tables([spec])
    landed = dict(zip(("price", "market", "news"), envelopes(spark, sf)))[kind]
    assets = {"price": PRICE_ASSETS, "news": NEWS_ASSETS}.get(kind)
    for part in two_landings(kind, landed):
        res = ingest_source(spark, store, kind, part, assets)
        if not res.ok:
            raise RuntimeError(res.error)
    return store


def _public(df: DataFrame, spec: S.TableSpec) -> DataFrame:
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c == "timestamp" else F.col(c) for c in spec.columns_no_id])


def q_stored_price_two_batches(spark: SparkSession, sf: str) -> DataFrame:
    return _public(_two_batches(spark, sf, "price", S.PRICE).read(S.PRICE), S.PRICE)


def q_stored_market_two_batches(spark: SparkSession, sf: str) -> DataFrame:
    return _public(_two_batches(spark, sf, "market", S.MARKET).read(S.MARKET), S.MARKET)


def q_stored_news_two_batches(spark: SparkSession, sf: str) -> DataFrame:
    return _public(_two_batches(spark, sf, "news", S.NEWS).read(S.NEWS), S.NEWS)


def q_stored_news_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Surrogate ids over two batches: unique, without gaps, the second batch's above the first's."""
    store = TableStore(spark, scratch_path(spark, "store"))
    ensure_utc(spark)
    store.create_tables([S.NEWS])
    first, rest = two_landings("news", envelopes(spark, sf)[2])
    require_stored(ingest_source(spark, store, "news", first, NEWS_ASSETS))
    high = store.read(S.NEWS).agg(F.max("id").alias("first_max"))
    high = high.first()["first_max"] or 0          # nothing stored yet: ids begin above 0
    res = require_stored(ingest_source(spark, store, "news", rest, NEWS_ASSETS))
    return store.read(S.NEWS).agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("id").alias("n_ids"), F.min("id").alias("min_id"),
        F.max("id").alias("max_id"), F.lit(high).cast("long").alias("first_max")) \
        .withColumn("rows_ignored", F.lit(res.rows_ignored).cast("long"))


def q_batch_stats_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics of the price table from states kept per version folder, asked for after each of two batches and a replay."""
    ensure_utc(spark)
    store = TableStore(spark, scratch_path(spark, "store"))
    store.create_tables([S.PRICE])
    first, rest = two_landings("price", envelopes(spark, sf)[0])
    for part in (first, rest, first):
        res = ingest_source(spark, store, "price", part, PRICE_ASSETS)
        if not res.ok:
            raise RuntimeError(res.error)
        stats = store.batch_stats(S.PRICE)
    return stats.select("asset", "n", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("first_hour", "last_hour")])


def q_log_price_latest(spark: SparkSession, sf: str) -> DataFrame:
    """The price table by merge on read: two landings out of order and a replay, the first folded into the table."""
    ensure_utc(spark)
    store = LogStore(spark, scratch_path(spark, "store"))
    store.create_tables([S.PRICE])
    first, rest = two_landings("price", envelopes(spark, sf)[0])
    for k, part in enumerate((first, rest, first)):
        res = ingest_source(spark, store, "price", part, PRICE_ASSETS)
        if not res.ok:
            raise RuntimeError(res.error)
        if k == 0:
            store.fold(S.PRICE)
    return _public(store.read(S.PRICE), S.PRICE)


def q_stored_stats_pushed(spark: SparkSession, sf: str) -> DataFrame:
    """Rows, nulls and range of closes per month of the stored price table, from parquet footers."""
    store = _whole_store(spark, sf, "price")
    return store.footer_stats(S.PRICE).select("month", "n", "null_volume", "null_market_cap", "min_close", "max_close")


def q_stored_price_interleaved(spark: SparkSession, sf: str) -> DataFrame:
    """One asset over all time and one short time over all assets, read from the interleaved layout."""
    store = _whole_store(spark, sf, "price")
    store.compact(S.PRICE, files=16, interleave=True)
    one_asset = store.read_window(S.PRICE, "1970-01-01 00:00:00", "2999-01-01 00:00:00", "view")
    short = store.read_window(S.PRICE, *WINDOW).where("asset <> 'view'")
    return _public(one_asset.unionByName(short), S.PRICE)


def q_stream_price_out_of_order(spark: SparkSession, sf: str) -> DataFrame:
    """The later landing as one micro-batch, then the earlier one: the same table as a batch run."""
    ensure_utc(spark)
    root = scratch_path(spark, "stream-order")
    store = TableStore(spark, f"{root}/store")
    store.create_tables([S.PRICE])
    for part in two_landings("price", envelopes(spark, sf)[0]):
        part.coalesce(2).write.mode("append").json(f"{root}/landing")
        run_stream_to_completion(spark, store, "price", f"{root}/landing", f"{root}/_checkpoint", PRICE_ASSETS, max_files_per_trigger=1)
    return _public(store.read(S.PRICE), S.PRICE)


def q_news_max_articles_redelivered(spark: SparkSession, sf: str) -> DataFrame:
    """Every news payload delivered twice, the newest 3 articles of each kept."""
    ensure_utc(spark)
    store = TableStore(spark, scratch_path(spark, "store"))
    store.create_tables([S.NEWS])
    landed = envelopes(spark, sf)[2]
    require_stored(ingest_source(spark, store, "news", landed.unionByName(landed), NEWS_ASSETS, max_articles=3))
    return store.read(S.NEWS).groupBy("asset").agg(F.count(F.lit(1)).alias("n"), F.min("url").alias("first_url"))


# days whose first and last hour are included
WINDOW = ("2024-01-03 00:00:00", "2024-01-05 00:00:00")
NEWS_WINDOW = ("2024-01-01 02:00:00", "2024-01-01 09:00:00")


def _window(spark: SparkSession, sf: str, kind: str, spec: S.TableSpec, asset: str | None) -> DataFrame:
    store = _whole_store(spark, sf, kind)
    bounds = NEWS_WINDOW if kind == "news" else WINDOW
    inside = store.read_window(spec, *bounds, asset)
    reversed_ = store.read_window(spec, *bounds[::-1], asset)  # empty
    return _public(inside.unionByName(reversed_), spec)


def q_stored_price_window(spark: SparkSession, sf: str) -> DataFrame:
    return _window(spark, sf, "price", S.PRICE, "click")


def q_stored_market_window(spark: SparkSession, sf: str) -> DataFrame:
    return _window(spark, sf, "market", S.MARKET, None)


def q_stored_news_window(spark: SparkSession, sf: str) -> DataFrame:
    return _window(spark, sf, "news", S.NEWS, "src3")


def q_quarantine_after_replay(spark: SparkSession, sf: str) -> DataFrame:
    """The price landing handled twice: every rejected payload is in quarantine once."""
    ensure_utc(spark)
    store = TableStore(spark, scratch_path(spark, "store"))
    store.create_tables([S.PRICE])
    landed = envelopes(spark, sf)[0]
    for _ in range(2):
        require_stored(ingest_source(spark, store, "price", landed, PRICE_ASSETS))
    return store.read_quarantine().groupBy("source", "asset", "reason").agg(F.count(F.lit(1)).alias("payloads"))


def q_run_report(spark: SparkSession, sf: str) -> DataFrame:
    _, results = ingest_into_store(spark, sf)
    return report_frame(spark, results)


def q_quarantine_counts(spark: SparkSession, sf: str) -> DataFrame:
    ensure_utc(spark)
    price, market, news = envelopes(spark, sf)
    p = quarantine_counts(shred.classify_chart(landed_from_frame(price)), "price")
    m = quarantine_counts(shred.classify_global(landed_from_frame(market)), "market")
    n = quarantine_counts(shred.classify_news(landed_from_frame(news)), "news")
    return p.unionByName(m).unionByName(n)


def _streamed(spark: SparkSession, sf: str, kind: str, spec: S.TableSpec, assets) -> DataFrame:
    """A source's ingest as a Structured Streaming job: derived envelopes are landed as JSON
    files in the shared folder and consumed by an availableNow file stream whose foreachBatch
    runs the same classify/shred/harmonise/merge. Same stored table as the batch run."""
    ensure_utc(spark)
    root = scratch_path(spark, f"stream-{kind}")
    land = f"{root}/landing"
    envs = dict(zip(("price", "market", "news"), envelopes(spark, sf)))
    envs[kind].write.mode("errorifexists").json(land)
    store = TableStore(spark, f"{root}/store")
    store.create_tables([spec])
    run_stream_to_completion(spark, store, kind, land, f"{root}/_checkpoint", assets)
    cols = [F.col(c).cast("timestamp_ntz").alias(c) if c == "timestamp" else F.col(c)
            for c in spec.columns_no_id]
    return store.read(spec).select(*cols)


def q_stream_price_table(spark: SparkSession, sf: str) -> DataFrame:
    return _streamed(spark, sf, "price", S.PRICE, PRICE_ASSETS)


def q_stream_news_table(spark: SparkSession, sf: str) -> DataFrame:
    return _streamed(spark, sf, "news", S.NEWS, NEWS_ASSETS)


END_TO_END_QUERIES = {
    "stream_price_table": q_stream_price_table,
    "stream_news_table": q_stream_news_table,
    "stored_price_table": q_stored_price_table,
    "stored_market_table": q_stored_market_table,
    "stored_news_table": q_stored_news_table,
    "run_report": q_run_report,
    "quarantine_counts": q_quarantine_counts,
    "stored_price_two_batches": q_stored_price_two_batches,
    "stored_market_two_batches": q_stored_market_two_batches,
    "stored_news_two_batches": q_stored_news_two_batches,
    "stored_news_ids": q_stored_news_ids,
    "stream_price_out_of_order": q_stream_price_out_of_order,
    "batch_stats_incremental": q_batch_stats_incremental,
    "log_price_latest": q_log_price_latest,
    "stored_stats_pushed": q_stored_stats_pushed,
    "stored_price_interleaved": q_stored_price_interleaved,
    "news_max_articles_redelivered": q_news_max_articles_redelivered,
    "stored_price_window": q_stored_price_window,
    "stored_market_window": q_stored_market_window,
    "stored_news_window": q_stored_news_window,
    "quarantine_after_replay": q_quarantine_after_replay,
}

_PRICE_IN = "('click','view','purchase','error')"
_NEWS_IN = "(" + ",".join(f"'{a}'" for a in NEWS_ASSETS) + ")"

# The stored tables after a full ingest of the derived landing payloads, in SQL:
# price  - payloads are 256-event blocks per asset; an 'error' block holding an event id
#          divisible by 97 is quarantined whole; the last arrival per (asset, hour) wins;
#          volumes are one point short per payload (NULL for a block's last point).
# market - one snapshot per hour: btc = max(value), cap = min(value), volume = count.
# news   - first arrival per (source, text digest) of non-empty texts of supported sources.
END_TO_END_SQL = {
    "stored_price_table": f"""
with e as (select event_id, event_type, ts, value, event_id // 256 blk from events),
bad as (select distinct event_type, blk from e where event_type = 'error' and event_id % 97 = 0),
v as (select e.* from e anti join bad on e.event_type = bad.event_type and e.blk = bad.blk
      where e.event_type in {_PRICE_IN}),
b as (select *, max(event_id) over (partition by event_type, blk) last_id,
             count(*) over (partition by event_type, blk) n from v),
r as (select *, row_number() over (partition by event_type, date_trunc('hour', ts)
                                   order by event_id desc) rn from b)
select event_type asset, date_trunc('hour', ts) "timestamp", value "close",
       case when event_id = last_id and n > 1 then null else value * 10 end volume,
       value * 1000 market_cap, 'coingecko' source
from r where rn = 1""",
    "stored_market_table": """
select date_trunc('hour', ts) "timestamp", max(value) btc_dominance, 'coingecko' source,
       min(value) total_market_cap_usd, cast(count(*) as double) total_volume_usd
from events group by 1""",
    "stored_news_table": f"""
with d as (select *, row_number() over (partition by source, text order by doc_id) rn
           from documents where text <> '' and source in {_NEWS_IN})
select source asset, date_trunc('hour', make_timestamp((1704067200 + doc_id * 60) * 1000000)) "timestamp",
       text headline, 'https://news.example/' || sha256(text) url, 'cryptocompare' source,
       cast(0 as bigint) votes_positive, cast(0 as bigint) votes_negative
from d where rn = 1""",
}
END_TO_END_SQL["stream_price_table"] = END_TO_END_SQL["stored_price_table"]

# Payload classification of the derived landing: price payloads are (asset, 256-event block);
# a cut 'signup' payload is unparseable, an 'error' payload holding a NULL value is invalid.
_PRICE_BLOCKS = """
with pb as (select event_type asset, event_id // 256 blk,
                   bool_or(event_type = 'error' and event_id % 97 = 0) has_null
            from events group by 1, 2),
pc as (select asset, blk, case when asset = 'signup' and blk % 13 = 0 then 'unparseable_payload'
                               when has_null then 'invalid_values' end reason from pb)"""

END_TO_END_SQL["quarantine_counts"] = _PRICE_BLOCKS + """
select 'price' source, asset, reason, count(*) payloads from pc group by 1, 2, 3
union all
select 'market', null, null, count(distinct date_trunc('hour', ts)) from events
union all
select 'news' source, source asset, cast(null as varchar) reason, count(distinct doc_id // 100) payloads
from documents group by 1, 2, 3"""

END_TO_END_SQL["run_report"] = _PRICE_BLOCKS + f""",
pr as (select e.event_type, date_trunc('hour', e.ts) hr from events e join pc
       on pc.asset = e.event_type and pc.blk = e.event_id // 256
       where pc.reason is null and e.event_type in {_PRICE_IN}),
nd as (select source, text from documents where text <> '' and source in {_NEWS_IN})
select 'price' source, true ok, (select count(*) from pc) payloads,
       (select count(*) from pc where reason is not null) quarantined,
       (select count(*) from pc where reason is null and asset not in {_PRICE_IN}) payloads_unsupported,
       count(*) rows_in, count(distinct (event_type, hr)) rows_written, cast(0 as bigint) rows_ignored,
       cast(0 as bigint) rows_null_dropped, count(*) - count(distinct (event_type, hr)) rows_deduped,
       cast(0 as bigint) rows_empty_url, cast(0 as bigint) quarantined_rows, cast(null as varchar) error,
       cast(null as varchar) failure
from pr
union all
select 'market', true, count(distinct date_trunc('hour', ts)), 0, 0, count(distinct date_trunc('hour', ts)),
       count(distinct date_trunc('hour', ts)), 0, 0, 0, 0, 0, null, null
from events
union all
select 'news', true, (select count(distinct (source, doc_id // 100)) from documents), 0,
       (select count(distinct (source, doc_id // 100)) from documents where source not in {_NEWS_IN}), count(*),
       count(distinct (source, text)), 0, 0, count(*) - count(distinct (source, text)), 0, 0, null, null
from nd"""
END_TO_END_SQL["stream_news_table"] = END_TO_END_SQL["stored_news_table"]
# batches handled out of order leave the tables that one run in order leaves
END_TO_END_SQL["stored_price_two_batches"] = END_TO_END_SQL["stored_price_table"]
END_TO_END_SQL["stream_price_out_of_order"] = END_TO_END_SQL["stored_price_table"]
END_TO_END_SQL["batch_stats_incremental"] = (
    "select asset, count(*) n, min(\"timestamp\") first_hour, max(\"timestamp\") last_hour "
    f"from ({END_TO_END_SQL['stored_price_table']}) t group by 1")
END_TO_END_SQL["log_price_latest"] = END_TO_END_SQL["stored_price_table"]
END_TO_END_SQL["stored_stats_pushed"] = (
    "select strftime(\"timestamp\", '%Y-%m') \"month\", count(*) n, count(*) - count(volume) null_volume, "
    "count(*) - count(market_cap) null_market_cap, min(\"close\") min_close, max(\"close\") max_close "
    f"from ({END_TO_END_SQL['stored_price_table']}) t group by 1")
END_TO_END_SQL["stored_price_interleaved"] = (
    f"select * from ({END_TO_END_SQL['stored_price_table']}) t where asset = 'view' "
    f"or \"timestamp\" between timestamp '{WINDOW[0]}' and timestamp '{WINDOW[1]}'")
END_TO_END_SQL["stored_market_two_batches"] = END_TO_END_SQL["stored_market_table"]
END_TO_END_SQL["stored_news_two_batches"] = END_TO_END_SQL["stored_news_table"]
for _kind, _asset, _bounds in (("price", "asset = 'click' and ", WINDOW), ("market", "", WINDOW), ("news", "asset = 'src3' and ", NEWS_WINDOW)):
    END_TO_END_SQL[f"stored_{_kind}_window"] = (
        f"select * from ({END_TO_END_SQL[f'stored_{_kind}_table']}) t "
        f"where {_asset}\"timestamp\" between timestamp '{_bounds[0]}' and timestamp '{_bounds[1]}'")
_NEWS_ROWS = f"(select * from documents where text <> '' and source in {_NEWS_IN})"
END_TO_END_SQL["stored_news_ids"] = f"""
with o as (select distinct source, text from {_NEWS_ROWS} where doc_id // 100 % 2 = 1),
a as (select distinct source, text from {_NEWS_ROWS})
select (select count(*) from a) n_rows, (select count(*) from a) n_ids, cast(1 as bigint) min_id,
       (select count(*) from a) max_id, (select count(*) from o) first_max,
       -- stored keys met again, but for those whose earlier arrival came with this batch
       (select count(*) from o) - (select count(*) from (
          select source, text from {_NEWS_ROWS} group by 1, 2
          having bool_or(doc_id // 100 % 2 = 1) and min(doc_id // 100) % 2 = 0)) rows_ignored"""
END_TO_END_SQL["news_max_articles_redelivered"] = f"""
with r as (select *, row_number() over (partition by source, doc_id // 100 order by doc_id desc) rn
           from documents where source in {_NEWS_IN} and text <> '')
select source asset, count(distinct text) n, 'https://news.example/' || min(sha256(text)) first_url
from r where rn <= 3 group by 1"""
END_TO_END_SQL["quarantine_after_replay"] = _PRICE_BLOCKS + """
select 'price' source, asset, reason, count(*) payloads from pc where reason is not null group by 1, 2, 3"""
