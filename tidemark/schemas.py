"""Table schemas, keys, required-column contracts and the asset dimension.

Stored schemas list columns in table (DDL) order; readers and sinks project to that order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the reference system's for identical results.
#   supported assets, in order:  BTC ETH BNB XRP SOL DOGE ADA TRX AVAX SHIB
#   vendor coin ids, same order: bitcoin ethereum binancecoin ripple solana
#                                dogecoin cardano tron avalanche-2 shiba-inu
#   price/market source label:   coingecko
#   news source label:           cryptocompare
#   required columns (contract order):
#     price   asset timestamp close market_cap volume source
#     market  timestamp btc_dominance total_market_cap_usd total_volume_usd source
#     news    asset headline url timestamp votes_positive votes_negative source
#   error text of the column contract: "Missing required columns: [...]"
# ---------------------------------------------------------------------------
VALID_ASSETS = ["BTC", "ETH", "BNB", "XRP", "SOL", "DOGE", "ADA", "TRX", "AVAX", "SHIB"]
PRICE_SOURCE = "coingecko"
NEWS_SOURCE = "cryptocompare"
PRICE_REQUIRED_COLUMNS = ["asset", "timestamp", "close", "market_cap", "volume", "source"]
MARKET_REQUIRED_COLUMNS = ["timestamp", "btc_dominance", "total_market_cap_usd", "total_volume_usd", "source"]
NEWS_REQUIRED_COLUMNS = ["asset", "headline", "url", "timestamp", "votes_positive", "votes_negative", "source"]
MISSING_COLUMNS_MESSAGE = "Missing required columns: {}"

DEFAULT_ASSET_MAP = {
    "BTC": "bitcoin", "ETH": "ethereum", "BNB": "binancecoin", "XRP": "ripple", "SOL": "solana",
    "DOGE": "dogecoin", "ADA": "cardano", "TRX": "tron", "AVAX": "avalanche-2", "SHIB": "shiba-inu",
}

# ---------------------------------------------------------------------------
# Stored tables
# ---------------------------------------------------------------------------
PRICE_SCHEMA = T.StructType([
    T.StructField("asset", T.StringType(), False),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("close", T.DoubleType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("market_cap", T.DoubleType(), True),
    T.StructField("volume", T.DoubleType(), True),
])
MARKET_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("btc_dominance", T.DoubleType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("total_market_cap_usd", T.DoubleType(), True),
    T.StructField("total_volume_usd", T.DoubleType(), True),
])
NEWS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("asset", T.StringType(), False),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("headline", T.StringType(), False),
    T.StructField("url", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("votes_positive", T.LongType(), True),
    T.StructField("votes_negative", T.LongType(), True),
])


# Storage time grains for tables partitioned by their key column `timestamp`.
# Coarser grain: fewer, larger files; finer grain: an hourly upsert rewrites less data.
TIME_GRAINS = {"month": "yyyy-MM", "day": "yyyy-MM-dd"}


class TableSpec:
    """What a keyed table is: schema, key, non-null columns, storage partitioning, conflict rule."""

    def __init__(self, name, schema, key, partition_col, partition_expr, sort_cols, conflict,
                 time_grain=None):
        self.name = name
        self.schema = schema
        self.key = list(key)
        self.not_null = [f.name for f in schema.fields if not f.nullable]
        self.partition_col = partition_col      # storage partition column (derived from a key column)
        self.partition_expr = partition_expr    # SQL expression computing it
        self.sort_cols = list(sort_cols)        # in-file order -> row-group min/max skipping
        self.conflict = conflict                # "replace" (last wins) or "ignore" (first wins)
        self.time_grain = time_grain            # set when partitioned by a grain of `timestamp`

    @property
    def columns(self):
        return self.schema.fieldNames()

    @property
    def columns_no_id(self):
        return [c for c in self.columns if c != "id"]

    key_buckets = 1

    def with_key_buckets(self, buckets: int) -> "TableSpec":
        """News layout ``asset#bucket``: the stored keys are split by a hash of ``url`` so a
        batch's existence check reads only the buckets its URLs fall into. 1 = by asset only."""
        if self.conflict != "ignore" or buckets <= 1 or buckets == self.key_buckets:
            return self
        expr = (f"concat(`asset`, '#', lpad(cast(pmod(xxhash64(`url`), {int(buckets)}) as string), 5, '0'))")
        spec = TableSpec(self.name, self.schema, self.key, self.partition_col, expr, self.sort_cols,
                         self.conflict, self.time_grain)
        spec.key_buckets = int(buckets)
        return spec

    def at_grain(self, grain: str) -> "TableSpec":
        """The same table partitioned by another grain of `timestamp` (month or day)."""
        if self.time_grain is None or grain == self.time_grain:
            return self
        fmt = TIME_GRAINS[grain]
        return TableSpec(self.name, self.schema, self.key, grain,
                         f"date_format(`timestamp`, '{fmt}')", self.sort_cols, self.conflict, grain)


def _by_time(name, schema, key, sort_cols, conflict, grain="month"):
    return TableSpec(name, schema, key, grain, f"date_format(`timestamp`, '{TIME_GRAINS[grain]}')",
                     sort_cols, conflict, grain)


# Price and market partitions are a function of the key column `timestamp` (month by default),
# which makes partition-scoped replacement sound. News is keyed by (asset, url) with no time in
# the key, so its partitions follow `asset`.
PRICE = _by_time("price_ohlcv", PRICE_SCHEMA, ["asset", "timestamp"], ["asset", "timestamp"], "replace")
MARKET = _by_time("market_signals", MARKET_SCHEMA, ["timestamp"], ["timestamp"], "replace")
NEWS = TableSpec("news_headlines", NEWS_SCHEMA, ["asset", "url"], "asset_part",
                 "`asset`", ["asset", "timestamp"], "ignore")
TABLES = {t.name: t for t in (PRICE, MARKET, NEWS)}

QUARANTINE_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("asset", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("ingest_ts", T.TimestampType()),
    T.StructField("reason", T.StringType()),
    T.StructField("raw", T.StringType()),
])

# ---------------------------------------------------------------------------
# Landed payloads. One JSON object per line: an envelope around one vendor response.
# ---------------------------------------------------------------------------
PAIR_ARRAY = T.ArrayType(T.ArrayType(T.DoubleType()))
CHART_PAYLOAD = T.StructType([
    T.StructField("prices", PAIR_ARRAY),
    T.StructField("market_caps", PAIR_ARRAY),
    T.StructField("total_volumes", PAIR_ARRAY),
])
CURRENCY_MAP = T.MapType(T.StringType(), T.DoubleType())
GLOBAL_PAYLOAD = T.StructType([
    T.StructField("data", T.StructType([
        T.StructField("market_cap_percentage", CURRENCY_MAP),
        T.StructField("total_market_cap", CURRENCY_MAP),
        T.StructField("total_volume", CURRENCY_MAP),
    ])),
])
# News articles are parsed as string maps: one parse per payload, and key presence is kept
# (an absent URL defaults to "", an explicit null does not); numbers arrive as their text.
NEWS_PAYLOAD = T.StructType([T.StructField("Data", T.ArrayType(T.MapType(T.StringType(), T.StringType())))])


def envelope_schema(payload_type: T.DataType | None = None) -> T.StructType:
    """Landing envelope. ``payload`` is kept as raw text unless a type is given."""
    return T.StructType([
        T.StructField("asset", T.StringType()),
        T.StructField("ingest_ts", T.TimestampType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("payload", payload_type or T.StringType()),
    ])
