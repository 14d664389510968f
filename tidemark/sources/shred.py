"""Shredders: classified payloads -> typed rows carrying their arrival order.

Every output row keeps ``batch_id, ingest_ts, seq`` (seq = position inside its payload),
which is the arrival order the keyed sinks use to pick winners.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions.nested import get_or
from tidemark.functions.timefn import epoch_in_range, epoch_millis_to_ts, epoch_seconds_to_ts, floor_hour
from tidemark.sources.landing import classify
from tidemark.sources.variant import chart_has_null_array


def _empty_pairs() -> Column:
    return F.array().cast(S.PAIR_ARRAY)


def _bad_pair(p: Column) -> Column:
    t = F.get(p, F.lit(0))
    return p.isNull() | (F.size(p) < 2) | t.isNull() | F.get(p, F.lit(1)).isNull() | ~epoch_in_range(t, 1000)


def _bad_value_pair(p: Column) -> Column:
    return p.isNull() | (F.size(p) < 2) | F.get(p, F.lit(1)).isNull()


def chart_invalid() -> Column:
    """A used pair holding NULL fails the payload.

    Every ``prices`` pair is used; ``market_caps``/``total_volumes`` pairs are used only up to
    the length of ``prices`` (their missing tail just becomes NULL).
    """
    prices = F.col("p.prices")
    n = F.coalesce(F.size(prices), F.lit(0))

    def used(arr: Column) -> Column:
        a = F.coalesce(arr, _empty_pairs())
        return F.slice(a, F.lit(1), F.greatest(n, F.lit(1)))

    return (F.exists(F.coalesce(prices, _empty_pairs()), _bad_pair)
            | ((n > 0) & F.exists(used(F.col("p.market_caps")), _bad_value_pair))
            | ((n > 0) & F.exists(used(F.col("p.total_volumes")), _bad_value_pair)))


def classify_chart(landed: DataFrame, strict_nulls: bool = False) -> DataFrame:
    """``strict_nulls``: an array that is explicitly null fails its payload, a missing one is empty (the
    payload is then also parsed as VARIANT; without it both are empty)."""
    invalid = chart_invalid()
    return classify(landed, S.CHART_PAYLOAD, invalid | chart_has_null_array(F.col("payload")) if strict_nulls else invalid)


def zip_by_position(df: DataFrame, keep, driver: Column, others: dict, value_name: str = "value",
                    pos_name: str = "pos") -> DataFrame:
    """Positional zip: one row per element of ``driver``; ``others[name][pos]`` alongside.

    Row count is driven by ``driver`` alone; a shorter other array yields NULL for its missing
    tail and a longer one is cut. ``arrays_zip`` pads with NULL, so each exploded row carries one
    zipped element rather than copies of whole arrays (linear in the array length).
    A NULL array counts as empty.
    """
    zipped = F.arrays_zip(driver.alias("__d"), *[c.alias(n) for n, c in others.items()])
    exploded = df.select(*keep, F.size(driver).alias("__n"), F.posexplode(zipped).alias(pos_name, "__z"))
    return exploded.where(F.col(pos_name) < F.col("__n")).select(
        *keep, F.col(pos_name),
        F.col("__z.__d").alias(value_name),
        *[F.col(f"__z.{n}").alias(n) for n in others])


def shred_chart(classified: DataFrame, source: str = S.PRICE_SOURCE) -> DataFrame:
    """Price chart -> one row per ``prices`` point; caps and volumes joined by position.

    A missing caps/volumes tail gives NULL market_cap/volume; points beyond ``prices`` are
    dropped (row count is driven by ``prices``).
    """
    good = classified.where(F.col("reason").isNull())
    arr = lambda name: F.coalesce(F.col(f"p.{name}"), _empty_pairs())
    z = zip_by_position(good, ["asset", "ingest_ts", "batch_id", "payload_hash"], arr("prices"),
                        {"mc": arr("market_caps"), "tv": arr("total_volumes")},
                        value_name="pr", pos_name="seq")
    raw_ts = epoch_millis_to_ts(F.get("pr", F.lit(0)))
    return z.select(
        "asset",
        floor_hour(raw_ts).alias("timestamp"),
        F.get("pr", F.lit(1)).alias("close"),
        F.get("mc", F.lit(1)).alias("market_cap"),
        F.get("tv", F.lit(1)).alias("volume"),
        F.lit(source).alias("source"),
        "batch_id", "ingest_ts", "payload_hash", F.col("seq").cast("long").alias("seq"),
        raw_ts.alias("point_ts"),            # unfloored point time (request-window bound)
    )


def classify_global(landed: DataFrame) -> DataFrame:
    btc = get_or(F.col("p.data.market_cap_percentage"), "btc")
    return classify(landed, S.GLOBAL_PAYLOAD, btc.isNull(), need_asset=False)


def shred_global(classified: DataFrame, source: str = S.PRICE_SOURCE) -> DataFrame:
    """Market snapshot -> one row; its time is the ingest time (the vendor time is ignored)."""
    good = classified.where(F.col("reason").isNull())
    return good.select(
        floor_hour(F.col("ingest_ts")).alias("timestamp"),
        get_or(F.col("p.data.market_cap_percentage"), "btc").alias("btc_dominance"),
        get_or(F.col("p.data.total_market_cap"), "usd").alias("total_market_cap_usd"),
        get_or(F.col("p.data.total_volume"), "usd").alias("total_volume_usd"),
        F.lit(source).alias("source"),
        "batch_id", "ingest_ts", "payload_hash", F.lit(0).cast("long").alias("seq"),
    )


def classify_news(landed: DataFrame) -> DataFrame:
    return classify(landed, S.NEWS_PAYLOAD)


def published_at(article: Column, ingest_ts: Column) -> Column:
    """Unix seconds -> UTC. Key absent -> epoch 0; null or non-numeric -> the ingest time."""
    secs = F.try_element_at(article, F.lit("PUBLISHED_ON")).try_cast("double")
    return F.when(~F.map_contains_key(article, F.lit("PUBLISHED_ON")), epoch_seconds_to_ts(F.lit(0))) \
        .when(secs.isNull() | ~epoch_in_range(secs), ingest_ts) \
        .otherwise(epoch_seconds_to_ts(secs))


def shred_news(classified: DataFrame, source: str = S.NEWS_SOURCE) -> DataFrame:
    """News list -> one row per article; empty/missing titles skipped (whitespace kept).

    An absent URL becomes "" (and so takes part in the (asset, url) key); an explicit null
    URL stays NULL and is dropped by the sink's NOT NULL rule.
    """
    good = classified.where(F.col("reason").isNull())
    # numbered before the articles are taken apart: one number per delivered payload
    arts = good.withColumn("delivery", F.monotonically_increasing_id()) \
        .select("asset", "ingest_ts", "batch_id", "payload_hash", "delivery", F.posexplode(F.col("p.Data")).alias("seq", "art"))
    art = F.col("art")
    title = F.try_element_at(art, F.lit("TITLE"))
    url = F.when(F.map_contains_key(art, F.lit("URL")), F.try_element_at(art, F.lit("URL"))) \
        .otherwise(F.lit(""))
    return arts.where(title.isNotNull() & (title != F.lit(""))).select(
        "asset",
        title.alias("headline"),
        url.alias("url"),
        published_at(art, F.col("ingest_ts")).alias("published_at"),
        F.lit(0).cast("long").alias("votes_positive"),
        F.lit(0).cast("long").alias("votes_negative"),
        F.lit(source).alias("source"),
        "batch_id", "ingest_ts", "payload_hash", F.col("seq").cast("long").alias("seq"), "delivery",
    )
