"""Payloads as VARIANT: a key that is missing, a key that is explicitly null, and a number or a text that
looks like one are four different things, which a fixed schema cannot tell apart.

The fixed-schema path (`shred`) stays the default; it reads known payloads once and is cheaper. These
functions decide the cases where the difference counts:

* a chart array that is explicitly null fails its payload, a missing one is empty (`chart_has_null_array`);
* a missing URL becomes "" and takes part in the key, an explicit null stays NULL and is dropped by the sink;
* ``PUBLISHED_ON`` missing: epoch 0; a JSON number: that time; anything else (null, text, even numeric text): the
  ingest time.

Unparseable payloads give NULL variants and no rows; nothing raises under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions.timefn import epoch_in_range, epoch_seconds_to_ts

CHART_ARRAYS = ("prices", "market_caps", "total_volumes")
NUMBERS = ("BIGINT", "DOUBLE", "FLOAT")  # what schema_of_variant calls JSON numbers, besides DECIMAL(p,s)


def _part(v: Column, key: str) -> Column:
    """The value under a key, still a VARIANT: SQL NULL if the key is missing, a VARIANT null if it is null."""
    return F.try_variant_get(v, f"$.{key}", "variant")


def field_state(v: Column, key: str) -> Column:
    """``missing``, ``null`` or ``value``."""
    x = _part(v, key)
    return F.when(x.isNull(), "missing").when(F.is_variant_null(x), "null").otherwise("value")


def field_kind(v: Column, key: str) -> Column:
    """``missing``, ``null``, ``number``, ``text`` or ``other``."""
    x = _part(v, key)
    kind = F.schema_of_variant(x)
    return F.when(x.isNull(), "missing").when(F.is_variant_null(x), "null") \
        .when(kind.isin(*NUMBERS) | kind.startswith("DECIMAL"), "number").when(kind == "STRING", "text").otherwise("other")


def chart_has_null_array(payload: Column) -> Column:
    """Whether a chart payload has an array that is explicitly null (a missing one has not)."""
    v = F.try_parse_json(payload)
    out = F.lit(False)
    for key in CHART_ARRAYS:
        out = out | (field_state(v, key) == "null")
    return F.coalesce(out, F.lit(False))


def published_at(article: Column, ingest_ts: Column) -> Column:
    """Unix seconds -> UTC, by the kind of ``PUBLISHED_ON``."""
    kind = field_kind(article, "PUBLISHED_ON")
    secs = F.try_variant_get(article, "$.PUBLISHED_ON", "double")
    return F.when(kind == "missing", epoch_seconds_to_ts(F.lit(0))) \
        .when((kind == "number") & epoch_in_range(secs), epoch_seconds_to_ts(secs)).otherwise(ingest_ts)


def news_articles(landed: DataFrame) -> DataFrame:
    """``asset, ingest_ts, batch_id, payload_hash, seq, article`` (VARIANT) of every article of news payloads."""
    data = F.try_variant_get(F.try_parse_json("payload"), "$.Data", "array<variant>")
    return landed.select("asset", "ingest_ts", "batch_id", F.xxhash64("payload").alias("payload_hash"),
                         F.posexplode(data).alias("seq", "article"))


def shred_news_variant(landed: DataFrame, source: str = S.NEWS_SOURCE) -> DataFrame:
    """As `shred.shred_news`, with the cases above told apart; ``url_state`` and ``published_kind`` are kept."""
    a = F.col("article")
    title = F.try_variant_get(a, "$.TITLE", "string")
    return news_articles(landed).where(title.isNotNull() & (title != F.lit(""))).select(
        "asset", title.alias("headline"),
        F.when(field_state(a, "URL") == "missing", F.lit("")).otherwise(F.try_variant_get(a, "$.URL", "string")).alias("url"),
        published_at(a, F.col("ingest_ts")).alias("published_at"),
        field_state(a, "URL").alias("url_state"), field_kind(a, "PUBLISHED_ON").alias("published_kind"),
        F.lit(source).alias("source"), "batch_id", "ingest_ts", "payload_hash", F.col("seq").cast("long").alias("seq"))
