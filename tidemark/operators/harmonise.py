"""Harmonise: column contracts, asset allow-list, UTC hour floor.

Harmonise keeps every valid row (no dedup, no sort, no projection): several raw points in
one hour all pass through; the keyed sink decides the survivor.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas as S
from tidemark.functions.timefn import floor_hour, floor_hour_of, parse_utc
from tidemark.operators.sizing import broadcast_if_small

AssetSet = Sequence[str] | DataFrame
# A dimension (allow-list, symbol map) is broadcast only below this many rows.
DIM_ROWS = 1_000_000
DIM_BYTES = 8 << 20


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    """Raise ``ValueError`` naming missing columns (contract order). Metadata only, no job."""
    present = set(df.columns)
    missing = [c for c in required if c not in present]
    if missing:
        raise ValueError(S.MISSING_COLUMNS_MESSAGE.format(missing))


def asset_dim(spark: SparkSession, mapping: dict[str, str] | Iterable[str] | None = None) -> DataFrame:
    """Asset dimension (asset, vendor_id) from a driver-side mapping; default = the ten assets.
    Marked for broadcast if the mapping, whose size the driver knows, is small."""
    mapping = S.DEFAULT_ASSET_MAP if mapping is None else mapping
    if not isinstance(mapping, dict):
        mapping = {a: None for a in mapping}
    schema = T.StructType([T.StructField("asset", T.StringType(), False),
                           T.StructField("vendor_id", T.StringType(), True)])
    dim = spark.createDataFrame(list(mapping.items()), schema)
    size = sum(len(k.encode()) + len((v or "").encode()) + 32 for k, v in mapping.items())
    return F.broadcast(dim) if len(mapping) <= DIM_ROWS and size <= DIM_BYTES else dim


def _membership(df: DataFrame, assets: AssetSet | None, col: str, how: str) -> DataFrame:
    if assets is None:
        assets = S.VALID_ASSETS
    if isinstance(assets, DataFrame):
        # dimension frame: broadcast semi/anti join when a bounded probe proves it small,
        # otherwise an ordinary (shuffle) join planned by Spark/AQE
        dim = broadcast_if_small(assets.select(F.col("asset").alias("__asset")).distinct(), DIM_ROWS)
        return df.join(dim, df[col] == dim["__asset"], how)
    values = list(dict.fromkeys(assets))
    member = F.col(col).isin(values) if values else F.lit(False)
    if how == "left_semi":
        return df.where(member)               # NULL asset -> NULL predicate -> dropped
    return df.where(F.col(col).isNotNull() & ~member)


def filter_assets(df: DataFrame, assets: AssetSet | None = None, col: str = "asset") -> DataFrame:
    """Keep rows whose asset is in the allow-list (exact, case-sensitive; NULL dropped)."""
    return _membership(df, assets, col, "left_semi")


def reject_assets(df: DataFrame, assets: AssetSet | None = None, col: str = "asset") -> DataFrame:
    """Rows whose (non-null) asset is NOT in the allow-list — the unknown-symbol rejects."""
    return _membership(df, assets, col, "left_anti")


def require_known_assets(df: DataFrame, assets: Sequence[str] | None = None, col: str = "asset",
                         show: int = 20) -> DataFrame:
    """Strict form of the symbol check: raise ``ValueError`` with the number of unknown symbols, the first
    ``show`` of them (the text says when it shows fewer than there are) and the valid ones;
    otherwise return ``df`` unchanged."""
    values = list(S.VALID_ASSETS if assets is None else assets)
    unknown = reject_assets(df, values, col).select(col).distinct()
    n = unknown.count()
    if n:
        first = [r[0] for r in unknown.orderBy(col).limit(show).collect()]
        cut = f" (first {show} shown)" if n > show else ""
        raise ValueError(f"{n} symbol(s) {first}{cut} not found in the asset map. Valid symbols: {values}")
    return df


def allowlist_audit(df: DataFrame, assets: AssetSet | None = None, col: str = "asset") -> DataFrame:
    """One-pass (rows_in, rows_kept) of the allow-list filter; dropped = rows_in - rows_kept."""
    if isinstance(assets, DataFrame):
        raise TypeError("allowlist_audit takes a list of assets")
    values = list(S.VALID_ASSETS if assets is None else assets)
    return df.agg(F.count(F.lit(1)).alias("rows_in"),
                  F.count_if(F.coalesce(F.col(col).isin(values), F.lit(False))).alias("rows_kept"))


def map_symbols(df: DataFrame, dim: DataFrame, col: str = "asset") -> DataFrame:
    """Attach the vendor id of each symbol (inner join to the broadcast asset dimension)."""
    d = dim.select(F.col("asset").alias("__asset"), "vendor_id")  # asset_dim has decided about broadcasting
    return df.join(d, df[col] == d["__asset"], "inner").drop("__asset")


def floor_timestamps(df: DataFrame, col: str = "timestamp", strict: bool = True) -> DataFrame:
    """Parse ``col`` to UTC (if text) and floor it to the hour.

    strict: an unparseable text value fails the batch (ANSI cast error at execution);
    lenient: it becomes NULL, to be quarantined by the caller.
    """
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.StringType) and not strict:
        return df.withColumn(col, floor_hour(parse_utc(col, strict=False)))
    return df.withColumn(col, floor_hour_of(df, col))


def harmonise_price(df: DataFrame, assets: AssetSet | None = None, strict: bool = True) -> DataFrame:
    require_columns(df, S.PRICE_REQUIRED_COLUMNS)
    return floor_timestamps(filter_assets(df, assets), "timestamp", strict)


def harmonise_market(df: DataFrame, strict: bool = True) -> DataFrame:
    require_columns(df, S.MARKET_REQUIRED_COLUMNS)
    return floor_timestamps(df, "timestamp", strict)


def harmonise_news(df: DataFrame, assets: AssetSet | None = None, strict: bool = True) -> DataFrame:
    if "published_at" in df.columns:
        df = df.withColumnRenamed("published_at", "timestamp")
    require_columns(df, S.NEWS_REQUIRED_COLUMNS)
    return floor_timestamps(filter_assets(df, assets), "timestamp", strict)


def skip_empty_text(df: DataFrame, col: str) -> DataFrame:
    """Drop rows whose text is NULL or empty. Whitespace-only text is kept (no trim)."""
    return df.where(F.col(col).isNotNull() & (F.col(col) != F.lit("")))


def lookback(df: DataFrame, ts_col: str, as_of: Column, days: int) -> DataFrame:
    """Keep rows no older than ``days`` before ``as_of``."""
    return df.where(F.col(ts_col) >= as_of - F.make_dt_interval(F.lit(days)))
