"""Keyed merge operators on DataFrames (no MERGE INTO on plain parquet, so we compose one).

Arrival order is explicit: every row carries order columns (e.g. ``batch_id, ingest_ts,
seq``) that are unique per key, so every survivor is deterministic and independent of
partitioning or shuffle order.

* last wins  (REPLACE): the whole latest row replaces the stored one — a later NULL
  overwrites an earlier value.
* first wins (IGNORE):  the first row for a key is kept forever; later rows are dropped.

Winners are picked with ``max_by``/``min_by`` over a struct of the whole row: a hash/sort
aggregate with partial (map-side) aggregation, so a key holding a third of all rows is
reduced inside each map task before the shuffle instead of being sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timefn import nan_to_null

_W, _IN = "__winner", "__incoming"


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], fn) -> DataFrame:
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    ordering = F.struct(*[F.col(c) for c in order])
    picked = df.groupBy(*keys).agg(fn(F.struct(*[F.col(c) for c in rest]), ordering).alias(_W))
    return picked.select(*keys, f"{_W}.*").select(*df.columns)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last arrival per key (whole row)."""
    return _pick(df, keys, order, F.max_by)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First arrival per key (whole row) — dedup keep-first, unlike ``dropDuplicates``."""
    return _pick(df, keys, order, F.min_by)


def last_wins_tagged(df: DataFrame, incoming: Column, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """REPLACE semantics over one frame that holds stored and incoming rows, told apart by the boolean
    ``incoming``: per key the last incoming row, else the (last) stored one. One exchange."""
    return _pick(df.withColumn(_IN, incoming), keys, [_IN, *order], F.max_by).drop(_IN)


def first_wins_tagged(df: DataFrame, incoming: Column, keys: Sequence[str], order: Sequence[str],
                      only_new: bool = False) -> DataFrame:
    """IGNORE semantics over one frame of stored and incoming rows: per key the (first) stored row, else
    the first incoming one; with ``only_new`` the rows to append. One exchange."""
    picked = _pick(df.withColumn(_IN, incoming), keys, [_IN, *order], F.min_by)
    return (picked.where(_IN) if only_new else picked).drop(_IN)


def _tagged(base: DataFrame, incoming: DataFrame, cols: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Base and incoming rows under one another with columns ``cols``, a tag and the order columns."""
    names = [f"__o_{c}" for c in order]
    stored = [(F.col(c) if c in base.columns else F.lit(None).cast(incoming.schema[c].dataType)).alias(n)
              for c, n in zip(order, names)]
    mine = [F.col(c) if c in base.columns else F.lit(None).cast(incoming.schema[c].dataType).alias(c) for c in cols]
    return base.select(*mine, *stored, F.lit(False).alias("__tag")).unionByName(
        incoming.select(*cols, *[F.col(c).alias(n) for c, n in zip(order, names)], F.lit(True).alias("__tag"))), names


def merge_last_wins(base: DataFrame, incoming: DataFrame, keys: Sequence[str],
                    order: Sequence[str]) -> DataFrame:
    """REPLACE semantics: ``base`` minus keys present in ``incoming`` ∪ incoming winners.

    The result is unique per key. Columns follow ``base``.
    """
    rows, names = _tagged(base, incoming, base.columns, order)
    return last_wins_tagged(rows, F.col("__tag"), keys, names).select(*base.columns)


def merge_first_wins(base_keys: DataFrame, incoming: DataFrame, keys: Sequence[str],
                     order: Sequence[str]) -> DataFrame:
    """IGNORE semantics: incoming first-arrivals whose key is not stored yet (rows to append)."""
    rows, names = _tagged(base_keys.select(*keys), incoming, incoming.columns, order)
    return first_wins_tagged(rows, F.col("__tag"), keys, names, only_new=True).select(*incoming.columns)


def normalise_nan(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NaN -> NULL in floating columns (stores treat NaN as missing)."""
    floats = [f.name for f in df.schema.fields
              if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and (cols is None or f.name in cols)]
    if not floats:
        return df
    return df.withColumns({c: nan_to_null(c) for c in floats})


def null_violation(cols: Sequence[str]):
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return cond


def guard_not_null(df: DataFrame, cols: Sequence[str], mode: str = "fail") -> DataFrame:
    """NOT NULL guard.

    ``fail``: raise before anything is written if any row violates (REPLACE tables);
    ``drop``: silently filter violating rows (IGNORE tables; count them via ``not_null_counts``).
    """
    bad = null_violation(cols)
    if mode == "drop":
        return df.where(~bad)
    if mode != "fail":
        raise ValueError(f"unknown mode {mode!r}")
    if df.where(bad).limit(1).count() > 0:
        raise ValueError(f"NOT NULL constraint failed: a row has NULL in one of {list(cols)}")
    return df


def assign_ids(df: DataFrame, start: int, id_col: str = "id", with_count: bool = False):
    """Dense, unique, increasing ids ``start, start+1, ...`` without a global sort.

    The frame is checkpointed first (reliable, in the shared checkpoint folder) so partition
    contents are fixed and a lost partition recomputes to the same ids. Each row gets its
    (partition, position-in-partition); per-partition row counts — one small row per
    partition, a proven bound — give each partition its offset, joined back by broadcast.
    """
    spark = df.sparkSession
    fixed = df.checkpoint(eager=True)
    pid = F.spark_partition_id()
    placed = fixed.select("*", pid.alias("__p"),
                          (F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)).alias("__i"))
    counts = sorted((r["__p"], r["count"]) for r in placed.groupBy("__p").count().collect())
    offsets, acc = [], start
    for p, n in counts:
        offsets.append((p, acc))
        acc += n
    table = spark.createDataFrame(offsets, "__p int, __o long")
    out = placed.join(F.broadcast(table), "__p").withColumn(id_col, (F.col("__o") + F.col("__i")).cast("long")) \
        .drop("__p", "__i", "__o")
    return (out, acc - start) if with_count else out
