"""Inclusive asset + time-window predicate shared by table readers and frame-level reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import ensure_utc

BIN_BITS = {"hour": 31, "day": 36, "month": 41}  # widest bins of totals: 2**bits microseconds, about half a grain or more


def bound(value, dtype: T.DataType):
    """A bound literal of the column's own type (timestamp or timestamp_ntz), read as UTC."""
    target = "timestamp_ntz" if isinstance(dtype, T.TimestampNTZType) else "timestamp"
    return F.lit(str(value)).cast(target)


def window_filter(df: DataFrame, start, end, asset: str | None = None,
                  ts_col: str = "timestamp", asset_col: str = "asset") -> DataFrame:
    """``asset = ? AND start <= ts <= end``; unknown asset or reversed bounds give no rows."""
    dtype = df.schema[ts_col].dataType
    pred = F.col(ts_col).between(bound(start, dtype), bound(end, dtype))
    if asset is not None:
        pred = pred & (F.col(asset_col) == F.lit(asset))
    return df.where(pred)


def read_windows(df: DataFrame, requests: DataFrame, ts_col: str = "timestamp", asset_col: str = "asset",
                 grain: str = "hour", totals: dict[str, tuple[str, str | None]] | None = None) -> DataFrame:
    """Rows of ``df`` for many windows at once: ``requests(request_id, asset, start, end)``, bounds inclusive, a NULL
    asset standing for every asset. One row per request and row inside it, with ``request_id`` in front. With ``totals``
    (see `_window_totals`) one row per request id with rows inside, without forming the pairs.

    An interval join by time bins: a request is exploded into the bins (``grain``: hour, day or month) that its
    window touches and that the rows span at all; rows have one bin each; bins meet by an equi-join on (asset,
    bin) - on the bin alone for requests of every asset - and the bounds are checked exactly afterwards. A row lies
    in one bin, so no pair comes up twice, and no pair outside common bins is ever formed. Windows with
    reversed or NULL bounds match nothing, as do rows without a time.
    """
    if totals is not None:
        return _window_totals(df, requests, ts_col, asset_col, grain, totals)
    width = {"hour": "1 hour", "day": "1 day", "month": "1 month"}[grain]
    dtype = df.schema[ts_col].dataType
    rows = df.withColumn("__bin", F.date_trunc(grain, F.col(ts_col)).cast(dtype)).where(F.col(ts_col).isNotNull())
    # the first and the last bin there are, as text: literals keep the plan free of a join with one row
    low, high = rows.agg(F.min("__bin").cast("string"), F.max("__bin").cast("string")).first()
    asked = requests.select(
        "request_id", F.col("asset").alias("__asset"), F.col("start").cast(dtype).alias("__start"), F.col("end").cast(dtype).alias("__end")) \
        .where("__start <= __end") \
        .withColumn("__first", F.greatest(F.date_trunc(grain, "__start").cast(dtype), F.lit(low).cast(dtype))) \
        .withColumn("__last", F.least(F.col("__end"), F.lit(high).cast(dtype))).where("__first <= __last") \
        .withColumn("__bin", F.explode(F.expr(f"sequence(__first, __last, interval {width})"))) \
        .drop("__first", "__last")
    inside = F.col(ts_col).between(F.col("__start"), F.col("__end"))
    one = rows.join(asked.where("__asset is not null"), (F.col(asset_col) == F.col("__asset")) & (rows["__bin"] == asked["__bin"])) \
        .where(inside).select("request_id", *df.columns)
    every = rows.join(asked.where("__asset is null"), rows["__bin"] == asked["__bin"]).where(inside).select("request_id", *df.columns)
    return one.unionByName(every)


def _window_totals(df: DataFrame, requests: DataFrame, ts_col: str, asset_col: str, grain: str,
                   totals: dict[str, tuple[str, str | None]]) -> DataFrame:
    """``request_id`` and the ``totals`` (name -> (count, min or max; column, None: rows)) of the rows in its windows.

    Time is cut into bins of 2**k microseconds, k by the window's length (at most ``BIN_BITS``), so that a window is the
    end of its first bin, whole bins, and the beginning of its last bin. Beginnings and ends are running totals over
    the rows of a bin in the order of time, read off where a bound stands among them; whole bins are joined with the
    totals of bins. Rows are sorted once per k in use: the work grows with rows and requests, not with their pairs.
    """
    ensure_utc(df.sparkSession)
    dtype = df.schema[ts_col].dataType
    micros = lambda c: F.unix_micros(F.col(c).cast(dtype).cast("timestamp"))
    combine = {name: {"count": F.sum, "min": F.min, "max": F.max}[fn] for name, (fn, _) in totals.items()}
    combine["__rows"] = F.sum
    one = {name: F.lit(1) if c is None else F.col(c).isNotNull().cast("long") if fn == "count" else F.col(c)
           for name, (fn, c) in totals.items()}
    values = [v.cast("long").alias(n) if combine[n] is F.sum else v.alias(n) for n, v in one.items()]
    rows = df.where(F.col(ts_col).isNotNull()).select(F.col(asset_col).alias("__asset"), micros(ts_col).alias("__at"), *values,
                                                      F.lit(1).cast("long").alias("__rows"))
    low, high = rows.agg(F.min("__at"), F.max("__at")).first()
    low, high = (0, -1) if low is None else (low, high)
    asked = requests.select(
        "request_id", F.col("asset").isNull().alias("__every"), F.coalesce(F.col("asset").cast("string"), F.lit("")).alias("__asset"),
        F.greatest(micros("start"), F.lit(low)).alias("__start"), F.least(micros("end"), F.lit(high)).alias("__end")) \
        .where(F.col("start").isNotNull() & F.col("end").isNotNull() & (F.col("__start") <= F.col("__end"))) \
        .withColumn("__k", F.least(F.length(F.bin(F.col("__end") - F.col("__start") + 1)) - 1, F.lit(BIN_BITS[grain]))) \
        .withColumn("__first", F.expr("shiftright(__start, __k)")).withColumn("__last", F.expr("shiftright(__end, __k)"))
    key = ["__every", "__asset", "__k", "__bin"]
    widths = {every: [] for every in (False, True)}
    for every, k in asked.select("__every", "__k").distinct().collect():  # at most 42 each
        widths[every].append(k)
    binned = lambda r, every: r.withColumn("__every", F.lit(every)) \
        .withColumn("__k", F.explode(F.array(*[F.lit(k) for k in sorted(widths[every])]).cast("array<int>"))) \
        .withColumn("__bin", F.expr("shiftright(__at, __k)"))
    named = rows.withColumn("__asset", F.col("__asset").cast("string")) \
        .join(asked.where(~F.col("__every")).select("__asset").distinct(), "__asset", "left_semi")
    placed = binned(named, False).unionByName(binned(rows.withColumn("__asset", F.lit("")), True))

    nothing = [F.lit(0).cast("long").alias(n) if f is F.sum else F.lit(None).cast(placed.schema[n].dataType).alias(n)
               for n, f in combine.items()]
    begins = asked.where("__first < __last")  # else the window is one whole bin, the beginning of itself
    bounds = asked.withColumn("__bin", F.col("__last")).withColumn("__at", F.col("__end")).withColumn("__kind", F.lit(1)).unionByName(
        begins.withColumn("__bin", F.col("__first")).withColumn("__at", F.col("__start")).withColumn("__kind", F.lit(2)))
    both = placed.select(*key, "__at", F.lit(0).alias("__kind"), F.lit(None).cast(asked.schema["request_id"].dataType).alias("request_id"),
                         *combine).unionByName(bounds.select(*key, "__at", "__kind", "request_id", *nothing))
    upto = Window.partitionBy(*key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before, behind = upto.orderBy("__at", "__kind"), upto.orderBy(F.desc("__at"), "__kind")  # rows at a bound are inside
    edges = both.select("request_id", "__kind", *[f(n).over(before).alias(f"__b_{n}") for n, f in combine.items()],
                        *[f(n).over(behind).alias(f"__e_{n}") for n, f in combine.items()]) \
        .where("__kind > 0").select("request_id", *[F.when(F.col("__kind") == 1, F.col(f"__b_{n}")).otherwise(F.col(f"__e_{n}")).alias(n)
                                                    for n in combine])
    whole = placed.groupBy(*key).agg(*[f(n).alias(n) for n, f in combine.items()])
    inner = begins.where("__first + 1 < __last").withColumn("__bin", F.explode(F.expr("sequence(__first + 1, __last - 1)"))) \
        .join(whole, key).select("request_id", *combine)
    return edges.unionByName(inner).groupBy("request_id").agg(*[f(n).alias(n) for n, f in combine.items()]) \
        .where("__rows > 0").drop("__rows")
