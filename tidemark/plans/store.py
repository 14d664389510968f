"""Keyed parquet tables: create, last-wins upsert, first-wins insert, windowed read.

Layout: price and market are partitioned by a grain of the key column ``timestamp`` (month by
default, or day) and sorted by (asset, timestamp) inside files, so a time window prunes
partitions and row groups. News is partitioned by asset, optionally by asset and a hash bucket
of the url (its key has no time in it).

Arrival order is stored with every row in columns that readers do not see (``ARRIVAL``): a merge
compares the arrival of a stored row with that of an incoming one, so the result does not
depend on which of two batches is handled first, nor on how files fall into micro-batches.

Publishing: a write puts whole new partition data (or added files) into a version folder that no other
run has or will have (its name ends in a random part), checks its row count, and then creates one
small pointer file that names, per partition, the versions that make up the table. Readers follow the
newest pointer, so they see the old table or the new one; a run lost before the pointer exists changes
nothing, and replaying the batch converges. Of two writers that began from one pointer the first to
publish wins; the other one's folder is removed and its write raises `WriterConflict` - or is done again
from the newer pointer (``retries``). Data that neither the newest nor the previous pointer names is
removed afterwards.
"""

from __future__ import annotations

import datetime as _dt
import json
import urllib.parse
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas as S
from tidemark.operators.merge import first_per_key, latest_per_key, normalise_nan, null_violation
from tidemark.operators.sizing import DEFAULT_BROADCAST_ROWS
from tidemark.plans import version_index
from tidemark.plans.staging import stage
from tidemark.session import ensure_utc, shared_dir

ORDER = ["batch_id", "ingest_ts", "seq"]
# landed payloads also carry a content hash between ingest time and position (total order)
LANDED_ORDER = ["batch_id", "ingest_ts", "payload_hash", "seq"]
# the same, as stored with every row (a frame without payload hash stores NULL)
ARRIVAL = {"batch_id": T.LongType(), "ingest_ts": T.TimestampType(), "payload_hash": T.LongType(), "seq": T.LongType()}
ARRIVAL_COLUMNS = [f"_{c}" for c in ARRIVAL]


class WriterConflict(RuntimeError):
    """Another writer has published since this write read the table."""


@dataclass
class WriteStats:
    table: str
    rows_in: int = 0
    rows_written: int = 0
    rows_ignored: int = 0
    rows_null_dropped: int = 0
    rows_deduped: int = 0
    rows_empty_url: int = 0
    partitions: list = field(default_factory=list)
    folders_stored: int = 0   # of an insert-or-ignore: version folders of the table, and those whose keys were read
    folders_read: int = 0


def ts_literal(value) -> Column:
    """A bound as a UTC instant literal; naive datetimes and text without offset are UTC."""
    if isinstance(value, Column):
        return value.cast("timestamp")
    if isinstance(value, _dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        value = value.isoformat(sep=" ")
    elif isinstance(value, _dt.date):
        value = value.isoformat() + " 00:00:00"
    return F.lit(str(value)).cast("timestamp")


def _spread(x: Column) -> Column:
    """The 16 bits of ``x`` with a zero after each."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return x


def interleaved(df: DataFrame) -> DataFrame:
    """``df`` with ``__z``: the bits of the asset's rank and of the hour, in turns, each scaled to 16 bits. Ranks come
    from the distinct assets, a table of one small row each."""
    assets = df.select("asset").distinct()
    hour = F.floor(F.unix_timestamp("timestamp") / 3600)
    first, last, n = df.agg(F.min(hour), F.max(hour), F.count_distinct("asset")).first()
    if not n:
        return df.withColumn("__z", F.lit(0).cast("long"))
    ranks = assets.select("asset", (F.row_number().over(Window.orderBy("asset")) - 1).alias("__rank"))
    by_asset = F.floor(F.col("__rank") * 65536 / n)
    by_hour = F.floor((hour - first) * 65536 / (last - first + 1))
    z = F.shiftleft(_spread(by_asset.cast("long")), 1).bitwiseOR(_spread(by_hour.cast("long")))
    return df.join(ranks, "asset").withColumn("__z", z).select(*df.columns, "__z")


class TableStore:
    """Keyed tables under one root folder.

    ``time_grain`` ("month" or "day") is the partition grain of the time-keyed tables when they
    are created; a table's layout is recorded beside it, and an existing table keeps its own.
    ``retries``: how often a write starts over when another writer published first.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, time_grain: str = "month",
                 key_buckets: int = 1, retries: int = 3):
        self.spark = spark
        self.retries = retries
        ensure_utc(spark)
        if root is None:
            base = shared_dir(spark)
            root = base.rstrip("/") + "/tidemark-store"
        self.root = root.rstrip("/")
        if time_grain not in S.TIME_GRAINS:
            raise ValueError(f"time_grain must be one of {sorted(S.TIME_GRAINS)}")
        self.time_grain = time_grain
        self.key_buckets = int(key_buckets)
        self._layouts: dict[str, S.TableSpec] = {}

    # -- layout -----------------------------------------------------------------------
    def spec(self, spec: S.TableSpec) -> S.TableSpec:
        """This store's layout of ``spec``: the recorded layout if the table exists."""
        if spec.name not in self._layouts:
            recorded = self._read_meta(self._layout_path(spec))
            if spec.time_grain is not None:
                self._layouts[spec.name] = spec.at_grain(recorded or self.time_grain)
            else:
                buckets = int(recorded.split("=")[1]) if recorded else self.key_buckets
                self._layouts[spec.name] = spec.with_key_buckets(buckets)
        return self._layouts[spec.name]

    def _layout_text(self, spec: S.TableSpec) -> str:
        spec = self.spec(spec)
        return spec.time_grain if spec.time_grain is not None else f"buckets={spec.key_buckets}"

    def _layout_path(self, spec: S.TableSpec) -> str:
        return f"{self.root}/_meta/{spec.name}_layout"

    # -- paths ------------------------------------------------------------------------
    def path(self, spec: S.TableSpec) -> str:
        return f"{self.root}/{spec.name}"

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def exists(self, spec: S.TableSpec) -> bool:
        return self._newest(spec) is not None

    def storage_schema(self, spec: S.TableSpec) -> T.StructType:
        spec = self.spec(spec)
        arrival = [T.StructField(f"_{c}", t) for c, t in ARRIVAL.items()]
        return T.StructType(list(spec.schema.fields) + arrival + [T.StructField(spec.partition_col, T.StringType())])

    # -- pointers ---------------------------------------------------------------------
    def _pointer_dir(self, spec: S.TableSpec) -> str:
        return f"{self.root}/_meta/{spec.name}"

    def _newest(self, spec: S.TableSpec, before: int | None = None) -> int | None:
        """Number of the newest pointer (below ``before``)."""
        fs, p = self._fs(self._pointer_dir(spec))
        if not fs.exists(p):
            return None
        names = [st.getPath().getName() for st in fs.listStatus(p)]
        numbers = [int(n[len("current-"):]) for n in names if n.startswith("current-")]
        return max((n for n in numbers if before is None or n < before), default=None)

    def _pointer(self, spec: S.TableSpec, number: int | None = None) -> dict:
        """``{"version", "next_id", "parts": {partition folder: [versions]}}``; a missing table raises."""
        number = self._newest(spec) if number is None else number
        if number is None:
            raise FileNotFoundError(f"table {spec.name} does not exist under {self.root}")
        return json.loads(self._read_meta(f"{self._pointer_dir(spec)}/current-{number:09d}"))

    def _switch(self, spec: S.TableSpec, pointer: dict) -> None:
        """Make ``pointer`` the newest one: written beside, then renamed to a name of its own."""
        folder = self._pointer_dir(spec)
        fs, tmp = self._fs(f"{folder}/.tmp-{uuid.uuid4().hex}")
        self._write_bytes(fs, tmp, json.dumps(pointer))
        _, final = self._fs(f"{folder}/current-{pointer['version']:09d}")
        if fs.exists(final) or not fs.rename(tmp, final):
            fs.delete(tmp, False)
            raise WriterConflict(f"another writer has published version {pointer['version']} of {spec.name}")

    def _clean(self, spec: S.TableSpec, version: int) -> None:
        """Remove old pointers and the data that only they name."""
        previous = self._newest(spec, before=version)
        old = self._newest(spec, before=previous) if previous is not None else None
        if old is None:
            return
        live = {(d, v) for n in (version, previous) for d, vs in self._pointer(spec, n)["parts"].items() for v in vs}
        while old is not None:
            for d, versions in self._pointer(spec, old)["parts"].items():
                for v in versions:
                    if (d, v) not in live:
                        fs, p = self._fs(f"{self._version_path(spec, v)}/{d}")
                        fs.delete(p, True)
            fs, p = self._fs(f"{self._pointer_dir(spec)}/current-{old:09d}")
            fs.delete(p, False)
            old = self._newest(spec, before=old)
        version_index.forget(self, spec, {v for _, v in live}, previous)

    def _version_path(self, spec: S.TableSpec, version: str) -> str:
        return f"{self.path(spec)}/v={version}"

    # -- K4: create -------------------------------------------------------------------
    def create_tables(self, specs=(S.PRICE, S.MARKET, S.NEWS)) -> None:
        """Create missing tables (and the quarantine); existing ones are left untouched."""
        for spec in specs:
            if not self.exists(spec):
                for path in (self.path(spec), self._pointer_dir(spec)):
                    fs, p = self._fs(path)
                    fs.mkdirs(p)
                self._write_meta(self._layout_path(spec), self._layout_text(spec))
                self._switch(spec, {"version": 0, "next_id": 1, "parts": {}})
        fs, p = self._fs(self.quarantine_path())
        fs.mkdirs(p)

    # -- scans ------------------------------------------------------------------------
    def _stored(self, spec: S.TableSpec, pointer: dict | None = None) -> DataFrame:
        """All stored rows with arrival and partition columns."""
        pointer = pointer or self._pointer(spec)
        schema = self.storage_schema(spec)
        paths = [f"{self._version_path(spec, v)}/{d}" for d, versions in pointer["parts"].items() for v in versions]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path(spec)).parquet(*paths) \
            .select(*schema.fieldNames())

    def read(self, spec: S.TableSpec) -> DataFrame:
        """Full table incl. the partition column. A missing table raises (no silent create)."""
        spec = self.spec(spec)
        return self._stored(spec).select(*spec.columns, spec.partition_col)

    def read_window(self, spec: S.TableSpec, start, end, asset: str | None = None) -> DataFrame:
        """Rows with ``start <= timestamp <= end`` (UTC, inclusive), optionally one asset.

        Adds the partition predicate that follows from the time range, which Spark does not
        derive from a timestamp filter by itself; filters reach the parquet scan.
        """
        spec = self.spec(spec)
        s, e = ts_literal(start), ts_literal(end)
        df = self.read(spec)
        pred = F.col("timestamp").between(s, e)
        if spec.time_grain is not None:
            fmt = S.TIME_GRAINS[spec.time_grain]
            pred = pred & F.col(spec.partition_col).between(F.date_format(s, fmt), F.date_format(e, fmt))
        if asset is not None:
            pred = pred & (F.col("asset") == F.lit(asset))
            if spec.partition_col == "asset_part":
                part = F.col("asset_part")
                pred = pred & (part.startswith(F.lit(asset + "#")) if spec.key_buckets > 1
                               else part == F.lit(asset))
        return df.where(pred).select(*spec.columns)

    def batch_stats(self, spec: S.TableSpec) -> DataFrame:
        """Rows, first and last time per asset of the stored table, from statistics kept per version folder: only
        partitions written since the last call are read."""
        states = version_index.derived(self, spec, self._pointer(spec), "stats")
        if states is None:
            states = version_index.batch_states(self._stored(self.spec(spec)).withColumn("v", F.lit("")), self.spec(spec))
        return states.groupBy("asset").agg(F.sum("n").alias("n"), F.min("first_hour").alias("first_hour"),
                                           F.max("last_hour").alias("last_hour"))

    # -- quarantine and compaction ----------------------------------------------------
    def quarantine_path(self) -> str:
        return f"{self.root}/_quarantine"

    def write_quarantine(self, rows: DataFrame) -> None:
        """Add rejected payloads (source, asset, batch_id, ingest_ts, reason, raw) that are not kept yet: handling a
        landing again leaves the quarantine as it is. A payload is known by a digest of all its columns, stored
        with it; of the kept ones only the digests of the batches in question are read, and no raw text is shuffled."""
        cols = S.QUARANTINE_SCHEMA.fieldNames()
        fs, p = self._fs(self.quarantine_path())
        fs.mkdirs(p)
        # lengths before the values, so that no two rows give one text; -1 for null
        text = F.concat(*[x for c in cols for x in (F.coalesce(F.length(F.col(c).cast("string")), F.lit(-1)).cast("string"), F.lit(":"),
                                                    F.coalesce(F.col(c).cast("string"), F.lit("")))])
        # written once: the append must not change what its own plan reads
        st = stage(rows.select(*cols, F.sha2(text, 256).alias("_digest")), "quarantine",
                   {"n": F.count(F.lit(1)), "low": F.min("batch_id"), "high": F.max("batch_id"),
                    "sources": F.collect_set("source"), "unnumbered": F.count_if(F.col("batch_id").isNull())})
        try:
            if st.metrics["n"]:
                low, high = st.metrics["low"], st.metrics["high"]
                batches = F.lit(False) if low is None else F.col("batch_id").between(low, high)
                if st.metrics["unnumbered"]:
                    batches = batches | F.col("batch_id").isNull()
                old = self._quarantined().where(F.col("source").isin(list(st.metrics["sources"])) & batches)
                place = F.struct(F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
                placed = st.df.withColumn("__at", place)
                first = placed.groupBy("_digest").agg(F.min("__at").alias("__at")) \
                    .join(old.select("_digest"), "_digest", "left_anti")
                new = placed.join(self._keys_side(first.select("__at"), st.metrics["n"], 128 * st.metrics["n"]), "__at", "left_semi")
                new.drop("__at").sortWithinPartitions("batch_id").write.mode("append").option("compression", "zstd") \
                    .partitionBy("source").parquet(self.quarantine_path())
        finally:
            st.drop()

    def _quarantined(self) -> DataFrame:
        schema = T.StructType([*S.QUARANTINE_SCHEMA.fields, T.StructField("_digest", T.StringType())])
        return self.spark.read.schema(schema).parquet(self.quarantine_path())

    def read_quarantine(self) -> DataFrame:
        return self._quarantined().select(*S.QUARANTINE_SCHEMA.fieldNames())

    def compact(self, spec: S.TableSpec, partitions=None, files: int | None = None, interleave: bool = False) -> list:
        """Rewrite partitions (all, or the given values) into fewer files, each a range of the sort
        order, so that a one-asset read opens a minority of them. Rows, ids and keys are
        unchanged; published like any write. Returns the rewritten partition values.

        ``files``: about how many files to write (default: as adaptive execution cuts them). With ``interleave``
        files are ranges of the interleaved bits of asset rank and hour, so that a read of one asset and a
        read of a short time each open a part of a partition's files, about its square root."""
        spec = self.spec(spec)
        pointer = self._pointer(spec)
        df = self._stored(spec, pointer)
        if partitions is not None:
            df = df.where(F.col(spec.partition_col).isin(list(partitions)))
        order = [F.col(c) for c in (spec.partition_col, *spec.sort_cols)]
        if interleave:
            if not {"asset", "timestamp"} <= set(spec.columns):
                raise ValueError(f"{spec.name} has no asset and time to interleave")
            df, order = interleaved(df), [F.col(spec.partition_col), F.col("__z")]
        ranged = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
        return self._publish(spec, pointer, ranged, replace=True)[1]

    # -- statistics from footers ------------------------------------------------------
    def _footer_frame(self, spec: S.TableSpec) -> DataFrame | None:
        """The aggregate behind `footer_stats`, in a session of its own whose parquet scans take aggregates (the
        settings of this store's session stay as they are). None: the table has no folder."""
        spec = self.spec(spec)
        pointer = self._pointer(spec)
        paths = [f"{self._version_path(spec, v)}/{d}" for d, versions in pointer["parts"].items() for v in versions]
        if not paths:
            return None
        own = self.spark.newSession()
        ensure_utc(own)
        v1 = [x for x in own.conf.get("spark.sql.sources.useV1SourceList").split(",") if x != "parquet"]
        own.conf.set("spark.sql.sources.useV1SourceList", ",".join(v1))
        own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        # the scan takes an aggregate only by all its partition columns: the version is one
        schema = T.StructType([T.StructField("v", T.StringType()), *self.storage_schema(spec).fields])
        rows = own.read.schema(schema).option("basePath", self.path(spec)).parquet(*paths)
        counts = [F.count(c).alias(f"__n_{c}") for c in spec.columns]
        # lowest and highest only where every row has a value: a footer of nulls alone has neither
        ends = [f(c).alias(f"{name}_{c}") for c in spec.not_null if isinstance(spec.schema[c].dataType, (T.DoubleType, T.LongType))
                for f, name in ((F.min, "min"), (F.max, "max"))]
        return rows.groupBy("v", spec.partition_col).agg(F.count(F.lit(1)).alias("n"), *counts, *ends)

    def footer_stats(self, spec: S.TableSpec) -> DataFrame:
        """Per partition: rows, nulls per column (``null_<column>``), lowest and highest value of the numeric NOT NULL
        columns, all from parquet footers; no row is read. (Times and texts have no such statistics:
        `batch_stats` keeps theirs.) One small row per partition, staged."""
        spec = self.spec(spec)
        frame = self._footer_frame(spec)
        part = spec.partition_col
        if frame is None:
            empty = [f"{part} string", "n long", *[f"null_{c} long" for c in spec.columns]]
            return self.spark.createDataFrame([], ", ".join(empty))
        ends = [(F.min if c.startswith("min_") else F.max)(c).alias(c) for c in frame.columns if c.startswith(("min_", "max_"))]
        out = frame.groupBy(part).agg(F.sum("n").alias("n"), *[(F.sum("n") - F.sum(f"__n_{c}")).alias(f"null_{c}") for c in spec.columns], *ends)
        return self.spark.read.schema(out.schema).parquet(stage(out, f"{spec.name}-footers").path)

    # -- writes -----------------------------------------------------------------------
    def _prepare(self, spec: S.TableSpec, incoming: DataFrame, order) -> DataFrame:
        """Typed table columns and the arrival columns."""
        cols = [c for c in spec.columns if c != "id"]
        missing = [c for c in cols + list(order) if c not in incoming.columns]
        if missing:
            raise ValueError(S.MISSING_COLUMNS_MESSAGE.format(missing))
        arrival = [(F.col(c) if c in order else F.lit(None)).cast(t).alias(f"_{c}") for c, t in ARRIVAL.items()]
        return normalise_nan(incoming.select(*[F.col(c).cast(spec.schema[c].dataType) for c in cols], *arrival))

    def _publish(self, spec: S.TableSpec, pointer: dict, df: DataFrame, replace: bool, next_id: int | None = None,
                 metrics: dict[str, Column] | None = None, expected: dict[str, int] | None = None) -> tuple[dict, list]:
        """Write ``df`` as the next version and switch to it: its partitions replace the stored ones, or
        add to them. Returns (observed metrics, partition values written). Metrics that differ from the ``expected``
        ones stop the write before anything is published."""
        version, part = pointer["version"] + 1, spec.partition_col
        name = f"{version}-{uuid.uuid4().hex[:12]}"
        target = self._version_path(spec, name)
        fs, p = self._fs(target)
        obs = Observation(f"{spec.name}-{uuid.uuid4().hex[:8]}")
        counted = df.observe(obs, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in (metrics or {}).items()])
        counted.select(*self.storage_schema(spec).fieldNames()).sortWithinPartitions(part, *spec.sort_cols) \
            .write.mode("errorifexists").option("compression", "zstd").partitionBy(part).parquet(target)
        got = dict(obs.get)
        written = self.spark.read.schema(self.storage_schema(spec)).parquet(target).count() if got["rows"] else 0
        if written != got["rows"]:
            raise RuntimeError(f"{spec.name}: {got['rows']} rows to write, {written} found; not published")
        for k, n in (expected or {}).items():
            if (got[k] or 0) != n:
                raise RuntimeError(f"{spec.name}: {n} {k} rows were decided on, {got[k] or 0} came; not published")
        folders = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory() and "=" in st.getPath().getName()]
        parts = dict(pointer["parts"])
        for d in folders:
            parts[d] = [name] if replace else [*parts.get(d, []), name]
        try:
            self._switch(spec, {"version": version, "next_id": next_id or pointer["next_id"], "parts": parts})
        except WriterConflict:
            fs.delete(p, True)  # of this run alone
            raise
        self._clean(spec, version)
        return got, sorted(urllib.parse.unquote(d.split("=", 1)[1]) for d in folders)

    def _winners(self, spec, inc, bad, more):
        """Per-key winners staged as parquet, in one pass over the batch: counts of the batch are observed
        before the reduction, counts and key bytes of the winners on the write. A last-wins table's winners are whole
        rows; of a first-wins table only key, arrival and size are staged, the rows are taken up when it is known
        which of them the table gets."""
        obs = Observation(f"{spec.name}-in-{uuid.uuid4().hex[:8]}")
        seen = inc.observe(obs, F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("bad"), *more)
        if spec.conflict == "ignore":
            first = F.min(F.struct(*ARRIVAL_COLUMNS, self._row_bytes(spec).alias("__bytes"))).alias("__first")
            winners = seen.where(~bad).groupBy(*spec.key).agg(first).select(*spec.key, "__first.*")
        else:
            winners = latest_per_key(seen, spec.key, ARRIVAL_COLUMNS).select(*spec.columns_no_id, *ARRIVAL_COLUMNS)
        winners = winners.withColumn(spec.partition_col, F.expr(spec.partition_expr))
        st = stage(winners, spec.name, {"n": F.count(F.lit(1)), "key_bytes": F.coalesce(F.sum(self._key_bytes(spec)), F.lit(0))})
        return st, dict(obs.get), st.metrics["n"], int(st.metrics["key_bytes"])

    @staticmethod
    def _key_bytes(spec: S.TableSpec) -> Column:
        return sum((F.coalesce(F.octet_length(c), F.lit(0)) if isinstance(spec.schema[c].dataType, T.StringType)
                    else F.lit(8)) + F.lit(16) for c in spec.key)

    @staticmethod
    def _row_bytes(spec: S.TableSpec) -> Column:
        """About the bytes of a row: its texts, and 8 for every column."""
        texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c in spec.columns_no_id if isinstance(spec.schema[c].dataType, T.StringType)]
        return sum(texts, F.lit(8 * len(spec.columns))).cast("long")

    def _is_small(self, n: int, key_bytes: int) -> bool:
        return n <= self.broadcast_rows and key_bytes <= self.broadcast_bytes

    def _keys_side(self, df: DataFrame, n: int, key_bytes: int) -> DataFrame:
        """Broadcast a key side only under a proven bound: at most ``broadcast_rows`` keys and
        ``broadcast_bytes`` of key data (measured exactly on the staged winners)."""
        return F.broadcast(df) if self._is_small(n, key_bytes) else df

    broadcast_rows = DEFAULT_BROADCAST_ROWS
    broadcast_bytes = 64 << 20
    cut_bytes = 64 << 20   # of rows (`_row_bytes`) that an insert-or-ignore deals into one group, and so one file, about

    def _touched(self, spec: S.TableSpec, stored: DataFrame, winners: DataFrame) -> DataFrame:
        """Stored rows of the partitions that the winners fall into: by literals for months and days
        (bounded by the batch's time span), by a semi join that prunes dynamically otherwise. The values name folders,
        which the pointer lists anyway: they are broadcast, however long the staged winners are."""
        values = winners.select(spec.partition_col).distinct()
        if spec.time_grain is not None:
            return stored.where(F.col(spec.partition_col).isin([r[0] for r in values.collect()]))
        return stored.join(F.broadcast(values), spec.partition_col, "left_semi")

    def _met(self, spec: S.TableSpec, base: DataFrame, winners: DataFrame, n: int, key_bytes: int,
             *columns: Column) -> DataFrame:
        """Keys (and ``columns``) of the stored rows whose key the batch has, with ``__late``: whether the
        stored row arrived after the incoming one. At most ``n`` rows."""
        arrival = F.struct(*ARRIVAL_COLUMNS)
        keys = winners.select(*spec.key, arrival.alias("__w"))
        return base.select(*spec.key, *columns, arrival.alias("__s")) \
            .join(self._keys_side(keys, n, key_bytes), spec.key) \
            .withColumn("__late", F.col("__s") > F.col("__w")).drop("__s", "__w")

    def _maybe_stored(self, spec: S.TableSpec, pointer: dict, winners: DataFrame):
        """(staged keys and arrival of the winners that may be stored, pointer to the folders they may be in), by the
        key bitmaps of the version folders: other folders and other keys take no further part. An empty
        partition value has no folder name of its own, so its keys and folder are never ruled out."""
        columns, part = [*spec.key, *ARRIVAL_COLUMNS], spec.partition_col
        bitmaps = version_index.derived(self, spec, pointer, "keys")
        unnamed = winners.where(F.coalesce(F.col(part), F.lit("")) == "").select(*columns, part, F.lit(None).cast("string").alias("v"))
        asked = winners.select(*columns, part)
        hits = unnamed if bitmaps is None else version_index.may_hold(asked, bitmaps, spec).unionByName(unnamed)
        st = stage(hits, f"{spec.name}-maybe")
        seen = {tuple(r) for r in st.df.where("v is not null").select("v", part).distinct().collect()}  # folders of the pointer
        parts = {}
        for d, versions in pointer["parts"].items():
            value = urllib.parse.unquote(d.split("=", 1)[1])
            held = [v for v in versions if (v, value) in seen or value == "__HIVE_DEFAULT_PARTITION__"]
            if held:
                parts[d] = held
        return st, {**pointer, "parts": parts}

    def _until_published(self, write):
        """Run ``write``, again from the newest pointer if another writer was first, at most ``retries`` times."""
        for attempt in range(self.retries + 1):
            try:
                return write()
            except WriterConflict:
                if attempt == self.retries:
                    raise

    def upsert(self, spec: S.TableSpec, incoming: DataFrame, order=ORDER) -> WriteStats:
        """`_upsert`, done again if another writer was first: the merge is by stored arrival order, so the
        result is the same whichever of them publishes first."""
        return self._until_published(lambda: self._upsert(spec, incoming, order))

    def insert_ignore(self, spec: S.TableSpec, incoming: DataFrame, order=ORDER) -> WriteStats:
        """`_insert_ignore`, done again if another writer was first."""
        return self._until_published(lambda: self._insert_ignore(spec, incoming, order))

    def _upsert(self, spec: S.TableSpec, incoming: DataFrame, order=ORDER) -> WriteStats:
        """REPLACE: last arrival per key wins (whole row), within the batch and against stored rows; a
        NULL in a NOT NULL column fails the batch before anything is published; an empty batch
        is a no-op. ``rows_ignored`` counts keys whose stored row arrived later."""
        spec = self.spec(spec)
        stats = WriteStats(spec.name)
        pointer = self._pointer(spec)
        st, c, n, key_bytes = self._winners(spec, self._prepare(spec, incoming, order), null_violation(spec.not_null), [])
        try:
            stats.rows_in = c["n"]
            if stats.rows_in == 0:
                return stats
            if c["bad"]:
                raise ValueError(f"NOT NULL constraint failed: {c['bad']} row(s) with NULL in one of "
                                 f"{spec.not_null}; batch not written")
            winners = st.df
            base = self._touched(spec, self._stored(spec, pointer), winners)
            late = self._met(spec, base, winners, n, key_bytes).where("__late").select(*spec.key)
            # one pass over the stored keys settles the usual case, that nothing stored arrived later
            fresh = winners if late.isEmpty() else winners.join(self._keys_side(late, n, key_bytes), spec.key, "left_anti")
            kept = base.join(self._keys_side(fresh.select(*spec.key), n, key_bytes), spec.key, "left_anti")
            merged = kept.withColumn("__new", F.lit(0)).unionByName(fresh.withColumn("__new", F.lit(1)))
            got, stats.partitions = self._publish(spec, pointer, merged.hint("rebalance", spec.partition_col), True,
                                                  metrics={"new": F.sum("__new")})
        finally:
            st.drop()
        stats.rows_written = got["new"]
        stats.rows_ignored, stats.rows_deduped = n - got["new"], stats.rows_in - n
        return stats

    def _insert_ignore(self, spec: S.TableSpec, incoming: DataFrame, order=ORDER) -> WriteStats:
        """IGNORE: first arrival per key wins within the batch and against stored rows (a row that arrived
        before the stored one takes its place and id); rows with NULL in a NOT NULL column are
        skipped and counted; new keys get increasing ids. Keys and arrivals alone decide; the batch is read again
        for the rows that the table gets, whose texts are shuffled once (`_taken`) and written once. Stored rows that are
        written again stay in the tasks that read them.
        A batch that does not give the same rows when it is read again is not published."""
        spec = self.spec(spec)
        stats = WriteStats(spec.name)
        pointer = self._pointer(spec)
        bad = null_violation([c for c in spec.not_null if c != "id"])
        empty_url = F.count_if(F.col("url") == F.lit("")) if "url" in spec.columns else F.count_if(F.lit(False))
        inc = self._prepare(spec, incoming, order)
        st, c, n, key_bytes = self._winners(spec, inc, bad, [empty_url.alias("empty_url")])
        decided = maybe = None
        try:
            stats.rows_in, stats.rows_null_dropped, stats.rows_empty_url = c["n"], c["bad"], c["empty_url"]
            stats.rows_deduped = stats.rows_in - stats.rows_null_dropped - n
            if n == 0:
                return stats
            winners = st.df
            base = self._touched(spec, self._stored(spec, pointer), winners)
            held = pointer
            if pointer["parts"]:
                maybe, held = self._maybe_stored(spec, pointer, winners)
            stats.folders_stored, stats.folders_read = (sum(map(len, p["parts"].values())) for p in (pointer, held))
            # the stored keys that the batch also has: at most n
            asked = winners if maybe is None else maybe.df.dropDuplicates(spec.key)
            known = self._met(spec, self._stored(spec, held), asked, n, key_bytes, F.col("id").alias("__sid"))
            stored = F.col("__sid").isNotNull()
            decided = stage(winners.join(self._keys_side(known, n, key_bytes), spec.key, "left")
                            .where("__sid is null or __late"), f"{spec.name}-decided",
                            {"new": F.count_if(~stored), "older": F.count_if(stored),
                             "older_bytes": F.coalesce(F.sum(F.when(stored, self._key_bytes(spec))), F.lit(0))})
            new, older = decided.metrics["new"], decided.metrics["older"]
            stats.rows_written, stats.rows_ignored = new + older, n - new - older
            if new + older:
                rows = self._taken(spec, inc.where(~bad), decided.df, pointer["next_id"], new + older).withColumn("__taken", F.lit(1))
                if older:
                    changed, size = decided.df.where(stored).select(*spec.key), int(decided.metrics["older_bytes"])
                    kept = base.join(self._keys_side(changed, older, size), spec.key, "left_anti").withColumn("__taken", F.lit(0))
                    if not self._is_small(older, size):
                        kept = kept.hint("rebalance", spec.partition_col)  # the join has dealt them by key
                    rows = kept.unionByName(rows)
                _, stats.partitions = self._publish(spec, pointer, rows, bool(older), next_id=pointer["next_id"] + new,
                                                    metrics={"taken": F.sum("__taken")}, expected={"taken": new + older})
        finally:
            for staged in (st, maybe, decided):
                if staged is not None:
                    staged.drop()
        return stats

    def _taken(self, spec: S.TableSpec, rows: DataFrame, decided: DataFrame, next_id: int, n: int) -> DataFrame:
        """The whole rows that the ``n`` keys and arrivals of ``decided`` (staged) name, with ids and partition. Most others
        are left out before the shuffle, by a bitmap of keys and arrivals; if that would be too large to broadcast, one row
        per key is, by one more shuffle. Rows and ids are then dealt together by partition and, in partitions of more than
        ``cut_bytes``, by parts of them, which is also how they are written."""
        part, known = spec.partition_col, [*spec.key, *ARRIVAL_COLUMNS]
        if 2 ** version_index.bits_for(n) // 8 <= self.broadcast_bytes:
            rows = version_index.perhaps_among(rows, decided, known, n)
        else:
            rows = first_per_key(rows, spec.key, ARRIVAL_COLUMNS)
        # one small row per partition that gets rows
        cuts = decided.groupBy(part).agg(F.ceil(F.sum("__bytes") / self.cut_bytes).alias("__cuts"))
        body = F.struct(*[c for c in rows.columns if c not in spec.key])
        texts = rows.withColumn(part, F.expr(spec.partition_expr)).select(*spec.key, part, body.alias("__row"), F.lit(None).cast("long").alias("id"))
        ids = self._with_ids(decided, next_id).select(*spec.key, part, "id", F.struct(*ARRIVAL_COLUMNS).alias("__won"))
        dealt = texts.unionByName(ids, allowMissingColumns=True).join(F.broadcast(cuts), part) \
            .withColumn("__cut", F.pmod(F.xxhash64(*spec.key), "__cuts")).drop("__cuts").repartition(part, "__cut")
        arrival = F.struct(*[F.col(f"__row.{c}").alias(c) for c in ARRIVAL_COLUMNS])
        first = F.min_by("__row", F.when(F.col("__row").isNotNull(), arrival))  # a row of ids has none and is passed over
        picked = dealt.groupBy(part, "__cut", *spec.key).agg(first.alias("__row"), F.max("id").alias("id"), F.max("__won").alias("__won"))
        return picked.where(F.col("id").isNotNull() & F.col("__row").isNotNull() & (arrival == F.col("__won"))) \
            .select(*spec.key, "__row.*", "id", part)

    # -- K7: surrogate ids ------------------------------------------------------------
    def _with_ids(self, rows: DataFrame, start: int) -> DataFrame:
        """Ids for staged rows without a stored one: by file and place in the file, from ``start`` on;
        unique and increasing over batches, without gaps."""
        fresh = F.col("__sid").isNull()
        by_file = Window.partitionBy("__file").orderBy("__row")
        placed = rows.select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row"))
        counts = sorted((r[0], r[1]) for r in placed.where(fresh).groupBy("__file").count().collect())  # one row per file
        offsets, at = [], start
        for file, n in counts:
            offsets.append((file, at))
            at += n
        table = self.spark.createDataFrame(offsets, "__file string, __first long")
        nth = F.sum(fresh.cast("long")).over(by_file) - 1
        return placed.join(F.broadcast(table), "__file", "left") \
            .withColumn("id", F.coalesce("__sid", F.col("__first") + nth)).drop("__file", "__row", "__first")

    # -- small files ------------------------------------------------------------------
    def _read_meta(self, path: str) -> str | None:
        fs, p = self._fs(path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _write_bytes(self, fs, p, value: str) -> None:
        out = fs.create(p, True)
        try:
            out.write(bytearray(value, "utf-8"))
        finally:
            out.close()

    def _write_meta(self, path: str, value: str) -> None:
        """A table's layout, written once when the table is created."""
        fs, p = self._fs(path)
        self._write_bytes(fs, p, value)
