"""What is kept beside a table about each of its version folders: key bitmaps and batch statistics.

A version folder never changes once it is published, so what is derived from it is derived once, by the first
reader that wants it, and holds as long as the folder is part of the table. A derived table becomes
visible by a marker file per version, written after the job has committed; a run lost before
that leaves nothing that is read. Folders that several runs derive at the same time are derived
twice and read once.
"""

from __future__ import annotations

import urllib.parse
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas as S

BUCKET = 32768      # bits of one bitmap, as `bitmap_construct_agg` makes them
BITS_PER_KEY = 16   # an absent key meets a set bit in fewer than one of 16 look-ups
SEP = "--"


def _position(bits: Column) -> tuple[Column, Column]:
    """(bitmap, bit in it) of the key hash ``__h`` among 2**bits positions."""
    at = F.col("__h").bitwiseAND(F.expr("shiftleft(1L, bits) - 1"))
    return F.shiftright(at, 15).alias("bucket"), at.bitwiseAND(F.lit(BUCKET - 1)).alias("bit")


def key_bitmaps(rows: DataFrame, spec: S.TableSpec) -> DataFrame:
    """Per version and partition a bit set of its key hashes, in bitmaps of ``BUCKET`` bits, sized by the keys there.
    Combined before the shuffle: a partition with most keys leaves one bitmap per task and bucket."""
    at = ["v", spec.partition_col]
    keys = rows.select(*at, F.xxhash64(*spec.key).alias("__h"))
    sizes = keys.groupBy(*at).agg(F.greatest(F.lit(15), F.ceil(F.log2(F.count(F.lit(1)) * BITS_PER_KEY))).cast("int").alias("bits"))
    # one small row per folder of the versions, which the pointer lists by name anyway
    placed = keys.join(F.broadcast(sizes), at).select(*at, "bits", *_position(F.col("bits")))
    return placed.groupBy(*at, "bits", "bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def may_hold(asked: DataFrame, bitmaps: DataFrame, spec: S.TableSpec) -> DataFrame:
    """The rows of ``asked`` (key and partition columns) with each version ``v`` of their partition whose bitmaps have
    their key's bit. What is left out is certainly not stored."""
    at = ["v", spec.partition_col]
    sizes = bitmaps.select(*at, "bits").distinct()
    placed = asked.withColumn("__h", F.xxhash64(*spec.key)).join(F.broadcast(sizes), spec.partition_col) \
        .select(*asked.columns, "v", *_position(F.col("bits")))
    return placed.join(bitmaps.select(*at, "bucket", "bitmap"), [*at, "bucket"]).where(_is_set()).select(*asked.columns, "v")


def _is_set() -> Column:
    """Whether ``bitmap`` has the bit ``bit``."""
    byte = F.conv(F.hex(F.expr("substring(bitmap, cast(bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    return F.call_function("shiftright", byte, F.pmod("bit", F.lit(8)).cast("int")).bitwiseAND(F.lit(1)) == 1


def bits_for(n: int) -> int:
    """Bits that number the positions of a bitmap of ``n`` keys."""
    return max(15, (n * BITS_PER_KEY - 1).bit_length())


def perhaps_among(rows: DataFrame, wanted: DataFrame, columns: list[str], n: int) -> DataFrame:
    """The rows of ``rows`` whose ``columns`` may be those of one of the ``n`` rows of ``wanted``, by one bitmap that is
    broadcast (2 ** ``bits_for(n)`` / 8 bytes). What is left out certainly is not; no row is shuffled."""
    hashed, bits = F.xxhash64(*columns).alias("__h"), F.lit(bits_for(n)).alias("bits")
    place = _position(F.col("bits"))
    # dealt by bucket first: what is shuffled grows with the keys, not with tasks times buckets
    bitmap = wanted.select(hashed, bits).select(*place).repartition("bucket").groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    return rows.select("*", hashed, bits).select(*rows.columns, *place).join(F.broadcast(bitmap), "bucket") \
        .where(_is_set()).select(*rows.columns)


def batch_states(rows: DataFrame, spec: S.TableSpec) -> DataFrame:
    """Mergeable statistics per version, partition and asset: rows, first and last time."""
    asset = F.col("asset") if "asset" in spec.columns else F.lit(None).cast("string")
    return rows.groupBy("v", spec.partition_col, asset.alias("asset")).agg(
        F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("first_hour"), F.max("timestamp").alias("last_hour"))


KINDS = {"keys": key_bitmaps, "stats": batch_states}


def folder(store, spec: S.TableSpec, kind: str) -> str:
    return f"{store.root}/_index/{spec.name}/{kind}"


def _markers(store, spec: S.TableSpec, kind: str) -> dict[str, list[str]]:
    """Version -> names of the derived tables that hold it."""
    fs, p = store._fs(folder(store, spec, kind))
    out: dict[str, list[str]] = {}
    for name in sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []:
        if name.startswith("of-"):
            version, table = name[len("of-"):].split(SEP)
            out.setdefault(version, []).append(table)
    return out


def live_folders(pointer: dict) -> list[tuple[str, str]]:
    """(version, partition value) of every folder that makes up the table."""
    return [(v, urllib.parse.unquote(d.split("=", 1)[1])) for d, versions in pointer["parts"].items() for v in versions]


def derived(store, spec: S.TableSpec, pointer: dict, kind: str) -> DataFrame | None:
    """The derived rows of the folders that make up the table at ``pointer`` (None: it has no folder). Only versions
    that no run has derived yet are read."""
    spec, base = store.spec(spec), folder(store, spec, kind)
    live = live_folders(pointer)
    if not live:
        return None
    known = _markers(store, spec, kind)
    missing = sorted({v for v, _ in live} - known.keys())
    if missing:
        schema = T.StructType([*store.storage_schema(spec).fields, T.StructField("v", T.StringType())])
        rows = store.spark.read.schema(schema).option("basePath", store.path(spec)) \
            .parquet(*[store._version_path(spec, v) for v in missing])
        table = uuid.uuid4().hex[:12]
        KINDS[kind](rows, spec).write.mode("errorifexists").option("compression", "zstd").parquet(f"{base}/{table}")
        for v in missing:
            store._write_meta(f"{base}/of-{v}{SEP}{table}", "")
            known[v] = [table]
    source = {v: known[v][0] for v, _ in live}
    # built in the driver, one row per folder that the pointer lists
    wanted = store.spark.createDataFrame([(v, part, source[v]) for v, part in live], f"v string, {spec.partition_col} string, __table string")
    rows = store.spark.read.parquet(*[f"{base}/{t}" for t in sorted(set(source.values()))])
    table_of = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return rows.withColumn("__table", table_of) \
        .join(F.broadcast(wanted), ["v", spec.partition_col, "__table"], "left_semi").drop("__table")


def forget(store, spec: S.TableSpec, live: set[str], below: int) -> None:
    """Remove what is derived from versions numbered below ``below`` that are not in ``live``."""
    for kind in KINDS:
        base, markers = folder(store, spec, kind), _markers(store, spec, kind)
        gone = {v for v in markers if v not in live and int(v.split("-")[0]) < below}
        for v in gone:
            for table in markers[v]:
                fs, p = store._fs(f"{base}/of-{v}{SEP}{table}")
                fs.delete(p, False)
        kept = {t for v, tables in markers.items() if v not in gone for t in tables}
        for table in {t for v in gone for t in markers[v]} - kept:
            fs, p = store._fs(f"{base}/{table}")
            fs.delete(p, True)
