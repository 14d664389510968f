"""Landing files: one JSON envelope per line, ``{asset, ingest_ts, batch_id, payload}``.

A whole landing directory is read in one scan (all assets, all payloads). A broken line
or a payload that does not fit its schema is isolated to that payload: it gets a
``reason`` and goes to quarantine, the other payloads carry on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas as S

CORRUPT = "_corrupt_record"
PAYLOAD_CORRUPT = "_corrupt_payload"


def read_landing(spark: SparkSession, paths, streaming: bool = False,
                 max_files_per_trigger: int | None = None, recursive: bool = False,
                 glob: str | None = None) -> DataFrame:
    """Read landing JSON lines with a fixed schema (never inferred); PERMISSIVE keeps bad lines.

    ``payload`` may be embedded as a JSON object or carried as JSON text; either way it is
    read as text and parsed per source. ``recursive`` reads nested landing folders (e.g. one per
    day or hour) in the same single scan; ``glob`` filters file names. Streaming reads can bound
    each micro-batch by files. Uncompressed JSON lines split across tasks; gzip files do not.
    """
    schema = T.StructType(list(S.envelope_schema().fields) + [T.StructField(CORRUPT, T.StringType())])
    reader = (spark.readStream if streaming else spark.read).schema(schema) \
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if streaming:
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return reader.json(paths)
    return reader.json(paths if isinstance(paths, (list, tuple)) else [paths])


def landed_from_frame(df: DataFrame) -> DataFrame:
    """Adapt an in-memory envelope frame (asset, ingest_ts, batch_id, payload text)."""
    cols = {c: F.col(c) for c in ("asset", "ingest_ts", "batch_id", "payload")}
    if CORRUPT not in df.columns:
        cols[CORRUPT] = F.lit(None).cast("string")
    else:
        cols[CORRUPT] = F.col(CORRUPT)
    return df.select(*[v.alias(k) for k, v in cols.items()])


def classify(landed: DataFrame, payload_type: T.DataType, invalid: Column | None = None,
             need_asset: bool = True) -> DataFrame:
    """Parse ``payload`` into ``p`` and attach ``reason`` (NULL = good payload).

    Reasons, first match wins: corrupt_envelope, missing_asset, missing_ingest_ts,
    unparseable_payload, invalid_values (``invalid`` is a predicate over ``p``).
    """
    # the payload's own corrupt-record field tells malformed JSON / type mismatches apart from
    # a well-formed payload whose fields are merely absent (from_json gives an all-NULL struct)
    schema = T.StructType(list(payload_type.fields) + [T.StructField(PAYLOAD_CORRUPT, T.StringType())])
    p = F.from_json(F.col("payload"), schema, {"mode": "PERMISSIVE",
                                               "columnNameOfCorruptRecord": PAYLOAD_CORRUPT})
    # content hash of the payload: the last tie-break of the arrival order, so two different
    # payloads sharing (asset, batch_id, ingest_ts) still have a total, partition-independent order
    df = landed.withColumn("p", p).withColumn(
        "payload_hash", F.xxhash64(F.coalesce(F.col("payload"), F.col(CORRUPT), F.lit(""))))
    reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("corrupt_envelope"))
    if need_asset:
        reason = reason.when(F.col("asset").isNull(), F.lit("missing_asset"))
    reason = reason.when(F.col("ingest_ts").isNull(), F.lit("missing_ingest_ts")) \
                   .when(F.col("payload").isNull() | F.col("p").isNull()
                         | F.col(f"p.{PAYLOAD_CORRUPT}").isNotNull(), F.lit("unparseable_payload"))
    if invalid is not None:
        reason = reason.when(F.coalesce(invalid, F.lit(False)), F.lit("invalid_values"))
    return df.withColumn("reason", reason)


def quarantine_rows(classified: DataFrame, source: str) -> DataFrame:
    """The rejected payloads, keyed (source, asset, batch_id, ingest_ts), raw text kept."""
    return classified.where(F.col("reason").isNotNull()).select(
        F.lit(source).alias("source"), "asset", "batch_id", "ingest_ts", "reason",
        F.coalesce(F.col("payload"), F.col(CORRUPT)).alias("raw"))


def quarantine_counts(classified: DataFrame, source: str) -> DataFrame:
    """Payload counts per (source, asset, reason) — ``reason`` NULL counts the good ones."""
    return classified.groupBy(F.lit(source).alias("source"), "asset", "reason") \
        .agg(F.count(F.lit(1)).alias("payloads"))
