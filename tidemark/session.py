"""Session construction and the few session-level settings every job relies on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the semantics depend on (UTC hour floors, ANSI casts)
# and the ones the execution model wants (AQE re-planning, skew splitting).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # the default (INT96) has no statistics, so no row group could be skipped by time
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.checkpoint.compress": "true",
    # long-running streams: drop checkpoint files of RDDs no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "tidemark",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


def scale_settings(shuffle_bytes: int, target_partition_bytes: int = 256 << 20,
                   max_partition_bytes: int = 256 << 20) -> dict:
    """Shuffle/scan sizing for a job whose largest shuffle moves about ``shuffle_bytes``.

    AQE can merge small shuffle partitions but cannot split large ones (skew splitting aside),
    so the initial count must be high enough for the biggest shuffle: ~``target_partition_bytes``
    each, AQE coalescing the rest to its advisory size. E.g. a 20 TB shuffle -> 81,920 partitions.
    """
    n = max(200, -(-int(shuffle_bytes) // int(target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(int(target_partition_bytes)),
        "spark.sql.files.maxPartitionBytes": str(int(max_partition_bytes)),
    }


def apply_settings(spark: SparkSession, settings: dict) -> None:
    for k, v in settings.items():
        spark.conf.set(k, v)


def ensure_utc(spark: SparkSession) -> None:
    """Set the caller's session zone to UTC, which text without an offset and all hour floors depend
    on, and have times written with statistics. No other setting of the session is changed (idempotent)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.parquet.outputTimestampType", BASE_CONF["spark.sql.parquet.outputTimestampType"])


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when unset on a local master (tests) do we create one of our own
    and register it (any other master raises), so that ``DataFrame.checkpoint()`` and scratch tables land in the same place.
    """
    d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            d = None
    if not d:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for a scratch table (never a machine-local temp)."""
    root = shared_dir(spark)
    sep = "" if root.endswith("/") else "/"
    return f"{root}{sep}tidemark-scratch/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for filesystem helpers used in tests."""
    return path[5:] if path.startswith("file:") else path


__all__ = ["build_session", "ensure_utc", "shared_dir", "scratch_path", "local_path", "BASE_CONF",
           "scale_settings", "apply_settings"]
