"""Staged tables: materialise a DataFrame as parquet in the shared folder and read it back.

This cuts lineage like ``checkpoint()`` (a lost executor re-reads the files instead of
recomputing the plan) but is columnar: later steps read only the columns they use and get
filters pushed into the scan. Aggregates wanted about the staged rows (counts, the set of
touched partitions) ride on the same write job as ``Observation`` metrics.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation

from tidemark.session import scratch_path

STAGE_CODEC = "zstd"


class Staged:
    def __init__(self, df: DataFrame, metrics: dict, path: str):
        self.df, self.metrics, self.path = df, metrics, path

    def drop(self) -> None:
        """Delete the staged files (call once nothing reads them any more)."""
        spark = self.df.sparkSession
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def stage(df: DataFrame, name: str, metrics: dict[str, Column] | None = None) -> Staged:
    """Write ``df`` (zstd parquet) under the shared folder, return it re-read plus ``metrics``
    (aggregate expressions evaluated over the written rows in the same job)."""
    spark = df.sparkSession
    path = scratch_path(spark, f"stage-{name}")
    obs = None
    if metrics:
        obs = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
        df = df.observe(obs, *[c.alias(k) for k, c in metrics.items()])
    df.write.mode("errorifexists").option("compression", STAGE_CODEC).parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    return Staged(staged, dict(obs.get) if obs else {}, path)
