"""What several operators of this subpackage share: staged tables, connected components."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

CHUNK = 1 << 16  # entries of a count vector per row
SLICE_BYTES = 1 << 20
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffle_cleanup(spark: SparkSession):
    """Within the block Spark removes a query's shuffle files when that query has ended, so that
    a chain of staged steps holds the shuffle files of one step at a time."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a zstd parquet table under the shared folder (``spark.checkpoint.dir``)
    and return it re-read: lineage ends there, a lost executor re-reads files."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    with shuffle_cleanup(spark):
        df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tidemark_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a staged table that nothing reads any more."""
    spark = df.sparkSession
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._tidemark_path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release_memory() -> None:
    """Give memory that a task has freed back to the system: a Python worker lives on between stages, and what its
    allocators keep counts against the executor. Does nothing where the C library cannot."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def releasing(function):
    """``function`` of grouped Arrow tables, followed by `release_memory`."""
    @functools.wraps(function)
    def run(*args):
        out = function(*args)
        release_memory()
        return out

    return run


def slices(batches, rows: int = 256):
    """The record batches in slices of a few rows: what a task holds of a batch as Python objects stays
    small, however long the texts of a whole batch are."""
    for b in batches:
        for k in range(0, b.num_rows, rows):
            yield b.slice(k, rows)


def by_bytes(column, limit: int | None = None):
    """(first, last + 1) of consecutive values of about ``limit`` bytes; a longer value stands alone."""
    limit = limit or SLICE_BYTES
    first, size = 0, 0
    for k, x in enumerate(column):
        n = len(x) if x is not None else 0
        if size and size + n > limit:
            yield first, k
            first, size = k, 0
        size += n
    if first < len(column):
        yield first, len(column)


def vector_chunks(total: np.ndarray, task: int):
    """``chunk, task, data`` batches of a task's count vector; chunks of zeros are left out."""
    for k in range(0, len(total), CHUNK):
        part = total[k:k + CHUNK]
        if part.any():
            yield pa.RecordBatch.from_arrays([pa.array([k // CHUNK], pa.int32()), pa.array([task], pa.int32()),
                                              pa.array([part.astype("<i8").tobytes()], pa.binary())], ["chunk", "task", "data"])


def _vector_sum(*keys: str):
    def run(group: pa.Table) -> pa.Table:
        total = np.frombuffer(group["data"][0].as_py(), "<i8").copy()
        for k in range(1, group.num_rows):
            total += np.frombuffer(group["data"][k].as_py(), "<i8")
        return pa.table({**{k: group[k].slice(0, 1) for k in keys}, "data": pa.array([total.tobytes()], pa.binary())})

    return run


def tree_sum(vectors: DataFrame, branch: int) -> DataFrame:
    """``chunk, data``: the sum of the tasks' vectors (`vector_chunks`), in a tree of two levels, first within
    ``branch`` groups of tasks: no task meets all vectors."""
    return (vectors.withColumn("branch", F.pmod("task", F.lit(branch)).cast("int")).drop("task")
            .groupBy("chunk", "branch").applyInArrow(_vector_sum("chunk", "branch"), "chunk int, branch int, data binary")
            .groupBy("chunk").applyInArrow(_vector_sum("chunk"), "chunk int, data binary"))


def one_row_each(df: DataFrame, *by: str) -> DataFrame:
    """One row per value of the columns ``by``, with the ``text`` of the smallest hash: a grouped minimum,
    combined before the shuffle, so an id with a third of all rows leaves one row per task."""
    first = F.min(F.struct(F.xxhash64("text").alias("h"), F.col("text").alias("text")))
    return df.groupBy(*by).agg(first.alias("first")).select(*by, F.col("first.text").alias("text"))


def parts_for(n: float, per_part: float, least: int = 1) -> int:
    """How many partitions (or shards) of about ``per_part`` units hold ``n`` units."""
    return max(least, math.ceil((n or 0) / per_part))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: one row ``(node, root)`` for every node that has
    an edge, ``root`` being the smallest node of its component.

    Alternating large-star / small-star steps: every step is two grouped minima (combined before
    the shuffle) and two joins, so a hub with a third of all edges is never gathered in a task.
    Each step is staged in the shared folder; the loop ends when a step changes nothing.
    """
    e = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
               .distinct(), "edges")
    mark = _mark(e)
    while mark[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        new = staged(small, "edges")
        discard(e)
        e, before, mark = new, mark, _mark(new)
        if mark == before:
            break
    roots = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _mark(e: DataFrame):
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
