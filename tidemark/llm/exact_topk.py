"""Exact top-k search by inner product with vector-approximation files.

Every component range is cut into ``1 << bits`` equal cells; a vector's approximation is the row of its
cell numbers (one byte each). For a query, cell bounds give an upper and a lower bound of its
inner product with every approximated vector.

1. *Scan.* Query blocks meet strips of the approximation file; a tile keeps, per query, the vectors
   whose upper bound reaches the tile's k-th largest lower bound. The k-th largest lower bound over
   all tiles then drops what cannot be among the k best.
2. *Refine.* Exact vectors are read in the order of their bounds: a first wave of the ``WAVE`` most
   promising per query fixes a k-th exact score; a second wave reads the rest of those whose bound
   still reaches it. What is left out is below the k-th exact score for certain.

Equal vectors are one entry with their ``k + 1`` smallest distinct ids (the best k of any list, without
the query itself), each as often as it has rows, up to k, so a vector that a third of all rows share is
scored once. An entry that holds the query's id alone bounds nothing for that query. Tiles have at most
``QUERY_BLOCK`` queries and about ``STRIP`` vectors; both sides are dealt by hash and replicated only
across the other's blocks. Nothing is broadcast but the cell edges (two numbers per component).

Defined cases: vectors that are null, hold null or non-finite components or differ in length from the
most common length take no part. An empty table or no query gives an empty result. Ties go to the
smaller id. Rows of one id are candidates each; rows with the query's own id are not candidates
of that query; a repeated query id is answered once, for its smallest vector. Null ids take no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import parts_for, staged

BITS = 8
STRIP = 8192
QUERY_BLOCK = 512
WAVE = 32


def prepared(frame: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, vec`` of the rows that take part."""
    rows = frame.select(frame[id_col].cast("long").alias("id"), frame[vec_col].cast("array<double>").alias("vec"))
    return rows.where("id is not null and vec is not null and size(vec) > 0").where(
        F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def _matrix(column, dim: int | None = None) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = np.asarray(flat.flatten().to_numpy(zero_copy_only=False), np.float64)
    return values.reshape(len(flat), -1) if len(flat) else np.zeros((0, dim or 0))


def cell_edges(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(smallest, largest) value of every component, reduced inside the tasks first."""
    def run(batches):
        low = high = None
        for b in batches:
            if b.num_rows:
                m = _matrix(b.column(0))
                low = m.min(0) if low is None else np.minimum(low, m.min(0))
                high = m.max(0) if high is None else np.maximum(high, m.max(0))
        if low is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(low))), pa.array(low), pa.array(high)], ["d", "low", "high"])

    got = (rows.select("vec").mapInArrow(run, "d long, low double, high double")
           .groupBy("d").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("d").collect())
    return np.array([r.low for r in got]), np.array([r.high for r in got])


class Cells:
    """Equal cells per component; cell c of component d holds [edges[d, c], edges[d, c + 1]]."""

    def __init__(self, low: np.ndarray, high: np.ndarray, bits: int):
        self.n = 1 << bits
        width = np.where(high > low, (high - low) / self.n, 1.0)
        self.edges = low[:, None] + width[:, None] * np.arange(self.n + 1)
        self.edges[:, -1] = np.maximum(self.edges[:, -1], high)

    def of(self, m: np.ndarray) -> np.ndarray:
        out = np.empty(m.shape, np.uint8)
        for d in range(m.shape[1]):
            out[:, d] = np.clip(np.searchsorted(self.edges[d], m[:, d], side="right") - 1, 0, self.n - 1)
        return out

    def box(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = np.arange(cells.shape[1])
        return self.edges[d, cells], self.edges[d, cells.astype(np.int64) + 1]


def bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) bounds of the inner products of ``queries`` with vectors in [low, high], widened by
    the rounding error of the sums."""
    plus, minus = np.maximum(queries, 0), np.minimum(queries, 0)
    slack = 1e-12 * (np.abs(queries) @ np.maximum(np.abs(low), np.abs(high)).T)
    return plus @ low.T + minus @ high.T - slack, plus @ high.T + minus @ low.T + slack


def _scan(vectors: pa.Table, queries: pa.Table, cells: Cells, k: int) -> pa.Table:
    """One tile: per query the entries whose upper bound reaches the k-th largest lower bound."""
    if not vectors.num_rows or not queries.num_rows:
        empty = (("query", pa.int64()), ("entry", pa.int64()), ("low", pa.float64()), ("high", pa.float64()))
        return pa.table({c: pa.array([], t) for c, t in empty})
    approx = np.frombuffer(b"".join(vectors["cells"].to_pylist()), np.uint8).reshape(vectors.num_rows, -1)
    low, high = bounds(_matrix(queries["vec"]), *cells.box(approx))
    ids = queries["id"].to_numpy()
    entry, copies, first = (vectors[c].to_numpy() for c in ("entry", "copies", "first"))
    own = (copies[None, :] == 1) & (first[None, :] == ids[:, None])  # the query itself, alone in its entry
    low[own], high[own] = -np.inf, -np.inf
    if low.shape[1] > k:
        reach = np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k]
    else:
        reach = np.full(len(ids), -np.inf)
    q, v = np.nonzero((high >= reach[:, None]) & (high > -np.inf))
    return pa.table({"query": ids[q], "entry": entry[v], "low": low[q, v], "high": high[q, v]})


def _exact(batches):
    """Exact inner products of (query, entry, ids, qvec, vec) rows."""
    for b in batches:
        q, v = _matrix(b.column(3)), _matrix(b.column(4))
        score = np.einsum("ij,ij->i", q, v) if b.num_rows else np.zeros(0)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(score)], ["query", "entry", "ids", "score"])


def exact_topk(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
               bits: int = BITS, strip: int = STRIP, block: int = QUERY_BLOCK, wave: int = WAVE) -> DataFrame:
    """``query, rank, id, score``: the ``k`` rows of ``vectors`` with the largest inner product for every
    row of ``queries`` (exact while products and sums stay below 2**53 for integer vectors). A query's candidates
    are the vectors of its length; each length that queries have is a search of its own."""
    rows = prepared(vectors, id_col, vec_col)
    asked = prepared(queries, id_col, vec_col).groupBy("id").agg(F.min("vec").alias("vec"))
    lengths = sorted(r.n for r in asked.select(F.size("vec").alias("n")).distinct().collect())
    out = None
    for n in lengths or [0]:
        found = _of_one_length(*(x.where(F.size("vec") == F.lit(n)) for x in (rows, asked)), k, bits, strip, block, wave)
        out = found if out is None else out.unionByName(found)
    return out


def _of_one_length(rows: DataFrame, questions: DataFrame, k: int, bits: int, strip: int, block: int, wave: int) -> DataFrame:
    """`exact_topk` over prepared rows whose vectors have one length."""
    each = rows.groupBy("vec", "id").agg(F.least(F.count(F.lit(1)), F.lit(k)).cast("int").alias("n"))
    copy = Window.partitionBy("vec").orderBy("id")
    few = each.withColumn("nth", F.row_number().over(copy)).where(F.col("nth") <= k + 1)  # limited before the shuffle, too
    entries = (few.groupBy("vec").agg(F.sort_array(F.flatten(F.collect_list(F.expr("array_repeat(id, n)")))).alias("ids"))
               .withColumn("entry", F.xxhash64("vec")))
    low, high = cell_edges(rows)
    shared = rows.sparkSession.sparkContext.broadcast(Cells(low, high, bits) if len(low) else None)

    def approximate(batches):
        for b in batches:
            got = shared.value.of(_matrix(b.column(2))) if b.num_rows else np.zeros((0, 0), np.uint8)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array([r.tobytes() for r in got], pa.binary())],
                                             ["entry", "ids", "vec", "cells"])

    table = staged(entries.select("entry", "ids", "vec")
                   .mapInArrow(approximate, "entry long, ids array<long>, vec array<double>, cells binary"), "va-file")
    asked = staged(questions, "va-queries")
    strips, blocks = parts_for(table.count(), strip), parts_for(asked.count(), block)
    left = (table.select("entry", "cells", F.size(F.array_distinct("ids")).alias("copies"), F.element_at("ids", 1).alias("first"),
                         F.pmod(F.xxhash64("entry"), F.lit(strips)).cast("int").alias("strip"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    right = (asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
             .withColumn("strip", F.explode(F.sequence(F.lit(0), F.lit(strips - 1)))))
    scanned = staged(left.groupBy("strip", "block").cogroup(right.groupBy("strip", "block"))
                     .applyInArrow(lambda v, q: _scan(v, q, shared.value, k), "query long, entry long, low double, high double"), "va-scan")
    by_low = Window.partitionBy("query").orderBy(F.desc("low"), "entry")
    reach = (scanned.withColumn("nth", F.row_number().over(by_low)).where(F.col("nth") <= k)
             .groupBy("query").agg(F.min("low").alias("reach"), F.count(F.lit(1)).alias("n")))
    by_high = Window.partitionBy("query").orderBy(F.desc("high"), "entry")
    hopeful = scanned.join(reach, "query").where((F.col("n") < k) | (F.col("high") >= F.col("reach"))).select("query", "entry", "high")
    first = hopeful.withColumn("nth", F.row_number().over(by_high)).where(F.col("nth") <= wave).select("query", "entry")

    def read(pairs):
        return (pairs.distinct().join(table.select("entry", "ids", "vec"), "entry")
                .join(asked.select(F.col("id").alias("query"), F.col("vec").alias("qvec")), "query")
                .select("query", "entry", "ids", "qvec", "vec")
                .mapInArrow(_exact, "query long, entry long, ids array<long>, score double"))

    def best(scored):
        flat = scored.withColumn("id", F.explode("ids")).where("id <> query").select("query", "id", "score")
        order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
        return flat.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    one = staged(read(first), "va-wave")
    certain = best(one).groupBy("query").agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("n"))
    rest = (hopeful.join(first, ["query", "entry"], "left_anti").join(certain, "query", "left")
            .where(F.col("n").isNull() | (F.col("n") < k) | (F.col("high") >= F.col("kth"))).select("query", "entry"))
    return best(one.unionByName(read(rest))).select("query", "rank", "id", "score")


def _fixed(x):
    """floor(256 x) as double; null stays null, a non-finite component becomes null."""
    x = x.cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), F.floor(F.lit(256.0) * x).cast("double"))


def query(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    whole = rows.withColumn("embedding", F.transform("embedding", _fixed))
    return exact_topk(whole, whole.where("vec_id % 50 = 0")).select(
        F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"),
        F.col("score").cast("long").alias("score"))


SQL = """
WITH e AS (
  SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, e.vec_id, list_sum([z[1] * z[2] FOR z IN list_zip(q.v, e.v)])::BIGINT AS score
      FROM e q JOIN e ON q.vec_id <> e.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""
