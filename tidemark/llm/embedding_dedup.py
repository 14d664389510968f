"""Embedding near-dedup by an epsilon grid order join.

Vectors of one label are linked if their cosine is at least ``threshold``. On unit vectors that is a
Euclidean distance of at most eps = sqrt(2 - 2 threshold). Unit vectors are projected on the leading
``DIMS`` principal directions; projection on orthonormal directions never lengthens a distance, so
vectors whose projections differ by more than eps in one direction cannot be linked.

1. Equal vectors of a label are one entry with a count and the smallest id.
2. Entries are sorted in epsilon grid order: by label, then by grid cells of width eps on the principal
   directions, one after the other. The sequence is cut into blocks of at most ``BLOCK`` entries.
3. Pairs of blocks of a label whose boxes of projections are within eps in every direction are
   joined, one pair per tile. Within a tile the two intervals are halved again and again; parts
   whose boxes are too distant are skipped; parts of at most ``LEAF`` entries are compared by a
   matrix product. Cosines within 1e-9 of the threshold are recomputed by exact summation.
4. A tile returns per entry the number of linked rows and a spanning forest of its links (never the
   links); counts are summed, components come from `common.components`.

The principal directions are fitted on at most ``SAMPLE`` entries (a documented bound); they affect
speed alone, every vector is sorted and joined.

Defined cases: a vector that is null, zero, holds null or non-finite components, has or has a null label
links with nothing (``n_links`` 0, its own component, kept). Vectors of different lengths never link; each
length is a join of its own. Equal
vectors (repeated rows, copies under other ids) link with each other. A null id is kept as a row and
never names a component unless there is nothing else. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, parts_for, staged

THRESHOLD = 0.93
DIMS = 6
BLOCK = 4096
LEAF = 256
SAMPLE = 5000


def _matrix(column) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(values.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(values), -1)


def unit(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def exact_cosine(a: np.ndarray, b: np.ndarray) -> float:
    a, b = a / np.abs(a).max(), b / np.abs(b).max()
    return math.fsum(a * b) / (math.sqrt(math.fsum(a * a)) * math.sqrt(math.fsum(b * b)))


def principal_directions(entries: DataFrame, dims: int, sample: int) -> np.ndarray:
    rows = entries.select("vec").orderBy(F.xxhash64("vec")).limit(sample).toArrow()
    if not rows.num_rows:
        return np.zeros((1, 1))
    m = unit(_matrix(rows["vec"]))
    _, vectors = np.linalg.eigh(np.cov(m, rowvar=False).reshape(m.shape[1], -1) if len(m) > 1 else np.eye(m.shape[1]))
    return vectors[:, ::-1][:, :dims]


class Side:
    """Entries of a block in grid order."""

    def __init__(self, vectors: np.ndarray, counts: np.ndarray, axes: np.ndarray):
        self.raw, self.unit, self.counts = vectors, unit(vectors), counts
        self.at = self.unit @ axes
        self.links = np.zeros(len(counts), np.int64)

    def far(self, a: int, z: int, other: Side, b: int, y: int, eps: float) -> bool:
        """Whether the boxes of two intervals are more than eps apart in some direction."""
        mine, theirs = self.at[a:z], other.at[b:y]
        return bool(((mine.min(0) - theirs.max(0) > eps) | (theirs.min(0) - mine.max(0) > eps)).any())


class Tile:
    """The join of two blocks, or of a block with itself."""

    def __init__(self, left: Side, right: Side, threshold: float):
        self.left, self.right, self.threshold = left, right, threshold
        self.eps = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9
        self.same = left is right
        self.shift = 0 if self.same else len(left.counts)
        self.root = np.arange(self.shift + len(right.counts))
        self.waiting, self.size = [], 0

    def run(self) -> None:
        self.join(0, len(self.left.counts), 0, len(self.right.counts))
        self.fold()

    def join(self, a: int, z: int, b: int, y: int) -> None:
        if a >= z or b >= y or self.left.far(a, z, self.right, b, y, self.eps):
            return
        if z - a <= LEAF and y - b <= LEAF:
            self.compare(a, z, b, y)
        elif self.same and a == b and z == y:
            m = (a + z) // 2
            self.join(a, m, a, m)
            self.join(a, m, m, z)
            self.join(m, z, m, z)
        else:
            m, k = (a + z) // 2, (b + y) // 2
            for a2, z2 in ((a, m), (m, z)) if z - a > LEAF else ((a, z),):
                for b2, y2 in ((b, k), (k, y)) if y - b > LEAF else ((b, y),):
                    self.join(a2, z2, b2, y2)

    def compare(self, a: int, z: int, b: int, y: int) -> None:
        cosine = self.left.unit[a:z] @ self.right.unit[b:y].T
        linked = cosine >= self.threshold
        for i, j in zip(*np.nonzero(np.abs(cosine - self.threshold) < 1e-9)):
            linked[i, j] = exact_cosine(self.left.raw[a + i], self.right.raw[b + j]) >= self.threshold
        if self.same and a == b:
            linked = np.triu(linked, 1)
        if linked.any():
            self.left.links[a:z] += linked @ self.right.counts[b:y]
            self.right.links[b:y] += self.left.counts[a:z] @ linked
            i, j = np.nonzero(linked)
            self.waiting.append((i + a, j + b + self.shift))
            self.size += len(i)
            if self.size > 1 << 20:
                self.fold()

    def fold(self) -> None:
        """Take the links seen so far into the forest."""
        if self.waiting:
            i, j = (np.concatenate(x) for x in zip(*self.waiting))
            self.waiting, self.size = [], 0
            while True:
                a, b = self.root[i], self.root[j]
                if (a == b).all():
                    break
                np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
                while True:
                    up = self.root[self.root]
                    if (up == self.root).all():
                        break
                    self.root = up


def blocks_of(entries: DataFrame, axes: np.ndarray, eps: float, block: int) -> DataFrame:
    """The entries in grid order, cut into blocks: one row per block with its vectors, counts, smallest
    ids and box. Blocks are numbered by task and place."""
    dims = axes.shape[1]

    def place(batches):
        for b in batches:
            at = unit(_matrix(b.column(1))) @ axes if b.num_rows else np.zeros((0, dims))
            cells = np.floor(at / eps).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(k) for k in range(4)), *(pa.array(cells[:, k]) for k in range(dims))],
                ["label", "vec", "copies", "low_id", *(f"c{k}" for k in range(dims))])

    cells = [f"c{k}" for k in range(dims)]
    order = ["label", *cells, F.xxhash64("vec")]
    n = parts_for(entries.count(), 4 * block)
    placed = (entries.select("label", "vec", "copies", "low_id")
              .mapInArrow(place, "label string, vec array<double>, copies long, low_id long, " + ", ".join(f"{c} int" for c in cells)))

    def cut(batches):
        task, k, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            nonlocal k, held, size
            t = pa.Table.from_batches(held)
            m = _matrix(t["vec"])
            at = unit(m) @ axes
            row = pa.RecordBatch.from_arrays(
                [pa.array([task * (1 << 20) + k]), pa.array([t["label"][0].as_py()]), pa.array([len(m)]),
                 pa.array([at.min(0).tolist()]), pa.array([at.max(0).tolist()]), pa.array([m.tobytes()], pa.binary()),
                 pa.array([t["copies"].to_numpy().astype("<i8").tobytes()], pa.binary()),
                 pa.array([t["low_id"].to_pylist()], pa.list_(pa.int64()))],
                ["blk", "label", "n", "lo", "hi", "data", "copies", "low_ids"])
            k, held, size = k + 1, [], 0
            return row

        for b in batches:
            at = 0
            labels = b.column(0).to_pylist()
            while at < b.num_rows:
                if held and held[0].column(0)[0].as_py() != labels[at]:
                    yield flush()
                end = at
                while end < b.num_rows and labels[end] == labels[at] and size + end - at < block:
                    end += 1
                held.append(b.slice(at, end - at))
                size += end - at
                at = end
                if size >= block:
                    yield flush()
        if held:
            yield flush()

    return (placed.repartitionByRange(n, *order).sortWithinPartitions(*order)
            .select("label", "vec", "copies", "low_id")
            .mapInArrow(cut, "blk long, label string, n long, lo array<double>, hi array<double>, data binary, "
                             "copies binary, low_ids array<long>"))


def block_pairs(blocks: DataFrame, eps: float, dims: int) -> DataFrame:
    """``a, b`` (a <= b): pairs of blocks of a label that are not provably distant. Blocks meet by the
    cells of their first direction, then all directions are compared."""
    thin = blocks.select("blk", "label", "lo", "hi")
    cell = lambda c, d: F.floor((F.element_at(c, 1) + F.lit(d)) / F.lit(eps))
    left = thin.withColumn("cell", F.explode(F.sequence(cell("lo", -eps), cell("hi", eps))))
    right = thin.withColumn("cell", F.explode(F.sequence(cell("lo", 0.0), cell("hi", 0.0))))
    apart = F.lit(False)
    for k in range(1, dims + 1):
        apart = (apart | (F.element_at("x.lo", k) - F.element_at("y.hi", k) > eps)
                 | (F.element_at("y.lo", k) - F.element_at("x.hi", k) > eps))
    return (left.alias("x").join(right.alias("y"), ["label", "cell"]).where((F.col("x.blk") <= F.col("y.blk")) & ~apart)
            .select(F.col("x.blk").alias("a"), F.col("y.blk").alias("b")).distinct())


def _tiles(batches, axes: np.ndarray, threshold: float):
    """(a, b, data and copies of both) -> node, links, root of the linked entries of each tile."""
    for batch in batches:
        for row in batch.to_pylist():
            sides = []
            for data, copies in ((row["data_a"], row["copies_a"]), (row["data_b"], row["copies_b"])):
                n = np.frombuffer(copies, "<i8")
                sides.append(Side(np.frombuffer(data, np.float64).reshape(len(n), -1), n, axes))
            if row["a"] == row["b"]:
                sides[1] = sides[0]
            tile = Tile(*sides, threshold)
            tile.run()
            node = np.concatenate([row["a"] * BLOCK_IDS + np.arange(len(sides[0].counts)),
                                   row["b"] * BLOCK_IDS + np.arange(len(sides[1].counts))][:1 if tile.same else 2])
            links = np.concatenate([s.links for s in sides[:1 if tile.same else 2]])
            at = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array(node[at]), pa.array(links[at]), pa.array(node[tile.root[at]])],
                                             ["node", "links", "root"])


BLOCK_IDS = 1 << 16  # node = block number * BLOCK_IDS + place in the block


def embedding_dedup(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD, dims: int = DIMS, block: int = BLOCK, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``vectors``: ``id, n_links, component_id, kept``."""
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[label_col].cast("string").alias("label"),
                          vectors[vec_col].cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = rows.where("label is not null and vec is not null").where(finite & F.exists("vec", lambda x: x != 0))
    labelled = None
    for r in good.select(F.size("vec").alias("n")).distinct().orderBy("n").collect() or [None]:
        n = r.n if r else 1
        found = _labelled(good.where(F.size("vec") == F.lit(n)), n, threshold, dims, block, sample)
        labelled = found if labelled is None else labelled.unionByName(found)
    return (rows.join(labelled, ["label", "vec"], "left")
            .select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
            .withColumn("kept", F.col("id").eqNullSafe(F.col("component_id"))))


def _labelled(good: DataFrame, length: int, threshold: float, dims: int, block: int, sample: int) -> DataFrame:
    """``label, vec, n_links, component_id`` of the distinct vectors of one length."""
    entries = staged(good.groupBy("label", "vec").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("low_id")), "ego-entries")
    axes = principal_directions(entries, min(dims, length), sample)
    eps = math.sqrt(max(1e-12, 2 - 2 * threshold)) + 1e-9
    blocks = staged(blocks_of(entries, axes, eps, min(block, BLOCK_IDS)), "ego-blocks")
    pairs = staged(block_pairs(blocks, eps, axes.shape[1]), "ego-pairs")
    data = blocks.select("blk", "data", "copies")
    tiles = (pairs.join(data.toDF("a", "data_a", "copies_a"), "a").join(data.toDF("b", "data_b", "copies_b"), "b"))
    found = staged(tiles.mapInArrow(lambda it: _tiles(it, axes, threshold), "node long, links long, root long"), "ego-links")
    roots = components(found.where("root <> node").select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))

    def unpack(batches):
        for batch in batches:
            for row in batch.to_pylist():
                n = np.frombuffer(row["copies"], "<i8")
                m = np.frombuffer(row["data"], np.float64).reshape(len(n), -1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["blk"] * BLOCK_IDS + np.arange(len(n))), pa.array([row["label"]] * len(n), pa.string()),
                     pa.array(list(m), pa.list_(pa.float64())), pa.array(n), pa.array(row["low_ids"], pa.int64())],
                    ["node", "label", "vec", "copies", "low_id"])

    nodes = blocks.select("blk", "label", "data", "copies", "low_ids").mapInArrow(
        unpack, "node long, label string, vec array<double>, copies long, low_id long")
    named = (nodes.join(counts, "node", "left").join(roots, "node", "left")
             .withColumn("root", F.coalesce("root", "node")))
    best = named.groupBy("root").agg(F.min("low_id").alias("component_id"))
    n_links = F.coalesce("links", F.lit(0)) + F.col("copies") - 1  # of other entries, and of copies of its own
    return staged(named.join(best, "root").select("label", "vec", n_links.alias("n_links"), "component_id"), "ego-result")


def query(spark, sf_dir: str) -> DataFrame:
    return embedding_dedup(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).withColumnRenamed("id", "vec_id")


SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.e, b.e) >= {THRESHOLD}),
reach(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS low FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT m.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, least(m.vec_id, coalesce(c.low, m.vec_id)) AS component_id,
       m.vec_id = least(m.vec_id, coalesce(c.low, m.vec_id)) AS kept
FROM embeddings m LEFT JOIN c ON c.a = m.vec_id LEFT JOIN n ON n.a = m.vec_id"""
