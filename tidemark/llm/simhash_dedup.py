"""SimHash near-dedup by pivot distance tables.

A document's fingerprint has 64 bits; fingerprints within ``max_bits`` of one another are linked
and the connected components are the groups of near copies.

Distance table. `pivots` gives reference fingerprints: a seeded random base and ``max_bits + 2`` families. A pivot of
a family differs from the base only in half of the family's own share of the 64 bits. The Hamming distances of
every distinct fingerprint to all pivots are computed once and stored (`distance_table`).

Candidates. Flipping a bit changes each distance by one, and by the same amount for the base and for every pivot of the
families that do not own the bit. Linked fingerprints differ in at most ``max_bits`` bits, so in at least
two families all distances relative to the base are equal. Candidates are the pairs that agree in
the stored coordinates of some two families: an equi-join of the table with itself, without a bound on its groups.

Discard and verify. No coordinate of a linked pair differs by more than ``max_bits`` (triangle inequality): a candidate
is discarded by its largest coordinate difference, and what is left is verified by its exact Hamming distance.

Scale. Equal fingerprints are one node (grouped minimum, combined before the shuffle). A group of
more than ``BLOCK`` fingerprints is cut into blocks, and pairs of blocks are joined as separate
tiles, so no task holds a whole hot group. A tile returns a spanning forest of its links, not the
links. Components come from `common.components`.

Defined cases: null or empty text (or text without words) has fingerprint 0, linked like any
other. Repeated rows and equal ids stay as rows of their own and get the same group. A null id is
kept; the group's id is the smallest non-null id (null if there is none). An empty table gives an
empty result. Extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, slices, staged

SEED = 42
PIVOTS = 10  # of a family
BLOCK = 256


def fingerprint(text: str | None, words: int = 3) -> int:
    """64-bit SimHash of ``words``-word shingles (A-Z lower-cased, split at ASCII white space)."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        spans = [joined]
    else:
        ends = (np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1).tolist()
        starts = [0] + [e + 1 for e in ends[:-words]]
        spans = [joined[a:b] for a, b in zip(starts, ends[words - 1:])]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in spans], "<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(spans), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """``(id, row, fp)``: the fingerprint of every row as a signed 64-bit integer; ``row`` is Spark's
    xxhash64 of the text and tells rows of one id apart."""
    def run(batches):
        for b in slices(batches):
            fps = np.array([fingerprint(t, words) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(fps.view(np.int64))], ["id", "row", "fp"])

    text = docs[text_col].cast("string")
    return (docs.select(docs[id_col].cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("row"))
            .mapInArrow(run, "id long, row long, fp long"))


def pivots(max_bits: int = 2, each: int = PIVOTS) -> np.ndarray:
    """The reference fingerprints: the base, then the first of every family, the second of every family, ..."""
    rng = np.random.default_rng(SEED)
    base = rng.integers(0, 1 << 64, dtype=np.uint64)
    shares = np.array_split(rng.permutation(64), max_bits + 2)
    out = [base]
    for _ in range(each):
        for share in shares:
            half = rng.choice(share, len(share) // 2, replace=False).astype(np.uint64)
            out.append(base ^ np.bitwise_or.reduce(np.uint64(1) << half, initial=np.uint64(0)))
    return np.array(out, np.uint64)


def pivot_table(fps: np.ndarray, max_bits: int = 2) -> np.ndarray:
    """Hamming distances of ``fps`` to the pivots, one column each."""
    return np.bitwise_count(fps[:, None] ^ pivots(max_bits)[None, :]).astype(np.int8)


def family_keys(table: np.ndarray, max_bits: int = 2) -> list[np.ndarray]:
    """Per family one number that stands for its coordinates relative to the base (a digit for each)."""
    families, half = max_bits + 2, 64 // (max_bits + 2) // 2 + 1
    relative = table[:, 1:].astype(np.int64) - table[:, :1] + half
    keys = []
    for f in range(families):
        key = np.zeros(len(table), np.int64)
        for digit in relative[:, f::families].T:
            key = key * (2 * half + 1) + digit
        keys.append(key)
    return keys


def distance_table(classes: DataFrame, max_bits: int = 2) -> DataFrame:
    """``(fp, d, k0, k1, ...)``: the distances of each fingerprint to all pivots, a byte each, and its families' keys."""
    names = [f"k{f}" for f in range(max_bits + 2)]

    def run(batches):
        for b in batches:
            table = pivot_table(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64), max_bits)
            d = pa.array([row.tobytes() for row in table], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), d, *map(pa.array, family_keys(table, max_bits))], ["fp", "d", *names])

    return classes.select("fp").mapInArrow(run, "fp long, d binary, " + ", ".join(f"{k} long" for k in names))


def tile_links(left: np.ndarray, right: np.ndarray, max_bits: int, dl: np.ndarray | None = None,
               dr: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i of ``left``, j of ``right``) within ``max_bits`` bits; ``dl``, ``dr`` are their rows of the table."""
    dl = pivot_table(left, max_bits) if dl is None else dl
    dr = pivot_table(right, max_bits) if dr is None else dr
    i, j = np.nonzero(np.abs(dl[:, 0][:, None] - dr[:, 0][None, :]) <= max_bits)
    for k in range(1, dl.shape[1]):
        keep = np.abs(dl[i, k] - dr[j, k]) <= max_bits
        i, j = i[keep], j[keep]
    keep = np.bitwise_count(left[i] ^ right[j]) <= max_bits
    return i[keep], j[keep]


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of ``n`` nodes under the links (i, j)."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _tiles(batches, max_bits: int):
    """Sorted rows (key, ta, tb, blk, fp, d) -> forest edges (a, b) of each tile."""
    rest = None
    out: list[np.ndarray] = []

    def solve(fp, d, blk, ta, tb):
        if ta == tb:
            i, j = tile_links(fp, fp, max_bits, d, d)
        else:
            cut = int(np.searchsorted(blk, tb))
            i, j = tile_links(fp[:cut], fp[cut:], max_bits, d[:cut], d[cut:])
            j = j + cut
        root = forest(len(fp), i, j)
        at = np.flatnonzero(root != np.arange(len(fp)))
        if len(at):
            out.append(np.stack([fp[at], fp[root[at]]]).view(np.int64))

    def flush(cols, last):
        """Solve the whole tiles of ``cols``; return the rows of the last, maybe unfinished, one."""
        key, ta, tb, blk, fp, d = cols
        if not len(key):
            return None
        cuts = np.flatnonzero((key[1:] != key[:-1]) | (ta[1:] != ta[:-1]) | (tb[1:] != tb[:-1])) + 1
        edges = [0, *cuts.tolist(), len(key)]
        for a, b in zip(edges, edges[1:]):
            if b == len(key) and not last:
                return [c[a:] for c in cols]
            if b - a > 1:
                solve(fp[a:b], d[a:b], blk[a:b], ta[a], tb[a])
        return None

    def result():
        e = np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(e[0]), pa.array(e[1])], ["a", "b"])

    for batch in batches:
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(5)]
        cols[4] = cols[4].view(np.uint64)
        cols.append(np.frombuffer(b"".join(batch.column(5).to_pylist()), np.int8).reshape(batch.num_rows, -1))
        if rest is not None:
            cols = [np.concatenate(p) for p in zip(rest, cols)]
        rest = flush(cols, False)
        yield result()
    if rest is not None:
        flush(rest, True)
        yield result()


def links(classes: DataFrame, max_bits: int = 2, block: int = BLOCK) -> DataFrame:
    """Edges ``(a, b)`` that connect the fingerprints of column ``fp`` (distinct) as all links do."""
    table = staged(distance_table(classes, max_bits), "pivot-distances")
    keys = [F.xxhash64(F.lit(n), f"k{x}", f"k{y}") for n, (x, y) in enumerate(combinations(range(max_bits + 2), 2))]
    keyed = table.select("fp", "d", F.explode(F.array(*keys)).alias("key"))
    sizes = keyed.groupBy("key").count().where("count > 1")
    tiles = (keyed.join(sizes, "key")
             .withColumn("nb", F.ceil(F.col("count") / F.lit(block)).cast("int"))
             .withColumn("blk", F.pmod(F.xxhash64("fp"), F.col("nb")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
             .select("key", F.least("blk", "other").alias("ta"), F.greatest("blk", "other").alias("tb"), "blk", "fp", "d"))
    return (tiles.repartition("key", "ta", "tb").sortWithinPartitions("key", "ta", "tb", "blk", "fp")
            .mapInArrow(lambda it: _tiles(it, max_bits), "a long, b long"))


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                  max_bits: int = 2) -> DataFrame:
    """One row per row of ``docs``: ``id, row, fp, fingerprint`` (hex), ``component_id``, the smallest id
    reachable over links, and ``group``, the smallest fingerprint reachable."""
    fps = staged(fingerprints(docs, id_col, text_col, words), "fps")
    classes = staged(fps.groupBy("fp").agg(F.min("id").alias("rep")), "fp-classes")
    roots = components(links(classes, max_bits)).withColumnRenamed("node", "fp")
    named = classes.join(roots, "fp", "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    best = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    label = staged(named.join(best, "root").select("fp", "root", "component_id"), "fp-labels")
    return fps.join(label, "fp").select("id", "row", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                                        "component_id", F.col("root").alias("group"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return simhash_dedup(docs).select(F.col("id").alias("doc_id"), "fingerprint", "component_id")
