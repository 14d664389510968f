"""Cross-tokenizer alignment with corpus counts under a minimal perfect hash.

Every text is tokenized by two tokenizers (A: byte-level BPE over space + text, B: sentence pieces over the
text). A token's byte range is the sum of the bytes before it; ranges of A and B that overlap are a
*link*, and byte offsets where a token of A and one of B both end cut the tokens into *groups*. An id
pair's count is the number of documents that hold it linked. The steps:

1. *Tokens.* Texts are tokenized once; ids are staged as packed integers, a few bytes a token.
2. *First pass.* Documents are aligned in numpy. The distinct id pairs (a Spark ``distinct``) are dealt to
   buckets by a hash, and each bucket builds its part of a minimal perfect hash: bitmaps by level, a key
   that shares its slot going on to the next level; a key's index is the rank of its bit. The keys
   themselves are stored by index, so that every look-up is verified.
3. *Counts.* Each task aligns its documents again and adds into one dense vector indexed by the hash;
   vectors are cut into chunks and summed in two steps (a tree), so no task meets all vectors.
4. *Second pass.* Documents are re-aligned and look up the counts of their links.

Scale. The table of keys is bounded by the two vocabularies, not by the data, and broadcast in parts of at
most ``PART_KEYS`` keys: with more, steps 3 and 4 run once per part and the partial sums of a document
are added. A document is a row of a batch throughout; nothing is gathered per key.

Defined cases. Null and empty texts, and texts whose joined token bytes of A or B are not space + text (a
normalising tokenizer, U+2581 in the text), have no tokens: zeros and an empty digest. Rows of equal
id are documents each; null ids are kept. Very long texts are aligned whole, in one batch of their own.
Special tokens' strings are plain text. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import CHUNK, by_bytes, discard, parts_for, slices, staged, tree_sum, vector_chunks

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
BUCKET_TOKENS = 1 << 23   # tokens per bucket of keys, as long as the vocabularies allow more keys
BUCKET_KEYS = 1 << 20
PART_KEYS = 1 << 23
LONG_WORD = 1000          # longer words, blanks, and rarer characters go through the tokenizer library
_BLANK = re.compile(r"\s{%d}" % LONG_WORD)
_RARE = re.compile("[^\x00-\u024f]")
SPREAD = 2.0              # slots per key of a level
SPACE_MARK = "▁"


# ---- the two tokenizers ------------------------------------------------------------------------

def byte_level_alphabet() -> dict[str, int]:
    """The printable stand-ins of bytes in a byte-level vocabulary: printable Latin-1 bytes stand for
    themselves, the others for the code points from 256 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {**{chr(b): b for b in own}, **{chr(256 + k): b for k, b in enumerate(rest)}}


class Pair:
    """Both tokenizers, the bytes of their ids, and the names used in group digests."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        byte = byte_level_alphabet()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, k in spec["model"]["vocab"].items():
            self.bytes_a[k] = bytes(map(byte.__getitem__, token)) if set(token) <= byte.keys() else token.encode()
        self.bytes_b = [bytes([int(self.b.id_to_piece(k)[3:5], 16)]) if self.b.is_byte(k)
                        else self.b.id_to_piece(k).replace(SPACE_MARK, " ").encode() for k in range(self.b.get_piece_size())]
        self.len_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.len_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # a name and what follows it: "," or "|" after a token of A, "," or ";" after one of B
        self.kinds = tuple("H" if len(x) <= 1 << 16 else "I" for x in (self.bytes_a, self.bytes_b))
        self.special = {t["id"] for t in spec["added_tokens"]}
        self.by_ranks = self._rank_encoder(spec)
        self.names = [f"{k}{end}" for size, ends in ((len(self.bytes_a), ",|"), (len(self.bytes_b), ",;"))
                      for end in ends for k in range(size)]

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Packed ids of A and B of every text; both empty where one of them does not give back the text."""
        some = [t for t in texts if t]
        found = []
        for t, b in zip(some, self.b.encode(some, num_threads=1)):
            a, t = self._ids_a(" " + t), " " + t
            found.append((array(self.kinds[0], a).tobytes(), array(self.kinds[1], b).tobytes()) if self._same(t, a, b) else (b"", b""))
        found = iter(found)
        return [next(found) if t else (b"", b"") for t in texts]

    def _ids_a(self, text: str) -> list[int]:
        if (self.by_ranks is None or not text.isascii() and _RARE.search(text) or max(map(len, text.split()), default=0) > LONG_WORD
                or _BLANK.search(text)):
            return self.a.encode(text, add_special_tokens=False).ids
        return self.by_ranks.encode_ordinary(text)

    def _rank_encoder(self, spec: dict):
        """The same tokenizer over merge ranks, which is several times faster; None unless it is provably the same.
        Ranks merge any neighbours whose joined bytes are a token, the library only the pairs of its list, in
        order. They differ only if some token's bytes alone can come to two parts that the list does not join,
        so it is enough that the list joins every token's bytes to that token."""
        tokens, model = spec["model"]["vocab"], self.a.model
        order = [tokens["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
        plain = {self.bytes_a[k]: k for t, k in tokens.items() if k not in self.special}
        if order != sorted(order) or not all([x.id for x in model.tokenize(t)] == [k] for t, k in tokens.items() if k not in self.special):
            return None
        import public_tokenizers
        import tiktoken

        try:
            return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=plain, special_tokens={})
        except ValueError:
            return None

    def _same(self, text: str, a: list[int], b: list[int]) -> bool:
        raw = text.encode()
        return b"".join(map(self.bytes_a.__getitem__, a)) == raw and b"".join(map(self.bytes_b.__getitem__, b)) == raw


_pairs: dict[tuple[str, str], Pair] = {}


def pair(vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B) -> Pair:
    """The tokenizers of two files of the tokenizer package, made once per worker."""
    import public_tokenizers

    key = (public_tokenizers.path(vocabulary_a), public_tokenizers.path(vocabulary_b))
    if key not in _pairs:
        _pairs[key] = Pair(*key)
    return _pairs[key]


def tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary_a: str = VOCABULARY_A,
           vocabulary_b: str = VOCABULARY_B) -> DataFrame:
    """``row, id, a, b`` of every row of ``docs``: a row number of its own and packed token ids."""
    def run(batches):
        p, row = pair(vocabulary_a, vocabulary_b), TaskContext.get().partitionId() << 33
        for b in slices(batches):
            texts = [t or "" for t in b.column(1).to_pylist()]
            for x, z in by_bytes(texts):
                done = p.encode(texts[x:z])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + z - x)), b.column(0).slice(x, z - x),
                     pa.array([a for a, _ in done], pa.binary()), pa.array([c for _, c in done], pa.binary())], ["row", "id", "a", "b"])
                row += z - x

    return (docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
            .mapInArrow(run, "row long, id long, a binary, b binary"))


# ---- alignment ---------------------------------------------------------------------------------

class Alignment:
    """Several documents side by side. They all have equal bytes on both sides, so the end of a
    document is a boundary of both, and no link or group crosses it."""

    def __init__(self, p: Pair, a: list[bytes], b: list[bytes]):
        kind_a, kind_b = p.kinds
        self.a = np.frombuffer(b"".join(a), kind_a).astype(np.int64)
        self.b = np.frombuffer(b"".join(b), kind_b).astype(np.int64)
        self.n_a = np.array([len(x) for x in a], np.int64) // np.dtype(kind_a).itemsize
        self.n_b = np.array([len(x) for x in b], np.int64) // np.dtype(kind_b).itemsize
        end_a, end_b = np.cumsum(p.len_a[self.a]), np.cumsum(p.len_b[self.b])
        mark = np.zeros(int(end_a[-1]) + 1 if len(end_a) else 1, np.uint8)
        mark[end_a] = 1
        mark[end_b] |= 2
        # a stretch between neighbouring boundaries lies in one token of A and one of B: that is a link
        kind = mark[np.flatnonzero(mark)]
        in_a, in_b, both = kind & 1 > 0, kind & 2 > 0, kind == 3
        self.at_a = np.cumsum(in_a) - in_a
        self.at_b = np.cumsum(in_b) - in_b
        group = np.cumsum(both) - both
        self.group_a, self.group_b = group[in_a], group[in_b]
        self.doc = np.repeat(np.arange(len(a)), self.n_a)[self.at_a]
        self.code = self.a[self.at_a] * len(p.bytes_b) + self.b[self.at_b]
        self.n_links = np.bincount(self.doc, minlength=len(a))
        self.n_groups = np.bincount(self.doc[both], minlength=len(a))

    def pairs(self, space: int) -> np.ndarray:
        """Codes of the linked id pairs, once per document."""
        return np.unique(self.doc * space + self.code) % space

    def digests(self, p: Pair) -> list[str]:
        """Per document the SHA-256 of its groups, '' without tokens."""
        size_a, size_b = len(p.bytes_a), len(p.bytes_b)
        last_a, last_b = (np.append(g[1:] != g[:-1], True) if len(g) else np.zeros(0, bool) for g in (self.group_a, self.group_b))
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        codes[np.arange(len(self.a)) + np.searchsorted(self.group_b, self.group_a)] = self.a + size_a * last_a
        codes[np.arange(len(self.b)) + np.searchsorted(self.group_a, self.group_b, side="right")] = (
            self.b + 2 * size_a + size_b * last_b)
        name, out, at = p.names.__getitem__, [], 0
        for n in (self.n_a + self.n_b).tolist():
            text = "".join(map(name, codes[at:at + n].tolist()))
            out.append(hashlib.sha256(text[:-1].encode()).hexdigest() if n else "")
            at += n
        return out


def _aligned(batches, p: Pair, a: int, b: int):
    """(batch, alignment) of slices of record batches with packed ids in columns ``a`` and ``b``."""
    for part in slices(batches):
        left, right = part.column(a).to_pylist(), part.column(b).to_pylist()
        for x, z in by_bytes(left):
            yield part.slice(x, z - x), Alignment(p, left[x:z], right[x:z])


# ---- minimal perfect hash ----------------------------------------------------------------------

def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def bucket_levels(keys: np.ndarray, spread: float = SPREAD) -> list[np.ndarray]:
    """Bitmaps by level of the distinct ``keys``: the bit of every slot that exactly one of the keys still
    without a slot hashes to."""
    levels = []
    while len(keys):
        size = int(len(keys) * spread) + 1
        slot = (_mixed(keys, len(levels) + 1) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(slot, minlength=size) == 1
        levels.append(alone)
        keys = keys[~alone[slot]]
    return levels


class PerfectHash:
    """Buckets' bitmaps side by side: every key of the buckets has an index of its own below ``size``."""

    def __init__(self, buckets: int, parts: list[tuple[int, list[np.ndarray]]]):
        self.buckets = buckets
        depth = max((len(levels) for _, levels in parts), default=0)
        self.sizes = np.zeros((depth, buckets), np.int64)
        self.starts = np.zeros((depth, buckets), np.int64)
        bits, at = [], 0
        for d in range(depth):
            for k, levels in parts:
                if d < len(levels):
                    self.sizes[d, k], self.starts[d, k] = len(levels[d]), at
                    bits.append(levels[d])
                    at += len(levels[d])
        self.bits = np.concatenate(bits) if bits else np.zeros(0, bool)
        self.rank = (np.cumsum(self.bits) - self.bits).astype(np.int32)
        self.size = int(self.bits.sum())
        self.keys = np.zeros(self.size, np.int64)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Index of every key, -1 for keys that are not stored."""
        out = np.full(len(keys), -1, np.int64)
        bucket = bucket_of(keys, self.buckets)
        todo = np.arange(len(keys))
        for d in range(len(self.sizes)):
            size = self.sizes[d, bucket[todo]]
            todo, size = todo[size > 0], size[size > 0]
            slot = self.starts[d, bucket[todo]] + (_mixed(keys[todo], d + 1) % size.astype(np.uint64)).astype(np.int64)
            hit = self.bits[slot]
            out[todo[hit]] = self.rank[slot[hit]]
            todo = todo[~hit]
        return out

    def store(self, keys: np.ndarray) -> None:
        self.keys[self.index(keys)] = keys

    def find(self, keys: np.ndarray) -> np.ndarray:
        """`index`, verified against the stored keys: -1 for any other key."""
        at = self.index(keys)
        at[at >= 0] = np.where(self.keys[at[at >= 0]] == keys[at >= 0], at[at >= 0], -1)
        return at


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (_mixed(keys, 0) % np.uint64(buckets)).astype(np.int64)


def _distinct_pairs(coded: DataFrame, space: int, buckets: int, names: tuple[str, str]) -> DataFrame:
    """``bucket, code`` of the distinct linked id pairs: a task lists each pair once per some millions of
    tokens, Spark's ``distinct`` does the rest."""
    def run(batches):
        p, held, n = pair(*names), [], 0
        for _, al in _aligned(batches, p, 0, 1):
            held.append(np.unique(al.code))
            n += len(held[-1])
            if n > 1 << 21:
                held = [np.unique(np.concatenate(held))]
                n = len(held[0])
                if n > 1 << 20:
                    yield _codes(held[0], buckets)
                    held, n = [], 0
        if held:
            yield _codes(np.unique(np.concatenate(held)), buckets)

    return coded.select("a", "b").mapInArrow(run, "bucket int, code long").distinct()


def _codes(codes: np.ndarray, buckets: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(bucket_of(codes, buckets).astype(np.int32)), pa.array(codes)], ["bucket", "code"])


def _built(group: pa.Table) -> pa.Table:
    """One bucket's keys and bitmaps."""
    keys = np.sort(group["code"].to_numpy())
    levels = bucket_levels(keys)
    return pa.table({"bucket": group["bucket"].slice(0, 1), "n": pa.array([len(keys)], pa.int64()),
                     "codes": pa.array([keys.tobytes()], pa.binary()),
                     "sizes": pa.array([[len(x) for x in levels]], pa.list_(pa.int64())),
                     "bits": pa.array([np.packbits(np.concatenate(levels)).tobytes()], pa.binary())})


def _part(rows, buckets: int) -> PerfectHash:
    """The hash over the buckets of ``rows``, with its keys stored."""
    parts = []
    for r in rows:
        bits = np.unpackbits(np.frombuffer(r.bits, np.uint8)).astype(bool)
        parts.append((r.bucket, np.split(bits[:sum(r.sizes)], np.cumsum(r.sizes)[:-1])))
    out = PerfectHash(buckets, parts)
    for r in rows:
        out.store(np.frombuffer(r.codes, "<i8"))
    return out


# ---- counts ------------------------------------------------------------------------------------

def counts(coded: DataFrame, table, space: int, names: tuple[str, str], branch: int) -> DataFrame:
    """``chunk, data``: documents per key, in chunks of the vector that ``table`` (a broadcast `PerfectHash`)
    indexes. A task's vectors are added in a tree of two levels, first within ``branch`` groups of tasks."""
    def run(batches):
        p, ph = pair(*names), table.value
        task = TaskContext.get().partitionId()
        total, held, n = np.zeros(-(-ph.size // CHUNK) * CHUNK, np.int64), [], 0

        def add():
            at = ph.find(np.concatenate(held))
            total[:] += np.bincount(at[at >= 0], minlength=len(total))

        for _, al in _aligned(batches, p, 0, 1):
            held.append(al.pairs(space))
            n += len(held[-1])
            if n > 1 << 22:
                add()
                held, n = [], 0
        if held:
            add()
        yield from vector_chunks(total, task)

    vectors = coded.select("a", "b").mapInArrow(run, "chunk int, task int, data binary")
    return tree_sum(vectors, branch)


# ---- the operator ------------------------------------------------------------------------------

def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary_a: str = VOCABULARY_A,
          vocabulary_b: str = VOCABULARY_B, part_keys: int = PART_KEYS) -> DataFrame:
    """One row per row of ``docs``: ``id, n_a, n_b, n_groups, n_links, n_best`` (links whose count is the highest
    of their A id), ``count_sum`` (over links), ``groups_sha256``."""
    spark, names = docs.sparkSession, (vocabulary_a, vocabulary_b)
    p = pair(*names)
    size_b = len(p.bytes_b)
    space = len(p.bytes_a) * size_b
    coded = staged(tokens(docs, id_col, text_col, *names), "xt-tokens")
    total = coded.agg(F.sum(F.octet_length("a") / np.dtype(p.kinds[0]).itemsize)).first()[0]
    branch = max(2, int(parts_for(total, BUCKET_TOKENS) ** 0.5))
    buckets = min(parts_for(total, BUCKET_TOKENS), parts_for(space, BUCKET_KEYS))
    built = staged(_distinct_pairs(coded, space, buckets, names).groupBy("bucket")
                   .applyInArrow(_built, "bucket int, n long, codes binary, sizes array<long>, bits binary"), "xt-keys")
    parts, room = [[]], part_keys
    for r in built.select("bucket", "n").orderBy("bucket").collect():  # one small row per bucket
        if parts[-1] and r.n > room:
            parts.append([])
            room = part_keys
        parts[-1].append(r.bucket)
        room -= r.n
    best = np.zeros(len(p.bytes_a), np.int64)
    tables = []
    for part in parts:
        ph = _part(built.where(F.col("bucket").isin(part)).collect(), buckets)
        shared = spark.sparkContext.broadcast(ph)  # at most part_keys keys and one bucket
        summed = staged(counts(coded, shared, space, names, branch), "xt-counts")
        shared.unpersist()
        ph.counts = np.zeros(-(-ph.size // CHUNK) * CHUNK, np.int64)
        for r in summed.collect():
            ph.counts[r.chunk * CHUNK:(r.chunk + 1) * CHUNK] = np.frombuffer(r.data, "<i8")
        discard(summed)
        np.maximum.at(best, ph.keys // size_b, ph.counts[:ph.size])
        tables.append(spark.sparkContext.broadcast(ph))
    discard(built)
    highest = spark.sparkContext.broadcast(best)
    found = [_looked_up(coded, t, highest, names, first=k == 0) for k, t in enumerate(tables)]
    if len(found) == 1:
        return found[0].drop("row")
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    return (every.groupBy("row").agg(*[F.max(c).alias(c) for c in ("id", "n_a", "n_b", "n_groups", "n_links")],
                                     F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"),
                                     F.max("groups_sha256").alias("groups_sha256")).drop("row"))


def _looked_up(coded: DataFrame, table, highest, names: tuple[str, str], first: bool) -> DataFrame:
    """Per document what `align` returns; ``n_best`` and ``count_sum`` over the keys of one table. Tables but
    the first leave what they do not change null."""
    def run(batches):
        p, ph, best = pair(*names), table.value, highest.value
        for b, al in _aligned(batches, p, 2, 3):
            n = b.num_rows
            at = ph.find(al.code)
            got = np.where(at >= 0, ph.counts[at] if len(ph.counts) else 0, 0)
            is_best = (got > 0) & (got == best[al.a[al.at_a]])
            upto = np.concatenate([[0], np.cumsum(got)])
            ends = np.cumsum(al.n_links)
            whole = [pa.array(x, pa.int64()) for x in (al.n_a, al.n_b, al.n_groups, al.n_links)] if first else [pa.nulls(n, pa.int64())] * 4
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *whole, pa.array(np.bincount(al.doc[is_best], minlength=n), pa.int64()),
                 pa.array(upto[ends] - upto[ends - al.n_links], pa.int64()),
                 pa.array(al.digests(p), pa.string()) if first else pa.nulls(n, pa.string())],
                ["row", "id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return coded.mapInArrow(run, "row long, id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
                                 "count_sum long, groups_sha256 string")


def query(spark, sf_dir: str) -> DataFrame:
    return align(spark.read.parquet(f"{sf_dir}/documents.parquet")).withColumnRenamed("id", "doc_id")
