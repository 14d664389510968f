"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A text is split by the tokenizer's pattern; every piece is merged on its own: the adjacent pair with
the smallest rank first, the leftmost of equal ones first. The queue of waiting pairs has one
bucket per merge rank holding positions of a linked list of tokens. Which buckets are in
use is kept in a two-level bitmap of 256-bit words, so the next rank is two find-first-set steps
whatever the length of the piece, and a piece of n bytes costs O(n) queue operations. A bucket is handled
from the left; if a merge brings up a pair of a lower rank, the rest of the bucket waits again. A position
whose pair has changed since it was queued is a stale entry and skipped when it comes up.

Many pieces wait in one queue, with barriers between them; a rank's bucket serves all of them. Merged pieces
are remembered per Python worker in two generations of about ``CACHE_BYTES`` each (the older one goes when
the younger is full; the caches only save time). Every text is encoded whole; the ranks are a file read from the
tokenizer package on each worker, 50 thousand entries whatever the input.

Defined cases: null text is empty and has no ids; ids of repeated rows are those of each row. A text
of one very long piece is merged by the same queue. Extra columns are ignored; null document ids
are kept.
"""

from __future__ import annotations

import base64
import hashlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidemark.llm.common import release_memory, slices

CACHE_BYTES = 32 << 20  # of a generation of merged pieces, about
VOCABULARY = "byte_bpe_50k.tiktoken"


BARRIER = 0xFFFF  # stands after every piece; no pair has it
PACKED = "<u2"    # ids are below the barrier


def _laid_out(pieces: list[bytes], ranks: dict[bytes, int], joins: dict[int, int]):
    """(tokens of the pieces' bytes with barriers, rank of the pair at each, positions by rank)."""
    one = np.array([ranks.get(bytes([k]), BARRIER) for k in range(256)], np.int64)
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    own = np.ones(int(sizes.sum()) + len(pieces), bool)
    own[np.cumsum(sizes + 1) - 1] = False
    tokens = np.full(len(own), BARRIER, np.int64)
    tokens[own] = one[np.frombuffer(b"".join(pieces), np.uint8)]
    key, place = np.unique(tokens[:-1] << 16 | tokens[1:], return_inverse=True)
    waiting = np.append(np.array([joins.get(k, -1) for k in key.tolist()], np.int64)[place], -1)
    order = np.argsort(waiting, kind="stable")[int((waiting < 0).sum()):]
    by = waiting[order]
    first = np.flatnonzero(np.append(True, by[1:] != by[:-1])) if len(by) else np.zeros(0, np.int64)
    positions = order.tolist()
    buckets = {r: positions[a:z] for r, a, z in zip(by[first].tolist(), first.tolist(), [*first[1:].tolist(), len(by)])}
    return tokens.tolist(), waiting.tolist(), buckets


def merge_all(pieces: list[bytes], ranks: dict[bytes, int], joins: dict[int, int]) -> list[list[int]]:
    """Token ids of every piece (`_merged`)."""
    ids, ends = _merged(pieces, ranks, joins)
    ids = ids.tolist()
    return [ids[a:z] for a, z in zip([0, *[c + 1 for c in ends]], ends)]


def merge_packed(pieces: list[bytes], ranks: dict[bytes, int], joins: dict[int, int]) -> list[bytes]:
    """Token ids of every piece (`_merged`), packed as ``PACKED`` numbers."""
    ids, ends = _merged(pieces, ranks, joins)
    packed = ids.astype(PACKED).tobytes()
    return [packed[2 * a:2 * z] for a, z in zip([0, *[c + 1 for c in ends]], ends)]


def _merged(pieces: list[bytes], ranks: dict[bytes, int], joins: dict[int, int]) -> tuple[np.ndarray, list[int]]:
    """(token ids with a barrier after each piece, places of the barriers). The pieces are side by side in one linked
    list: one queue serves them all, and no pair crosses a barrier. ``joins[left << 16 | right]`` is the rank of two
    tokens' bytes joined, which is also the id of that token (`joins_of`)."""
    get = joins.get
    tokens, waiting, buckets = _laid_out(pieces, ranks, joins)  # waiting: rank of the pair that starts here, -1: none
    n = len(tokens)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    words: dict[int, int] = {}  # lower level of the bitmap: 256 ranks each
    top = 0  # upper level: which words are not empty
    for r in buckets:
        words[r >> 8] = words.get(r >> 8, 0) | 1 << (r & 255)
        top |= 1 << (r >> 8)
    while top:
        g = (top & -top).bit_length() - 1
        word = words[g]
        low = word & -word
        r = g << 8 | low.bit_length() - 1
        words[g] = word = word ^ low
        if not word:
            top ^= 1 << g
        bucket = buckets.pop(r)
        if len(bucket) > 1:
            bucket.sort()
        shifted = r << 16
        lower = False  # whether a pair of a lower rank has come up: it goes first
        for at, k in enumerate(bucket):
            if waiting[k] != r:
                continue  # stale: the pair at this position has changed
            if lower:
                rest = bucket[at:]
                if r in buckets:
                    buckets[r] += rest
                else:
                    buckets[r] = rest
                    words[g] = words.get(g, 0) | low
                    top |= 1 << g
                break
            nxt = after[k]
            tokens[k] = r
            waiting[nxt] = -1
            end = after[k] = after[nxt]
            before[end] = k
            waiting[k] = x = get(shifted | tokens[end], -1)
            if x >= 0:
                if x in buckets:
                    buckets[x].append(k)
                else:
                    buckets[x] = [k]
                    words[x >> 8] = words.get(x >> 8, 0) | 1 << (x & 255)
                    top |= 1 << (x >> 8)
                if x < r:
                    lower = True
            prev = before[k]
            if prev >= 0:
                waiting[prev] = x = get(tokens[prev] << 16 | r, -1)
                if x >= 0:
                    if x in buckets:
                        buckets[x].append(prev)
                    else:
                        buckets[x] = [prev]
                        words[x >> 8] = words.get(x >> 8, 0) | 1 << (x & 255)
                        top |= 1 << (x >> 8)
                    if x < r:
                        lower = True
    left = np.array(still_linked(after, n), np.int64)
    ids = np.array(tokens, np.int64)[left]
    return ids, np.flatnonzero(ids == BARRIER).tolist()


def still_linked(after: list[int], n: int) -> list[int]:
    """Positions still in the linked list, in order."""
    out, k = [], 0
    while k < n:
        out.append(k)
        k = after[k]
    return out


def joins_of(ranks: dict[bytes, int]) -> dict[int, int]:
    """Ranks by the ids of two tokens whose joined bytes are a token."""
    get = ranks.get
    out = {}
    for token, r in ranks.items():
        for k in range(1, len(token)):
            a, b = get(token[:k]), get(token[k:])
            if a is not None and b is not None:
                out[a << 16 | b] = r
    return out


def merge(piece: bytes, ranks: dict[bytes, int], joins: dict[int, int]) -> list[int]:
    """Token ids of one piece."""
    whole = ranks.get(piece)
    return [whole] if whole is not None else merge_all([piece], ranks, joins)[0]


class Codec:
    """Encoder and decoder for a rank file and a split pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes_of = {v: k for k, v in self.ranks.items()}
        self.split = regex.compile(pattern).findall
        if len(self.ranks) > 0xFFFF or sorted(self.bytes_of) != list(range(len(self.ranks))):
            raise ValueError("ranks must count from 0 and stay below 65535")
        self.joins = joins_of(self.ranks)
        tokens = [self.bytes_of[k] for k in range(len(self.ranks))]
        self.tokens = pa.array(tokens, pa.large_binary())
        self.decimals = pa.array([b"%d " % k for k in range(len(tokens))], pa.large_binary())
        self.cache: dict[str, bytes] = {}  # packed ids of pieces
        self.older: dict[str, bytes] = {}
        self.room = CACHE_BYTES

    def learn(self, texts: list[str]) -> list[list[str]]:
        """Pieces of the texts, all of them merged and in the cache."""
        if self.room < 0:  # pieces used since the last change of caches are kept
            self.cache, self.older, self.room = {}, self.cache, CACHE_BYTES
        pieces = list(map(self.split, texts))
        new = set().union(*pieces).difference(self.cache)
        self.room -= 250 * len(new) + 8 * sum(map(len, new))
        known = new.intersection(self.older)
        self.cache.update(zip(known, map(self.older.__getitem__, known)))
        waiting = []
        for p in new - known:
            whole = self.ranks.get(p.encode())
            if whole is None:
                waiting.append(p)
            else:
                self.cache[p] = whole.to_bytes(2, "little")
        for k in range(0, len(waiting), 1000):
            part = waiting[k:k + 1000]
            self.cache.update(zip(part, merge_packed([p.encode() for p in part], self.ranks, self.joins)))
        return pieces

    def encode_packed(self, texts: list[str]) -> tuple[np.ndarray, list[int]]:
        """(ids of all texts in a row, at which of them each text begins, and the end)."""
        found = [b"".join(map(self.cache.__getitem__, pieces)) for pieces in self.learn(texts)]
        return np.frombuffer(b"".join(found), PACKED), [0, *accumulate(len(x) // 2 for x in found)]

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        ids, starts = self.encode_packed(texts)
        return [ids[a:z].tolist() for a, z in zip(starts, starts[1:])]

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    @staticmethod
    def spell(entries: pa.Array, ids: np.ndarray, starts: list[int]) -> list[memoryview]:
        """The joined entries (``tokens`` or ``decimals``) of the ids of every text."""
        taken = entries.take(pa.array(ids))
        _, offsets, data = taken.buffers()
        at = np.frombuffer(offsets, np.int64)[taken.offset:][starts].tolist() if len(ids) else [0] * len(starts)
        data = memoryview(data or b"")
        return [data[a:z] for a, z in zip(at, at[1:])]


_codecs: dict[tuple[str, str], Codec] = {}


def codec(vocabulary: str = VOCABULARY) -> Codec:
    """The codec of a rank file of the tokenizer package, made once per worker."""
    import public_tokenizers

    key = (public_tokenizers.path(vocabulary), public_tokenizers.PATTERN)
    if key not in _codecs:
        _codecs[key] = Codec(*key)
    return _codecs[key]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``id`` and ``ids`` (array of token ids) of every row."""
    def run(batches):
        c = codec(vocabulary)
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(c.encode_all([t or "" for t in b.column(1).to_pylist()]), pa.list_(pa.int32()))],
                ["id", "ids"])

    return (docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
            .mapInArrow(run, "id long, ids array<int>"))


def decode(tokens: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``id`` and ``data`` (bytes) of every row of ``id, ids``; a null list decodes to no bytes."""
    def run(batches):
        c = codec(vocabulary)
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([c.decode(x or []) for x in b.column(1).to_pylist()], pa.binary())], ["id", "data"])

    return tokens.select("id", "ids").mapInArrow(run, "id long, data binary")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """Encode every row, decode its ids again, and return digests of both: ``id, n_tokens,
    ids_sha256, decoded_sha256``. One pass; ids and bytes stay in the task."""
    def run(batches):
        c = codec(vocabulary)
        for b in slices(batches):
            ids, starts = c.encode_packed([t or "" for t in b.column(1).to_pylist()])
            counts = [z - a for a, z in zip(starts, starts[1:])]
            # every number is followed by a space; the last one of a text is left out
            ids_sha = [hashlib.sha256(x[:-1]).hexdigest() for x in c.spell(c.decimals, ids, starts)]
            data_sha = [hashlib.sha256(x).hexdigest() for x in c.spell(c.tokens, ids, starts)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()),
                                              pa.array(data_sha, pa.string())],
                                             ["id", "n_tokens", "ids_sha256", "decoded_sha256"])
        release_memory()

    return (docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
            .mapInArrow(run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"))


def query(spark, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet")).withColumnRenamed("id", "doc_id")
