"""Vectorised hashed word features: many documents' bytes at a time, no per-word Python.

A word is a maximal run of ASCII letters and non-ASCII bytes; A-Z are lower-cased. Its features are
the whole word and its prefixes of ``PREFIXES`` bytes (which catch stems and compounds). A
feature's hash is a polynomial of its bytes modulo 2**64, read off a running sum, then mixed and
cut to 32 bits.
"""

from __future__ import annotations

import numpy as np

PREFIXES = (3, 4, 5, 6, 7, 8)
CHUNK = 1 << 17
_BASE = 0x9E3779B97F4A7C15
_LOWER = np.zeros(256, np.uint8)
_LOWER[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LOWER[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LOWER[128:] = np.arange(128, 256)
_powers: dict[int, list[np.ndarray]] = {}


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    size = 1 << max(17, (n - 1).bit_length())
    if size not in _powers:
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            t = np.full(size, base, np.uint64)
            t[0] = 1
            tables.append(np.multiply.accumulate(t))
        _powers[size] = tables
    return _powers[size]


def _mix(h: np.ndarray, salt: int) -> np.ndarray:
    h = h ^ np.uint64(salt * 0x632BE59BD9B4E019 % (1 << 64))
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.int64)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(byte offset of the word, 32-bit feature) for every feature of every word of ``data``."""
    low = _LOWER[np.frombuffer(data, np.uint8)]
    n = len(low)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = np.zeros(n + 2, bool)
    word[1:-1] = low != 0
    edge = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edge[::2], edge[1::2]
    power, inverse = _power_tables(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(low.astype(np.uint64) * power[:n], out=total[1:])
    ats, hashes = [starts], [_mix((total[ends] - total[starts]) * inverse[starts], 1)]
    for size in PREFIXES:
        at = starts[ends - starts >= size]
        ats.append(at)
        hashes.append(_mix((total[at + size] - total[at]) * inverse[at], 0))
    return np.concatenate(ats), np.concatenate(hashes)


def chunks(texts: list[bytes]):
    """Consecutive runs of documents of about ``CHUNK`` bytes: (first, last + 1)."""
    first, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t) + 1
        if size >= CHUNK:
            yield first, k + 1
            first, size = k + 1, 0
    if first < len(texts):
        yield first, len(texts)


class Vocabulary:
    """A sorted set of features with a bitmap in front, for quick lookups."""

    def __init__(self, features: np.ndarray):
        self.features = np.unique(np.asarray(features, np.int64))
        self.bitmap = np.zeros(1 << 20, bool)
        self.bitmap[self.features & ((1 << 20) - 1)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in ``h``, positions in the vocabulary) of the known features of ``h``."""
        if not len(self.features):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.bitmap[h & ((1 << 20) - 1)])
        place = np.minimum(np.searchsorted(self.features, h[at]), len(self.features) - 1)
        keep = self.features[place] == h[at]
        return at[keep], place[keep]


def known_features(texts: list[bytes], vocabulary: Vocabulary | None = None):
    """For each chunk of ``texts``: (first, last + 1, document counted from first, feature), one
    entry per distinct pair. With a vocabulary, features are positions in it and others left out."""
    for a, b in chunks(texts):
        part = texts[a:b]
        at, h = word_hashes(b"\n".join(part))
        if vocabulary is not None:
            hit, h = vocabulary.find(h)
            at = at[hit]
        begins = np.zeros(len(part), np.int64)
        np.cumsum([len(t) + 1 for t in part[:-1]], out=begins[1:])
        both = np.unique(((np.searchsorted(begins, at, side="right") - 1) << 32) | h)
        yield a, b, both >> 32, both & 0xFFFFFFFF
