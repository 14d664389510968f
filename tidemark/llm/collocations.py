"""Phrase collocation mining with double-array tries.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends and into words at spaces and tabs.
Per language, phrases of two and three words with at least ``LEAST`` occurrences are scored by their weakest
cut, ``floor(SCALE * a * a / (l * r))``, a, l and r being the occurrences of the phrase and of the two sides
of the cut; phrases that mostly occur inside a longer one are dropped, and the best ``TOP`` of each
language are returned. The steps, each staged in the shared folder:

1. *Words.* Occurrences of every word, combined per task before Spark's grouped sum. A word is named by the
   64-bit hash of language and word; should two ever share a hash, all are hashed again with a salt.
2. *Encoding.* Texts become packed word numbers. Words below ``LEAST`` are 0, as are ends of pieces: no phrase
   that counts can contain them.
3. *Candidates*, Apriori-safe: neighbouring frequent words form pairs; partial counts per task, packed by
   buckets of phrases, are summed and pairs that reach ``LEAST`` go on. A triple is looked at only where both its pairs are in a bitmap of these
   (which may let in too many, never too few), and again partial counts are summed.
4. *Tries.* Candidates are dealt by a hash of their first two words to tries of about ``TRIE`` phrases. Each
   is a double array (base, check) over the word numbers of its phrases, frequent ones first; it is built
   in a task, and broadcast: its size is bounded by ``TRIE``, whatever the corpus.
5. *Counting.* numpy moves the states of all text positions through the trie at once, word by word; the
   states reached are bincounted, and the vectors of the tasks are summed in a tree of two levels.
6. *Scores* are joins and grouped maxima on the counted candidates; arithmetic is exact in decimals.

Scale. Texts are read twice (1, 2); later steps read packed numbers. Nothing of a language, word or phrase is
gathered in one task. With more than one trie, a position is looked up only in the trie of its first two
words. With more than ``NUMBERED`` frequent words the hashes themselves serve as numbers, and no list
of words is broadcast.

Defined cases. Null texts are empty; a null language is ``und``. Repeated rows and null ids count row by row.
A text without separators is one piece, and a word of any length is a word; texts are never cut. Ties
end with the phrase in UTF-8 byte order. An empty table, or one without candidates, gives no rows. Extra
columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import CHUNK, by_bytes, discard, parts_for, release_memory, slices, staged, tree_sum, vector_chunks

LEAST = 10
TOP = 2000
COVERED = 50          # percent of a phrase's occurrences inside a longer one that drop it
SCALE = 1_000_000
NUMBERED = 1 << 23    # frequent words that are numbered through a broadcast list of 8 bytes each
TRIE = 1 << 18        # phrases of a trie: some 20 MB on the driver and in a task
TALLY = 100_000       # words that a task counts before it passes them on
RUN = 1 << 18         # word positions that are handled at once
TASK_BYTES = 16 << 20
BUCKET_BYTES = 8 << 20 # of word numbers per bucket of phrases
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
_END = b"."           # every separator, once translated; no word holds it
_TO_END = bytes.maketrans(SEPARATORS, _END * len(SEPARATORS))


def split_words(text: str) -> list[bytes]:
    """Words of a text in order, ``_END`` standing for the end of a piece. The white space that
    ``bytes.split`` knows besides space and tab has become ends before."""
    return text.encode().lower().translate(_TO_END).replace(_END, b" " + _END + b" ").split()


def by_language(batches):
    """(language, texts) of slices of record batches of ``lang, text``."""
    for b in slices(batches):
        texts = b.column(1).to_pylist()
        for a, z in by_bytes(texts):
            held: dict[str, list[str]] = {}
            for lang, text in zip(b.column(0).slice(a, z - a).to_pylist(), texts[a:z]):
                if text:
                    held.setdefault(lang, []).append(text)
            yield from held.items()


# ---- words -------------------------------------------------------------------------------------

def word_counts(base: DataFrame) -> DataFrame:
    """``lang, word, f`` over ``lang, text``."""
    def rows(tally):
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, words in tally.items() for _ in words], pa.string()),
             pa.array([w.decode() for words in tally.values() for w in words], pa.string()),
             pa.array([n for words in tally.values() for n in words.values()], pa.int64())], ["lang", "word", "n"])

    def run(batches):
        tally: dict[str, Counter] = {}
        for lang, texts in by_language(batches):
            words = tally.setdefault(lang, Counter())
            for t in texts:
                words.update(split_words(t))
            words.pop(_END, None)
            if sum(map(len, tally.values())) > TALLY:
                yield from rows(tally)
                tally = {}
        yield from rows(tally)

    return base.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("f"))


def hash_column(salt: str):
    """What `word_hasher` computes, on columns ``lang`` and ``word``."""
    return F.xxhash64(F.lit(salt), "lang", "word")


def word_hasher(salt: str, lang: str):
    """Hash of a word of a language as Spark's ``xxhash64`` of (salt, language, word)."""
    seed = xxhash.xxh64_intdigest(lang.encode(), xxhash.xxh64_intdigest(salt.encode(), 42))

    def run(word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word, seed)
        return h - (h >> 63 << 64)

    return run


def hashed(words: DataFrame) -> tuple[DataFrame, str]:
    """``words`` with hashes ``h`` that no two of them share and none of which is 0, and the salt used."""
    salt = ""
    while True:
        out = words.withColumn("h", hash_column(salt))
        clash = out.groupBy("h").agg(F.count(F.lit(1)).alias("k")).where("k > 1 or h = 0")
        if clash.isEmpty():
            return out, salt
        salt += "+"


# ---- encoding ----------------------------------------------------------------------------------

def encoded(base: DataFrame, salt: str, numbered) -> DataFrame:
    """``words``: the packed word numbers of a text, 0 at ends of pieces and at its end. A number is the place in
    the broadcast list ``numbered`` of hashes (0: not in it), or the hash itself."""
    kind = kind_of(numbered)

    def run(batches):
        known = numbered.value if numbered is not None else None
        caches: dict[str, dict[bytes, int]] = {}
        for lang, texts in by_language(batches):
            if sum(map(len, caches.values())) > TALLY:
                caches = {}
            cache, hasher = caches.setdefault(lang, {_END: 0}), word_hasher(salt, lang)
            words, sizes = [], []
            for t in texts:
                before = len(words)
                words += split_words(t)
                words.append(_END)
                sizes.append(len(words) - before)
            new = list(set(words).difference(cache))
            h = np.fromiter(map(hasher, new), np.int64, len(new))
            cache.update(zip(new, (h if known is None else place(known, h) + 1).tolist()))
            out = np.fromiter(map(cache.__getitem__, words), kind, len(words)).tobytes()
            cuts = (np.cumsum(sizes) * np.dtype(kind).itemsize).tolist()
            yield pa.RecordBatch.from_arrays([pa.array([out[a:z] for a, z in zip([0, *cuts], cuts)], pa.binary())], ["words"])

    return base.mapInArrow(run, "words binary")


def kind_of(numbered) -> str:
    """How word numbers are packed: places fit in 32 bits, hashes take 64."""
    return "<i8" if numbered is None else "<i4"


def place(known: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Places of ``values`` in the sorted array ``known``, -1 where they are not in it."""
    if not len(known):
        return np.full(len(values), -1, np.int64)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return np.where(known[at] == values, at, -1)


def runs_of(batches, kind: str, limit: int = RUN):
    """Arrays of word numbers of about ``limit`` positions."""
    held, n = [], 0
    for b in batches:
        for x in b.column(0).to_pylist():
            held.append(np.frombuffer(x, kind))
            n += len(held[-1])
            if n >= limit:
                yield np.concatenate(held)
                held, n = [], 0
    if held:
        yield np.concatenate(held)


# ---- candidates --------------------------------------------------------------------------------

def pair_mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of pairs of word numbers."""
    h = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)


def _tallied(columns: list[np.ndarray], n: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of the columns and the sum of their ``n`` (1 each)."""
    bits = [int(c.max()).bit_length() if len(c) and int(c.min()) >= 0 else 64 for c in columns]
    if sum(bits) < 63:  # numbers, not hashes: a row is one integer
        code = columns[0].astype(np.int64)
        for c, k in zip(columns[1:], bits[1:]):
            code <<= k
            code |= c
        order = np.argsort(code, kind="stable")
        change = np.diff(code[order]) != 0
    else:
        order = np.lexsort(columns[::-1])
        change = np.any([np.diff(c[order]) != 0 for c in columns], axis=0)
    first = np.flatnonzero(np.append(True, change)) if len(order) else order
    total = np.diff(np.append(first, len(order))) if n is None else np.add.reduceat(n[order], first) if len(first) else n
    return [c[order[first]] for c in columns], total


def _packed(found: list[np.ndarray], n: np.ndarray, buckets: int, branch: int):
    """Rows ``bucket, branch, words, n``: phrases dealt by a hash of their first two words, packed."""
    dealt = (pair_mix(found[0], found[1]) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(dealt, kind="stable")
    cuts = np.searchsorted(dealt[order], np.arange(buckets + 1)).tolist()
    some = [(k, order[x:y]) for k, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x]
    words = [[c[o].tobytes() for _, o in some] for c in found]
    yield pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in some], pa.int32()), pa.array([branch] * len(some), pa.int32()),
         pa.array([list(w) for w in zip(*words)], pa.list_(pa.binary())),
         pa.array([n[o].astype("<i8").tobytes() for _, o in some], pa.binary())], ["bucket", "branch", "words", "n"])


def _joined(group: pa.Table, kind: str) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct phrases of packed rows and the sums of their counts."""
    words = group["words"].to_pylist()
    columns = [np.frombuffer(b"".join(w[k] for w in words), kind) for k in range(len(words[0]))]
    return _tallied(columns, np.frombuffer(b"".join(group["n"].to_pylist()), "<i8"))


def _totals(packed: DataFrame, kind: str, size: int) -> DataFrame:
    """``w1 .. n`` of the phrases of ``size`` words that reach ``LEAST``: packed counts are added within branches
    of tasks, then over them; a group holds one entry per phrase and row, never one per occurrence."""
    def within(group: pa.Table) -> pa.Table:
        found, n = _joined(group, kind)
        return pa.table({"bucket": group["bucket"].slice(0, 1), "words": pa.array([[c.tobytes() for c in found]], pa.list_(pa.binary())),
                         "n": pa.array([n.tobytes()], pa.binary())})

    def over(group: pa.Table) -> pa.Table:
        found, n = _joined(group, kind)
        keep = n >= LEAST
        return pa.table({**{f"w{k + 1}": pa.array(c[keep], pa.int64()) for k, c in enumerate(found)}, "n": pa.array(n[keep], pa.int64())})

    return (packed.groupBy("bucket", "branch").applyInArrow(within, "bucket int, words array<binary>, n binary")
            .groupBy("bucket").applyInArrow(over, "".join(f"w{k + 1} long, " for k in range(size)) + "n long"))


def pairs(coded: DataFrame, kind: str, buckets: int, branches: int) -> DataFrame:
    """``w1, w2, n`` of neighbouring frequent words that reach ``LEAST``."""
    def run(batches):
        branch = TaskContext.get().partitionId() % branches
        for w in runs_of(batches, kind, 4 * RUN):
            at = np.flatnonzero((w[:-1] != 0) & (w[1:] != 0))
            if len(at):
                yield from _packed(*_tallied([w[at], w[at + 1]]), buckets, branch)

    return _totals(coded.mapInArrow(run, "bucket int, branch int, words array<binary>, n binary"), kind, 2)


def pair_bitmap(found: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of 2**``bits`` bits (bounded by the caller), 32 a number, with the hashes of all pairs ``w1, w2``."""
    def run(batches):
        for b in batches:
            slot = pair_mix(b.column(0).to_numpy(), b.column(1).to_numpy()) & np.uint64((1 << bits) - 1)
            yield pa.RecordBatch.from_arrays([pa.array((slot >> np.uint64(5)).astype(np.int64)),
                                              pa.array(np.int64(1) << (slot & np.uint64(31)).astype(np.int64))], ["word", "bit"])

    got = (found.select("w1", "w2").mapInArrow(run, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bit"))
           .toArrow())
    out = np.zeros(max(1, 1 << bits >> 5), "<u4")
    for b in got.to_batches():
        out[b.column(0).to_numpy()] = b.column(1).to_numpy().astype("<u4")
    return out


def in_bitmap(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether the hashes ``values`` have their bit in the bitmap, which stays packed."""
    slot = values & np.uint64(32 * len(bitmap) - 1)
    return bitmap[slot >> np.uint64(5)] >> (slot & np.uint64(31)).astype("<u4") & np.uint32(1) == 1


def triples(coded: DataFrame, kind: str, bitmap, buckets: int, branches: int) -> DataFrame:
    """``w1, w2, w3, n`` of frequent words in a row, both pairs of which are in the bitmap, that reach ``LEAST``."""
    def run(batches):
        bits, branch = bitmap.value, TaskContext.get().partitionId() % branches
        for w in runs_of(batches, kind):
            both = (w[:-1] != 0) & (w[1:] != 0)
            at = np.flatnonzero(both)
            both[at] = in_bitmap(bits, pair_mix(w[at], w[at + 1]))
            at = np.flatnonzero(both[:-1] & both[1:])
            if len(at):
                yield from _packed(*_tallied([w[at], w[at + 1], w[at + 2]]), buckets, branch)

    return _totals(coded.mapInArrow(run, "bucket int, branch int, words array<binary>, n binary"), kind, 3)


# ---- double-array tries ------------------------------------------------------------------------

class Trie:
    """A double array over phrases of two and three word numbers.

    ``alphabet`` holds the word numbers in order and ``code`` their codes from 1 on, words that occur often
    in phrases first. The state after a first word is its code; from state s the word with code c
    leads to t = base[s] + c if check[t] = s. ``accept`` is the number of the phrase that ends in a state."""

    def __init__(self, alphabet, code, base, check, accept):
        self.alphabet, self.code, self.base, self.check, self.accept = alphabet, code, base, check, accept

    @classmethod
    def build(cls, phrases: np.ndarray) -> Trie:
        """The trie of rows (w1, w2, w3), w3 = 0 for pairs; every triple's pair is among them."""
        alphabet, at, often = np.unique(phrases[phrases != 0], return_inverse=True, return_counts=True)
        code = np.empty(len(alphabet), np.int64)
        code[np.argsort(-often, kind="stable")] = np.arange(1, len(alphabet) + 1)
        coded = np.zeros(phrases.shape, np.int64)
        coded[phrases != 0] = code[at]
        size = len(alphabet) + 1
        free = np.ones(2 * size + 2 * len(phrases), bool)
        free[:size] = False
        base, check = np.zeros(len(free), np.int64), np.full(len(free), -1, np.int64)
        state, top, rng = np.zeros(len(phrases), np.int64), size, np.random.default_rng(0)
        for rows, depth in ((np.flatnonzero(coded[:, 2] == 0), 1), (np.flatnonzero(coded[:, 2] != 0), 2)):
            if depth == 1:
                parent = coded[rows, 0]
            else:  # the state of the triple's pair
                two = np.flatnonzero(coded[:, 2] == 0)
                key = coded[two, 0] * size + coded[two, 1]
                order = np.argsort(key)
                parent = state[two[order][np.searchsorted(key[order], coded[rows, 0] * size + coded[rows, 1])]]
            order = np.lexsort((coded[rows, depth], parent))
            rows, parent = rows[order], parent[order]
            child = coded[rows, depth]
            first = np.flatnonzero(np.append(True, parent[1:] != parent[:-1])) if len(rows) else np.zeros(0, np.int64)
            count = np.diff(np.append(first, len(rows)))
            for k in np.argsort(-count, kind="stable").tolist():
                if count[k] == 1:
                    break
                codes = child[first[k]:first[k] + count[k]]
                where = _fit(free, codes, size, top, rng)
                top = max(top, where + int(codes[-1]) + 1)
                if top + size > len(free):
                    free, base, check = _longer(len(free) // 2 + size, free, base, check)
                slots = where + codes
                free[slots] = False
                base[parent[first[k]]] = where
                check[slots] = parent[first[k]]
                state[rows[first[k]:first[k] + count[k]]] = slots
            single = first[count == 1]
            if np.count_nonzero(free) < len(single):
                free, base, check = _longer(len(single), free, base, check)
            slots = np.flatnonzero(free)[:len(single)]
            if len(slots):
                top = max(top, int(slots[-1]) + 1)
            free[slots] = False
            base[parent[single]] = slots - child[single]  # free slots lie beyond all codes
            check[slots] = parent[single]
            state[rows[single]] = slots
        end = int(np.flatnonzero(~free)[-1]) + 1
        dead = end  # states without a next word lead where nothing is checked
        base, check = base[:end], np.append(check[:end], np.full(size, -1, np.int64))
        inner = np.zeros(end, bool)
        inner[check[:end][check[:end] >= 0]] = True
        base[~inner] = dead
        base = np.append(base, np.full(size, dead, np.int64))
        if len(check) < int(base.max()) + size:
            more = int(base.max()) + size - len(check)
            check, base = np.append(check, np.full(more, -1, np.int64)), np.append(base, np.full(more, dead, np.int64))
        accept = np.full(end, -1, np.int64)
        accept[state] = np.arange(len(phrases))
        return cls(alphabet, code, base.astype("<i4"), check.astype("<i4"), accept.astype("<i4"))

    def advance(self, w: np.ndarray, at: np.ndarray):
        """Numbers of the phrases of two, then of three words that begin at the positions ``at`` of ``w``
        (which has two numbers more beyond the last of them)."""
        at, s = at, self._codes(w[at])
        keep = s > 0
        at, s = at[keep], s[keep]
        for step in (1, 2):
            c = self._codes(w[at + step])
            t = self.base[s] + c
            keep = (c > 0) & (self.check[t] == s)
            at, s = at[keep], t[keep]
            yield self.accept[s]

    def _codes(self, values: np.ndarray) -> np.ndarray:
        at = place(self.alphabet, values)
        return np.where(at >= 0, self.code[at], 0) if len(self.code) else np.zeros(len(values), np.int64)

    @property
    def size(self) -> int:
        return int(self.accept.max()) + 1


def _longer(more: int, free: np.ndarray, base: np.ndarray, check: np.ndarray):
    return np.append(free, np.ones(more, bool)), np.append(base, np.zeros(more, np.int64)), np.append(check, np.full(more, -1, np.int64))


def _fit(free: np.ndarray, codes: np.ndarray, low: int, top: int, rng) -> int:
    """A base at which all ``codes`` fall on free slots: among some stretches between the slots ``low`` and
    ``top``, else the first base past all used slots."""
    for at in rng.integers(low, max(top, low + 1), 64).tolist():
        window = at + np.flatnonzero(free[at:at + 256])
        fits = window[window >= codes[0]] - codes[0]
        fits = fits[fits + codes[-1] < len(free)]
        for code in codes[1:12].tolist():
            fits = fits[free[fits + code]]
        for b in fits[:16].tolist():
            if free[b + codes].all():
                return b
    return max(top - int(codes[0]), 0)


def _trie_row(group: pa.Table) -> pa.Table:
    """One group of candidates as a trie: its arrays, and the phrases in order."""
    phrases = np.stack([group[c].to_numpy() for c in ("w1", "w2", "w3")], axis=1)
    phrases = phrases[np.lexsort(phrases.T[::-1])]
    trie = Trie.build(phrases)
    return pa.table({"trie": group["trie"].slice(0, 1), "alphabet": pa.array([trie.alphabet.astype("<i8").tobytes()], pa.binary()),
                     "code": pa.array([trie.code.astype("<i8").tobytes()], pa.binary()),
                     "base": pa.array([trie.base.tobytes()], pa.binary()), "check": pa.array([trie.check.tobytes()], pa.binary()),
                     "accept": pa.array([trie.accept.tobytes()], pa.binary()),
                     "phrases": pa.array([phrases.astype("<i8").tobytes()], pa.binary())})


def tries_of(candidates: DataFrame, tries: int) -> DataFrame:
    """One row per trie over ``w1, w2, w3``, dealt by the first two words."""
    def deal(batches):
        for b in batches:
            part = pair_mix(b.column(0).to_numpy(), b.column(1).to_numpy()) % np.uint64(tries)
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), *b.columns], ["trie", "w1", "w2", "w3"])

    return (candidates.mapInArrow(deal, "trie int, w1 long, w2 long, w3 long").groupBy("trie")
            .applyInArrow(_trie_row, "trie int, alphabet binary, code binary, base binary, check binary, accept binary, phrases binary"))


def shared_trie(built: DataFrame, part: int):
    """The trie number ``part`` as a broadcast (None: there is none). The driver holds its arrays once, as they
    arrive, and nothing of them afterwards."""
    got = built.where(F.col("trie") == part).select("alphabet", "code", "base", "check", "accept").toArrow()
    if not got.num_rows:
        return None
    arrays = [np.frombuffer(c[0].as_buffer(), k) for c, k in zip(got.columns, ("<i8", "<i8", "<i4", "<i4", "<i4"))]
    return built.sparkSession.sparkContext.broadcast(Trie(*arrays))


def trie_counts(coded: DataFrame, kind: str, trie, part: int, tries: int, branch: int) -> DataFrame:
    """``trie, nth, a`` of the phrases of one broadcast `Trie` that texts hold."""
    def run(batches):
        t, task = trie.value, TaskContext.get().partitionId()
        total = np.zeros(t.size, np.int64)
        for w in runs_of(batches, kind):
            w = np.append(w, np.zeros(2, w.dtype))
            at = np.flatnonzero((w[:-2] != 0) & (w[1:-1] != 0))
            if tries > 1:
                at = at[pair_mix(w[at], w[at + 1]) % np.uint64(tries) == part]
            for found in t.advance(w, at):
                total += np.bincount(found, minlength=t.size)
        yield from vector_chunks(total, task)

    def counted(batches):
        for b in batches:
            for chunk, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                n = np.frombuffer(data, "<i8")
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), part, np.int32)), pa.array(at + chunk * CHUNK),
                                                  pa.array(n[at])], ["trie", "nth", "a"])

    return (tree_sum(coded.mapInArrow(run, "chunk int, task int, data binary"), branch)
            .mapInArrow(counted, "trie int, nth long, a long"))


def _phrases(built: DataFrame, numbered) -> DataFrame:
    """``trie, nth, h1, h2, h3``: the phrases of the tries by the hashes of their words (h3 = 0: a pair)."""
    def run(batches):
        known = numbered.value if numbered is not None else None
        for b in slices(batches, 1):
            w = np.frombuffer(b.column(1)[0].as_py(), "<i8").reshape(-1, 3)
            if known is not None:
                w = np.append(0, known)[w]
            for k in range(0, len(w), 1 << 16):
                part = w[k:k + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), b.column(0)[0].as_py(), np.int32)), pa.array(np.arange(k, k + len(part))),
                     *[pa.array(np.ascontiguousarray(part[:, j])) for j in range(3)]], ["trie", "nth", "h1", "h2", "h3"])

    return built.select("trie", "phrases").mapInArrow(run, "trie int, nth long, h1 long, h2 long, h3 long")


# ---- scores ------------------------------------------------------------------------------------

def _score(a: str, left: str, right: str):
    """floor(SCALE * a * a / (left * right)), exact: 18 digits each, 38 in between; at most SCALE."""
    wide = [f"cast({c} as decimal(18, 0))" for c in (a, left, right)]
    return F.expr(f"cast((cast({SCALE} as decimal(7, 0)) * {wide[0]} * {wide[0]}) div ({wide[1]} * {wide[2]}) as bigint)")


def scored(counted: DataFrame, words: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of ``h1, h2, h3, a``, without phrases covered by longer ones."""
    def word(n):
        return words.select(F.col("h").alias(f"h{n}"), F.col("word").alias(f"word{n}"), F.col("f").alias(f"f{n}"),
                            *([F.col("lang")] if n == 1 else []))

    two = counted.where("h3 = 0").select("h1", "h2", "a")
    three = counted.where("h3 <> 0")
    # every pair of a triple is counted: it occurs at least as often
    longer = (three.select("h1", "h2", "a").unionByName(three.select(F.col("h2").alias("h1"), F.col("h3").alias("h2"), "a"))
              .groupBy("h1", "h2").agg(F.max("a").alias("longer")))
    pairs_ = (two.join(longer, ["h1", "h2"], "left").where(f"longer is null or 100 * longer < {COVERED} * a")
              .join(word(1), "h1").join(word(2), "h2")
              .select("lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"))
              .withColumn("score", _score("a", "l", "r")))
    front = two.select("h1", "h2", F.col("a").alias("f12"))
    back = two.select(F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("a").alias("f23"))
    triples_ = (three.join(front, ["h1", "h2"]).join(back, ["h2", "h3"]).join(word(1), "h1").join(word(2), "h2").join(word(3), "h3")
                .withColumn("s1", _score("a", "f1", "f23")).withColumn("s2", _score("a", "f12", "f3"))
                .select("lang", F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), "a",
                        F.when(F.col("s1") <= F.col("s2"), F.col("f1")).otherwise(F.col("f12")).alias("l"),
                        F.when(F.col("s1") <= F.col("s2"), F.col("f23")).otherwise(F.col("f3")).alias("r"),
                        F.least("s1", "s2").alias("score")))
    return pairs_.unionByName(triples_)


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", top: int = TOP, trie: int = TRIE,
                 numbered: int = NUMBERED) -> DataFrame:
    """The ``top`` phrases of every language: ``lang, rank, phrase, a, l, r, n, score``."""
    spark = docs.sparkSession
    base = docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"), docs[text_col].cast("string").alias("text"))
    every = staged(word_counts(base), "pc-words")
    words, salt = hashed(every)
    frequent = words.where(F.col("f") >= LEAST)
    n_frequent = frequent.count()
    numbers = None
    if n_frequent <= numbered:  # at most 8 bytes a word
        numbers = spark.sparkContext.broadcast(np.sort(frequent.select("h").toArrow()["h"].to_numpy()))
    kind = kind_of(numbers)
    coded = staged(encoded(base, salt, numbers), "pc-encoded")
    size = coded.agg(F.sum(F.octet_length("words"))).first()[0]
    buckets = parts_for(size, BUCKET_BYTES)
    branch = max(2, int(parts_for(size, TASK_BYTES) ** 0.5))
    two = staged(pairs(coded, kind, buckets, branch), "pc-pairs")
    n_two = two.count()
    bits = min(28, max(10, (8 * n_two).bit_length()))  # about 8 bits a pair, at most 32 MB
    bitmap = spark.sparkContext.broadcast(pair_bitmap(two, bits))
    release_memory()
    three = staged(triples(coded, kind, bitmap, buckets, branch), "pc-triples")
    bitmap.destroy()  # the triples are written
    candidates = two.select("w1", "w2", F.lit(0).cast("long").alias("w3")).unionByName(three.select("w1", "w2", "w3"))
    tries = parts_for(n_two + three.count(), trie)
    built = staged(tries_of(candidates, tries), "pc-tries")
    counts = []
    for part in range(tries):
        shared = shared_trie(built, part)
        if shared is None:
            continue
        release_memory()
        counts.append(staged(trie_counts(coded, kind, shared, part, tries, branch), "pc-counts"))
        shared.destroy()  # the counts are written
    found = spark.createDataFrame([], "trie int, nth long, a long")
    for c in counts:
        found = found.unionByName(c)
    counted = staged(_phrases(built, numbers).join(found, ["trie", "nth"]).where(F.col("a") >= LEAST)
                     .select("h1", "h2", "h3", "a"), "pc-counted")
    for table in (coded, two, three, built, *counts):
        discard(table)
    total = every.groupBy("lang").agg(F.sum("f").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (scored(counted, frequent).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
            .join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def query(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


# Whole words and pieces as in the operator; phrases by position, scores in 128-bit integers.
SQL = f"""
WITH t AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ',;:!?',
                   'abcdefghijklmnopqrstuvwxyz ........' || '.') AS text FROM documents),
p AS (SELECT d, lang, unnest(x) AS piece, generate_subscripts(x, 1) AS k FROM (SELECT d, lang, string_split(text, '.') AS x FROM t)),
w AS (SELECT lang, d, k, list_filter(string_split(piece, ' '), lambda x: x <> '') AS ws FROM p),
g AS (SELECT lang, d, k, unnest(ws) AS w1, unnest(list_concat(ws[2:], [NULL])) AS w2, unnest(list_concat(ws[3:], [NULL, NULL])) AS w3
      FROM (SELECT * FROM w WHERE len(ws) > 1)),
one AS (SELECT lang, word, count(*) AS f FROM (SELECT lang, unnest(ws) AS word FROM w) GROUP BY ALL),
two AS (SELECT lang, w1, w2, count(*) AS a FROM g WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= {LEAST}),
three AS (SELECT lang, w1, w2, w3, count(*) AS a FROM g WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= {LEAST}),
longer AS (SELECT lang, w1, w2, max(a) AS m FROM (SELECT lang, w1, w2, a FROM three UNION ALL SELECT lang, w2, w3, a FROM three) GROUP BY ALL),
s2 AS (SELECT lang, w1 || ' ' || w2 AS phrase, a, l.f AS l, r.f AS r, ({SCALE}::HUGEINT * a * a) // (l.f::HUGEINT * r.f) AS score
       FROM two LEFT JOIN longer USING (lang, w1, w2) JOIN one l ON l.lang = two.lang AND l.word = w1 JOIN one r ON r.lang = two.lang AND r.word = w2
       WHERE m IS NULL OR 100 * m < {COVERED} * a),
c3 AS (SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3 AS phrase, t.a, f1.f AS f1, f3.f AS f3, x.a AS f12, y.a AS f23,
              ({SCALE}::HUGEINT * t.a * t.a) // (f1.f::HUGEINT * y.a) AS s1, ({SCALE}::HUGEINT * t.a * t.a) // (x.a::HUGEINT * f3.f) AS s2
       FROM three t JOIN two x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2 JOIN two y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
       JOIN one f1 ON f1.lang = t.lang AND f1.word = t.w1 JOIN one f3 ON f3.lang = t.lang AND f3.word = t.w3),
s AS (SELECT * FROM s2 UNION ALL
      SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN f1 ELSE f12 END, CASE WHEN s1 <= s2 THEN f23 ELSE f3 END, least(s1, s2) FROM c3),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM one GROUP BY lang)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM s) JOIN n USING (lang)
WHERE rank <= {TOP}"""
