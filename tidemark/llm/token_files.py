"""Token ids as binary files of independent zstandard frames with a trailing seek table.

Documents are encoded with a tokenizer of the ``tokenizers`` library, an end id is appended to each,
and the ids go out as little-endian unsigned 32-bit integers in ascending order of document id: one
file per range of ids, files in range order. A file is

    frame 0 | frame 1 | ... | index | seek table

Every frame is a zstandard frame of its own holding whole documents (about ``FRAME_IDS`` ids; a larger
document has a frame to itself). The index is a skippable frame with, compressed, the ids, lengths
and frame numbers of the documents. The seek table is the last skippable frame, in the seekable
zstandard layout: compressed size, size and checksum (low 32 bits of XXH64) of every frame, the
number of frames, a flag byte and the magic number. A reader fetches the tail, then only the
frames of the documents asked for, and checks each against its checksum.

Scale and recovery. The range partitioning is the only shuffle; a task streams its range into one
file under an attempt name and renames it when complete, so a repeated task replaces the file by an
equal one. File totals (one row per file) give each file's first position.

Encoding works white-space word by white-space word with a cache per worker: the tokenizer's
pattern never crosses white space, so the ids of a text are those of its words.

Defined cases: null text is empty and has the end id alone. Rows of equal id are ordered by the digest
of their text; null ids come first. A special token's string within a text is matched as the
library does by default. An empty table writes no files and reads back no rows. Extra
columns are ignored.
"""

from __future__ import annotations

import io
import os
import re
import struct
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import parts_for, slices, staged
from tidemark.session import scratch_path

FRAME_IDS = 1 << 16
FILE_BYTES = 32 << 20
CACHE_BYTES = 100 << 20  # of a generation of encoded words, about
MARK = "([a-z\u00df-\u00f6\u00f8-\u00ff])([.,;:!?])( |$)"
_LETTERS = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+").fullmatch  # one match of the pattern, left as it is by the normaliser
VOCABULARY = "word_bpe_49k.json"
SEPARATOR = "<|endoftext|>"
END_ID = 1
LEVEL = 3
# fixed values of the seekable zstandard layout
SKIPPABLE_INDEX, SKIPPABLE_SEEK, SEEK_MAGIC, CHECKSUM_FLAG = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80


class WordEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[k for t, k in vocabulary.items() if t.endswith("</w>")]] = True
        self.separator = vocabulary.get(SEPARATOR, -1)
        self.cache: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        self.room = CACHE_BYTES

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.room < 0:
            self.older, self.cache, self.room = self.cache, {"": b""}, CACHE_BYTES
        cache, older = self.cache, self.older
        # what the tokenizer does to every text anyway, done first so that fewer words differ: A-Z in lower
        # case (not near a special token, whose case matters), and a mark after a letter and before white
        # space apart from its word
        text = pa.array(texts, pa.large_string())
        low = pc.if_else(pc.match_substring(text, "<|"), text, pc.ascii_lower(text))
        low = pc.replace_substring_regex(pc.replace_substring(low, "\n", " "), MARK, r"\1 \2\3")
        words = pc.split_pattern(low, " ")
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = set(distinct).difference(cache)
        self.room -= 250 * len(new) + 2 * sum(map(len, new))
        known = {w for w in new if w in older}
        cache.update(zip(known, map(older.__getitem__, known)))
        missing = new - known
        plain = [w for w in missing if _LETTERS(w)]
        for k in range(0, len(plain), 4096):
            part = plain[k:k + 4096]
            lines = [" ".join(part[x:x + 64]) for x in range(0, len(part), 64)]
            ids = np.array(list(chain.from_iterable(e.ids for e in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False))), "<u4")
            cuts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(cuts) == len(part):  # a word of letters alone ends with the one token that ends a word
                raw = ids.tobytes()
                cache.update(zip(part, map(raw.__getitem__, map(slice, [0, *cuts[:-1]], cuts))))
        odd = missing.difference(cache)
        # words with marks, digits or other letters: many to a line, a special token between two, which cuts a
        # text before anything else is done to it
        sure = [w for w in odd if "<" not in w and ">" not in w and "|" not in w and w.strip() == w]
        for k in range(0, len(sure), 4096):
            part = sure[k:k + 4096]
            lines = [SEPARATOR.join([*part[x:x + 64], ""]) for x in range(0, len(part), 64)]
            ids = np.array(list(chain.from_iterable(e.ids for e in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False))), "<u4")
            stops = 4 * np.flatnonzero(ids == self.separator)
            if len(stops) == len(part):
                raw = ids.tobytes()
                cache.update(zip(part, map(raw.__getitem__, map(slice, [0, *(stops[:-1] + 4).tolist()], stops.tolist()))))
        rest = list(odd.difference(cache))
        for k in range(0, len(rest), 5000):
            part = rest[k:k + 5000]
            for w, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                cache[w] = array("I", e.ids).tobytes()
        # the distinct words' ids one after another, then gathered for every word of every text
        found = list(map(cache.__getitem__, distinct))
        ids = np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begins = np.cumsum(sizes) - sizes
        at = coded.indices.to_numpy()
        n = sizes[at]
        ends = np.concatenate([[0], np.cumsum(n)])
        raw = ids[np.arange(ends[-1]) + np.repeat(begins[at] - ends[:-1], n)].tobytes()
        cuts = (4 * ends[words.offsets.to_numpy()]).tolist()
        return list(map(raw.__getitem__, map(slice, cuts, cuts[1:])))


_encoders: dict[str, WordEncoder] = {}


def encoder(vocabulary: str = VOCABULARY) -> WordEncoder:
    import public_tokenizers

    path = public_tokenizers.path(vocabulary)
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


class FrameWriter:
    """Writes one file; `add` documents in order, then `close`."""

    def __init__(self, out):
        self.out, self.table, self.pending, self.size = out, [], [], 0
        self.ids, self.lengths, self.frames = [], [], []
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if self.size and self.size + len(ids) > 4 * FRAME_IDS:
            self._frame()
        self.pending.append(ids)
        self.size += len(ids)
        self.ids.append(doc_id)
        self.lengths.append(len(ids) // 4)
        self.frames.append(len(self.table))

    def _frame(self) -> None:
        data = b"".join(self.pending)
        packed = self.packer.compress(data)
        self.out.write(packed)
        self.table.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.pending, self.size = [], 0

    def close(self) -> None:
        if self.pending:
            self._frame()
        null = np.array([i is None for i in self.ids], np.uint8)
        ids = np.array([i or 0 for i in self.ids], "<i8")
        body = self.packer.compress(b"".join([struct.pack("<Q", len(ids)), null.tobytes(), ids.tobytes(),
                                              np.array(self.lengths, "<i8").tobytes(), np.array(self.frames, "<i8").tobytes()]))
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(body)) + body)
        self.table.append((len(body) + 8, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
        seek = b"".join(struct.pack("<III", *row) for row in self.table) + struct.pack("<IBI", len(self.table), CHECKSUM_FLAG, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK, len(seek)) + seek)


class FrameReader:
    """Reads documents of one file by the seek table and the index."""

    def __init__(self, source):
        self.source = source
        size = source.size() if hasattr(source, "size") and callable(source.size) else source.seek(0, io.SEEK_END)
        source.seek(size - 9)
        count, flag, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEK_MAGIC or not flag & CHECKSUM_FLAG:
            raise ValueError("no seek table with checksums at the end of the file")
        source.seek(size - 9 - 12 * count)
        self.table = np.frombuffer(source.read(12 * count), "<u4").reshape(count, 3).astype(np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.table[:, 0])])
        source.seek(int(self.begins[count - 1]) + 8)
        body = zstandard.ZstdDecompressor().decompress(source.read(int(self.table[-1, 0]) - 8))
        n = struct.unpack_from("<Q", body)[0]
        null = np.frombuffer(body, np.uint8, n, 8)
        ids, self.lengths, self.frames = np.frombuffer(body, "<i8", 3 * n, 8 + n).reshape(3, n)
        self.ids = [None if x else i for i, x in zip(ids.tolist(), null.tolist())]
        self.last = (-1, b"")

    def frame(self, k: int) -> bytes:
        if self.last[0] != k:
            size, raw, check = self.table[k].tolist()
            self.source.seek(int(self.begins[k]))
            data = zstandard.ZstdDecompressor().decompress(self.source.read(size), max_output_size=raw)
            if len(data) != raw or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
                raise ValueError(f"frame {k} does not match its checksum")
            self.last = (k, data)
        return self.last[1]

    def documents(self, wanted: set | None = None):
        """(id, position of the first id in the file, ids as bytes) of the wanted documents (all)."""
        starts = np.cumsum(self.lengths) - self.lengths
        first = np.searchsorted(self.frames, np.arange(len(self.table)))
        for k, doc_id in enumerate(self.ids):
            if wanted is None or doc_id in wanted:
                f = int(self.frames[k])
                at = 4 * int(starts[k] - starts[first[f]])
                yield doc_id, int(starts[k]), self.frame(f)[at:at + 4 * int(self.lengths[k])]


def write_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str = VOCABULARY, end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write all rows of ``docs`` under ``path`` (a folder every executor reaches); returns the
    staged manifest: ``part, file, docs, tokens, start`` (tokens of the files before it)."""
    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    n = parts_for(rows.agg(F.sum(F.octet_length("text"))).first()[0], file_bytes)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        store, folder = fs.FileSystem.from_uri(path)
        name = f"part-{part:06d}.zst"
        temp = f"{folder}/.{name}.{attempt}"
        writer = sink = None
        for b in batches:
            if b.num_rows and writer is None:
                store.create_dir(folder, recursive=True)
                sink = store.open_output_stream(temp)
                writer = FrameWriter(sink)
            for part_ in slices([b]):
                texts = [t or "" for t in part_.column(1).to_pylist()]
                for i, data in zip(part_.column(0).to_pylist(), encoder(vocabulary).encode(texts)):
                    writer.add(i, data + end)
        if writer is not None:
            writer.close()
            sink.close()
            store.move(temp, f"{folder}/{name}")
            yield pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.array([f"{path}/{name}"]), pa.array([len(writer.ids)]), pa.array([sum(writer.lengths)])],
                ["part", "file", "docs", "tokens"])

    digest = F.xxhash64("text")
    files = staged(rows.repartitionByRange(n, "id", digest).sortWithinPartitions("id", digest, "text")
                   .mapInArrow(run, "part long, file string, docs long, tokens long"), "token-files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return staged(files.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0).cast("long"))), "token-manifest")


def read_tokens(manifest: DataFrame, wanted: set[int] | None = None) -> DataFrame:
    """``id, start, ids`` (bytes) of the wanted documents (default: all) of the files of ``manifest``."""
    def run(batches):
        for b in batches:
            for file, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                store, place = fs.FileSystem.from_uri(file)
                out, size = [], 0
                with store.open_input_file(place) as source:
                    for doc_id, at, data in FrameReader(source).documents(wanted):
                        out.append((doc_id, start + at, data))
                        size += len(data)
                        if size > 8 << 20:
                            yield _rows(out)
                            out, size = [], 0
                yield _rows(out)

    files = max(1, manifest.count())  # one small row per file; a number keeps one task from reading them all
    return (manifest.select("file", "start").repartition(files, "file")
            .mapInArrow(run, "id long, start long, ids binary"))


def _rows(out: list) -> pa.RecordBatch:
    ids, starts, data = zip(*out) if out else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(data, pa.binary())],
                                      ["id", "start", "ids"])


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = scratch_path(spark, "llm-tokens")
    manifest = write_tokens(docs, path if "://" in path or path.startswith("file:") else f"file://{path}")
    return read_tokens(manifest).select(F.col("id").alias("doc_id"), "start",
                                        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                                        F.crc32("ids").alias("ids_crc32"))
