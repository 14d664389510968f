"""Substring dedup by sliding sentence spans.

A text is cut into sentences. At every sentence a run starts: the shortest run of at least
``SENTENCES`` consecutive sentences with at least ``WORDS`` words (none, if the text ends before).
With ``every``, the shortest run that ends at every sentence is listed too, and a sentence is covered
if any run, however long, covers it; without, the tail of a repeat can stay. With ``words=0`` a run is defined
by its sentences alone: `op1_substring_dedup` is ``every`` with ``words=0``, the whole job.
Every listed run is hashed (128 bits) and the hashes are joined over the whole table. A run that also occurs
in a row with a smaller id, or earlier in its own text, is a repeat; sentences covered by any repeat
are removed, repeats being judged on the input.

Scale. A row of the join is a run's hash with id, position and length: no text. The smallest id per
hash is a grouped minimum, combined before the shuffle; hashes that occur under one id only are
dropped; the join back is a plain equi-join whose hot keys Spark may split. Runs of one text are
listed per text only, each once however many rows are equal in id and text. Texts move once, to meet their own list of repeats.

Defined cases: null and empty texts have no sentences and stay as they are. Rows of equal id do not
remove each other's sentences (neither is smaller). A null id counts as larger than all others. White
space at a sentence's ends does not count for equality. Very long texts are handled whole; their runs are listed
once per text. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SENTENCES = 2
WORDS = 24
SENTENCE = r"[^.!?\n]*[.!?\n]+[ \t\r\n]*|[^.!?\n]+"
_sentences = re.compile(SENTENCE).findall
LAST = (1 << 63) - 1


def runs(text: str, sentences: int = SENTENCES, words: int = WORDS) -> tuple[list[str], list[int], list[bytes]]:
    """(sentences with their white space, length of the run that starts at each (0: none), hashes of
    the runs there are)."""
    pieces = _sentences(text)
    bare = [p.strip(" \t\r\n") for p in pieces]
    upto = np.zeros(len(bare) + 1, np.int64)
    np.cumsum([s.count(" ") + 1 if s else 0 for s in bare], out=upto[1:])
    n = len(bare)
    at = np.arange(n)
    end = np.maximum(np.searchsorted(upto, upto[:-1] + words), at + sentences)  # first end with enough words
    length = np.where(end <= n, end - at, 0).tolist()
    digest = xxhash.xxh3_128_digest
    return pieces, length, [digest("\x1f".join(bare[k:k + m]).encode()) for k, m in enumerate(length) if m]


def all_runs(text: str, sentences: int = SENTENCES, words: int = WORDS) -> tuple[list[str], list[tuple[int, int, bytes]]]:
    """(sentences with their white space, (position, length, hash) of the shortest run that starts at each
    sentence and of the shortest one that ends at each). They cover what all runs cover: a sentence
    of a run that the shortest run from its start does not reach is the end of another one inside it.
    Without a minimum of words a text of fewer sentences is one run."""
    pieces = _sentences(text)
    bare = [p.strip(" \t\r\n") for p in pieces]
    upto = np.zeros(len(bare) + 1, np.int64)
    np.cumsum([s.count(" ") + 1 if s else 0 for s in bare], out=upto[1:])
    n = len(bare)
    if not words:
        sentences = min(sentences, n) or 1
    at = np.arange(n + 1)
    end = np.maximum(np.searchsorted(upto, upto + words), at + sentences)  # first end with enough words
    start = np.minimum(np.searchsorted(upto, upto - words, side="right") - 1, at - sentences)  # last such start
    spans = {*zip(at[end <= n].tolist(), end[end <= n].tolist()), *zip(start[start >= 0].tolist(), at[start >= 0].tolist())}
    digest = xxhash.xxh3_128_digest
    return pieces, [(a, z - a, digest("\x1f".join(bare[a:z]).encode())) for a, z in sorted(spans)]


def listed(text: str, sentences: int, words: int, every: bool) -> tuple[list[str], list[tuple[int, int, bytes]]]:
    """(sentences with their white space, (position, length, hash) of the runs that are compared)."""
    if every:
        return all_runs(text, sentences, words)
    pieces, length, hashes = runs(text, sentences, words)
    return pieces, [(k, m, x) for (k, m), x in zip(((k, m) for k, m in enumerate(length) if m), hashes)]


def own_repeats(spans: list[tuple[int, int, bytes]]) -> tuple[list[tuple[int, int]], list[tuple[int, int, bytes]]]:
    """Runs of one text: (position, length) of those that occur earlier in it, and the first ones."""
    seen, again, first = set(), [], []
    for k, m, x in spans:
        if x in seen:
            again.append((k, m))
        else:
            seen.add(x)
            first.append((k, m, x))
    return again, first


def span_rows(docs: DataFrame, sentences: int, words: int, every: bool = False) -> DataFrame:
    """``key, row, pos, len, h1, h2`` of the first occurrence of every run within its text."""
    def run(batches):
        for b in batches:
            for k in range(0, b.num_rows, 512):
                part = b.slice(k, 512)
                out = [[], [], [], [], []]
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    if text:
                        _, first = own_repeats(listed(text, sentences, words, every)[1])
                        if first:
                            out[0] += [key] * len(first)
                            row = xxhash.xxh64_intdigest(text.encode(), 42)  # as Spark's xxhash64
                            out[1] += [row - (row >> 63 << 64)] * len(first)
                            for col, values in zip(out[2:], zip(*first)):
                                col += values
                h = np.frombuffer(b"".join(out[4]), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()),
                     pa.array(out[3], pa.int32()), pa.array(h[:, 0]), pa.array(h[:, 1])], ["key", "row", "pos", "len", "h1", "h2"])

    return docs.select("key", "text").mapInArrow(run, "key long, row long, pos int, len int, h1 long, h2 long")


def repeat_lists(spans: DataFrame) -> DataFrame:
    """``key, row, repeats``: the distinct runs of every text, combined before the shuffle, so that rows
    equal in id and text list no more than one of them."""
    return spans.groupBy("key", "row").agg(F.collect_set(F.struct("pos", "len")).alias("repeats"))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sentences: int = SENTENCES,
                    words: int = WORDS, every: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``id, n_sentences, n_removed, text`` (what is kept; null stays null).
    ``every``: judge all runs, not only the shortest one from each start."""
    base = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    base = base.withColumn("key", F.coalesce("id", F.lit(LAST)))
    spans = span_rows(base, sentences, words, every)
    shared = (spans.groupBy("h1", "h2").agg(F.min("key").alias("low"), F.max("key").alias("high"))
              .where("low < high").select("h1", "h2", "low"))
    repeats = repeat_lists(spans.join(shared, ["h1", "h2"]).where("key > low"))
    marked = (base.withColumn("row", F.xxhash64("text")).join(repeats, ["key", "row"], "left")
              .select("id", "text", "repeats.pos", "repeats.len"))

    def run(batches):
        for b in batches:
            counts, removed, kept = [], [], []
            for text, pos, size in zip(*(b.column(k).to_pylist() for k in (1, 2, 3))):
                pieces, found = listed(text or "", sentences, words, every)
                spans = own_repeats(found)[0] + list(zip(pos or [], size or []))
                gone = np.zeros(len(pieces) + 1, np.int64)
                for k, m in spans:
                    gone[k] += 1
                    gone[k + m] -= 1
                cover = (np.cumsum(gone)[:-1] > 0).tolist()
                counts.append(len(pieces))
                removed.append(sum(cover))
                kept.append("".join(p for p, c in zip(pieces, cover) if not c) if spans else text)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                                              pa.array(kept, pa.string())], ["id", "n_sentences", "n_removed", "text"])

    return marked.mapInArrow(run, "id long, n_sentences long, n_removed long, text string")


def query(spark, sf_dir: str) -> DataFrame:
    """Every run of ``SENTENCES`` or more sentences, however few words it has."""
    return (substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=0, every=True)
            .withColumnRenamed("id", "doc_id"))


def all_runs_query(spark, sf_dir: str) -> DataFrame:
    """Every run of sentences with at least ``WORDS`` words."""
    return (substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), every=True)
            .withColumnRenamed("id", "doc_id"))


def shortest_runs_query(spark, sf_dir: str) -> DataFrame:
    """Only the shortest run with at least ``WORDS`` words from each start: does less than the whole job."""
    return (substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
            .withColumnRenamed("id", "doc_id"))


SQL = f"""
WITH s AS (
  SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) AS pos
  FROM (SELECT doc_id, regexp_extract_all(text, '{SENTENCE.replace(chr(92) + "n", chr(10))}') AS p FROM documents)),
w AS (SELECT doc_id, pos, piece, trim(piece, ' ' || chr(9) || chr(10) || chr(13)) AS bare FROM s),
c AS (SELECT *, sum(CASE WHEN bare = '' THEN 0 ELSE length(bare) - length(replace(bare, ' ', '')) + 1 END)
                  OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM w),
ends AS (
  SELECT a.doc_id, a.pos, min(b.pos) AS last
  FROM (SELECT *, lag(upto, 1, 0) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM c) a
  JOIN c b ON b.doc_id = a.doc_id AND b.pos >= a.pos + {SENTENCES - 1} AND b.upto >= a.before + {WORDS}
  GROUP BY ALL),
r AS (SELECT e.doc_id, e.pos, e.last, string_agg(c.bare, chr(31) ORDER BY c.pos) AS run
      FROM ends e JOIN c ON c.doc_id = e.doc_id AND c.pos BETWEEN e.pos AND e.last GROUP BY ALL),
rep AS (SELECT doc_id, pos, last FROM (
          SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) AS k FROM r) WHERE k > 1),
gone AS (SELECT DISTINCT c.doc_id, c.pos FROM c JOIN rep ON c.doc_id = rep.doc_id AND c.pos BETWEEN rep.pos AND rep.last),
m AS (SELECT c.*, g.pos IS NOT NULL AS removed FROM c LEFT JOIN gone g ON g.doc_id = c.doc_id AND g.pos = c.pos)
SELECT d.doc_id, count(m.pos) AS n_sentences, coalesce(sum(m.removed::INT), 0)::BIGINT AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(string_agg(CASE WHEN NOT m.removed THEN m.piece END, '' ORDER BY m.pos), '') END AS text
FROM documents d LEFT JOIN m ON m.doc_id = d.doc_id GROUP BY d.doc_id, d.text"""



def _with_ends(ends: str) -> str:
    """`SQL` with another list of runs."""
    return SQL[:SQL.index("ends AS (")] + f"ends AS ({ends}),\n" + SQL[SQL.index("r AS (SELECT e."):]


# Every pair of ends, longest runs included: nothing of the shortest-run rule is taken over.
ALL_RUNS_SQL = _with_ends(f"""
  SELECT a.doc_id, a.pos, b.pos AS last
  FROM (SELECT *, lag(upto, 1, 0) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM c) a
  JOIN c b ON b.doc_id = a.doc_id AND b.pos >= a.pos + {SENTENCES - 1} AND b.upto >= a.before + {WORDS}""")

BY_SENTENCES_SQL = _with_ends(f"""
  SELECT a.doc_id, a.pos, b.pos AS last
  FROM (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n FROM c) a
  JOIN c b ON b.doc_id = a.doc_id AND b.pos >= a.pos + least({SENTENCES}, a.n) - 1""")
