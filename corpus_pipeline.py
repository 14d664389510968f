"""A training-corpus pipeline out of the operators of ``tidemark.llm``.

`STAGES` lists (name, function) pairs; every function takes ``(spark, docs, sf_dir)`` and returns a
DataFrame that is written as Parquet and re-read as the next stage's ``docs``. All but the last
return the columns of ``documents``. Every stage works on all its predecessor kept.

Defined cases, beside those of the operators: null ids pass through; an empty table passes through every
stage; extra columns of ``docs`` are dropped. Null texts come out of suffix-array dedup as empty ones.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, simhash_dedup, source_mixing, suffix_dedup, toxicity
from tidemark.llm.common import discard, slices, staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 by a classifier fitted on this stage's documents and the labels."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model, keep=COLUMNS).where("score < 0.5").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id (null ids last). Of
    several rows with that id the one with the smallest text hash stays, of equal rows one."""
    key = F.coalesce(docs["doc_id"].cast("long"), F.lit((1 << 63) - 1))
    kept = (simhash_dedup.simhash_dedup(docs)
            .withColumn("key", F.coalesce("id", F.lit((1 << 63) - 1)))
            .groupBy("group").agg(F.min(F.struct("key", "row")).alias("one")).select("one.key", "one.row").distinct())
    return (docs.select(*COLUMNS, key.alias("key"), F.xxhash64("text").alias("row"))
            .join(kept, ["key", "row"], "left_semi").dropDuplicates(["key", "row"]).select(*COLUMNS))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes covered by a 50-byte string of a smaller id; characters cut in half at the
    edge of a removed passage go, too."""
    def decode(batches):
        for b in slices(batches):
            text = [(x or b"").decode("utf-8", "ignore") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(text, pa.string()), b.column(2), b.column(3)],
                                             ["doc_id", "text", "lang", "source"])

    return (suffix_dedup.suffix_dedup(docs, keep=["lang", "source"]).select("id", "kept", "keep_0", "keep_1")
            .mapInArrow(decode, "doc_id long, text string, lang string, source string")
            .withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by the token budgets of their domain, language and source, once per epoch taken."""
    return source_mixing.mix(docs).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and the decoded text of every row."""
    return byte_bpe.round_trip(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_copies),
    ("suffix-array dedup", drop_repeated_passages),
    ("source mixing", mix_sources),
    ("byte-level BPE", encode),
]

# Several stages are beyond SQL (learned scores, XXH64 fingerprints): tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written and re-read."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
