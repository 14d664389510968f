"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over the presence of hashed words and word prefixes is trained in numpy from confirmed toxic texts
(positive) and texts without regard to their label (unlabelled). With class prior p the risk

    p * R+(positive)  +  max(0, R-(unlabelled) - p * R-(positive))

(logistic loss) estimates the risk of full supervision without negative labels; when the second
term falls below zero its gradient is reversed, which keeps the model from fitting the
unlabelled sample. The prior is the toxic share among the labelled training rows.

Bounds. The fit reads at most ``positives`` toxic and ``unlabelled`` other documents, the ones with
the smallest hash of their id (a documented sample), one row of each: of several rows of an id the one
whose text has the smallest hash. Only features found in 0.4 % of the sampled
positives and with a clear difference between the samples are used; the sample's occurrences of
them, not its texts, come to the driver. Every word of every text of the whole table is scored,
inside the tasks, with the vocabulary and weights (a few thousand numbers) broadcast.

Defined cases: null text is an empty text, scored by the bias alone. Without any positive
training row all scores are the prior (0 without labels). Null ids are scored, never trained on.
A repeated id in ``labels`` counts as toxic if any of its rows is. Rows of equal id are scored row
by row. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, one_row_each, slices, staged
from tidemark.llm.wordhash import Vocabulary, known_features

POSITIVES = 3000
UNLABELLED = 9000
STEPS = 250


def held_out_rule(id_col: Column) -> Column:
    """True for the rows whose labels are never learned from: crc32 of the id as text, mod 5 = 0."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 0, F.lit(False))


def _per_document(texts, vocabulary=None) -> list[np.ndarray]:
    out = [np.zeros(0, np.uint32)] * len(texts)
    for a, _, doc, feature in known_features(texts, vocabulary):
        found, begin = np.unique(doc, return_index=True)
        for d, part in zip(found.tolist(), np.split(feature.astype(np.uint32), begin[1:])):
            out[a + d] = part
    return out


def _encoded(column) -> list[bytes]:
    return [(t or "").encode() for t in column.to_pylist()]


def informative(df_pos: np.ndarray, df_unl: np.ndarray, n_pos: int, n_unl: int, z: float = 4.0) -> np.ndarray:
    """Which features differ in frequency between the two samples by more than ``z`` standard errors."""
    a, b = df_pos / n_pos, df_unl / n_unl
    mid = (df_pos + df_unl) / (n_pos + n_unl)
    return np.abs(a - b) > z * np.sqrt(np.maximum(mid * (1 - mid), 1e-9) * (1 / n_pos + 1 / n_unl))


def fit_pu(pos: list[np.ndarray], unl: list[np.ndarray], size: int, prior: float, steps: int = STEPS,
           rate: float = 0.08, decay: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights of ``size`` features and the bias that minimise the non-negative PU risk."""
    def rows(docs):
        return np.concatenate(docs).astype(np.int64), np.repeat(np.arange(len(docs)), [len(d) for d in docs])

    def sig(x):
        return 1 / (1 + np.exp(-np.clip(x, -40, 40)))

    (pc, pr), (uc, ur) = rows(pos), rows(unl)
    w, bias = np.zeros(size), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, steps + 1):
        gp = np.bincount(pr, w[pc], len(pos)) + bias
        gu = np.bincount(ur, w[uc], len(unl)) + bias
        sp, su = sig(gp), sig(gu)
        if np.logaddexp(0, gu).mean() >= prior * np.logaddexp(0, gp).mean():
            dp, du = np.full(len(pos), -prior / len(pos)), su / len(unl)
        else:
            dp, du = prior * sp / len(pos), -su / len(unl)
        grad = np.append(np.bincount(pc, dp[pr], size) + np.bincount(uc, du[ur], size) + decay * w,
                         dp.sum() + du.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, bias = w - step[:-1], bias - step[-1]
    return w, bias


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED,
          id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> tuple[Vocabulary, np.ndarray, float]:
    """(vocabulary, weights, bias) fitted on the training rows; see the module docstring."""
    ids = (docs.select(docs[id_col].cast("long").alias("id")).where("id is not null")
           .where(~held_out_rule(F.col("id"))))
    marks = (labels.select(labels[id_col].cast("long").alias("id"), labels[label_col].cast("int").alias("y"))
             .where("id is not null and y is not null").where(~held_out_rule(F.col("id")))
             .groupBy("id").agg(F.max("y").alias("y")))
    marks = marks.join(ids.distinct(), "id", "left_semi")
    n, toxic = marks.agg(F.count(F.lit(1)), F.sum("y")).first()
    if not n or not toxic:
        return Vocabulary(np.zeros(0)), np.zeros(0), -40.0
    prior = min(max(toxic / n, 1e-4), 0.5)
    pos = marks.where("y = 1").select("id").orderBy(F.xxhash64("id"), "id").limit(positives)
    unl = ids.distinct().orderBy(F.xxhash64(F.lit(1), "id"), "id").limit(unlabelled)
    chosen = pos.withColumn("kind", F.lit(1)).unionByName(unl.withColumn("kind", F.lit(0)))
    text = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    # at most positives + unlabelled ids of 16 bytes: a proven bound for the broadcast
    sample = staged(one_row_each(text.join(F.broadcast(chosen), "id"), "id", "kind").select("text", "kind"), "pu-sample")

    def count(batches):
        for b in slices(batches):
            for _, _, _, feature in known_features(_encoded(b.column(0))):
                h, k = np.unique(feature, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(k)], ["h", "k"])

    least = max(3, 0.004 * min(positives, toxic))
    frequent = (sample.where("kind = 1").select("text").mapInArrow(count, "h long, k long")
                .groupBy("h").agg(F.sum("k").alias("k")).where(F.col("k") >= least).select("h").collect())
    vocabulary = Vocabulary(np.array([r.h for r in frequent], np.int64))

    def presence(batches):
        for b in slices(batches):
            found = _per_document(_encoded(b.column(0)), vocabulary)
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array([x.tobytes() for x in found], pa.binary())],
                                             ["kind", "idx"])

    got = sample.select("text", "kind").mapInArrow(presence, "kind int, idx binary").collect()
    discard(sample)
    pos = [np.frombuffer(r.idx, np.uint32) for r in got if r.kind == 1]
    unl = [np.frombuffer(r.idx, np.uint32) for r in got if r.kind == 0]
    size = len(vocabulary.features)
    df_pos, df_unl = (np.bincount(np.concatenate(x), minlength=size) for x in (pos, unl))
    used = informative(df_pos, df_unl, len(pos), len(unl))
    place = np.cumsum(used) - 1
    pos, unl = ([place[d[used[d]]] for d in x] for x in (pos, unl))
    weights, bias = fit_pu(pos, unl, int(used.sum()), prior)
    return Vocabulary(vocabulary.features[used]), weights, bias


def score(docs: DataFrame, model: tuple[Vocabulary, np.ndarray, float], id_col: str = "doc_id",
          text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``id, score`` and the columns named in ``keep`` for every row of ``docs``."""
    keep = keep or []
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # a text that is kept anyway crosses to the task once
    place = 1 + keep.index(text_col) if text_col in keep else len(keep) + 1
    frame = docs.select(docs[id_col].cast("long").alias("__id"), *[docs[c] for c in keep],
                        *([] if text_col in keep else [docs[text_col].cast("string").alias("__text")]))
    kept = "".join(f", `{c}` {frame.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches):
        vocabulary, w, bias = shared.value
        for b in slices(batches):
            texts = _encoded(b.column(place))
            total = np.full(len(texts), bias)
            for a, z, doc, feature in known_features(texts, vocabulary):
                total[a:z] += np.bincount(doc, w[feature], z - a)
            p = 1 / (1 + np.exp(-np.clip(total, -40, 40)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p), *[b.column(1 + k) for k in range(len(keep))]],
                                             ["id", "score", *keep])

    return frame.mapInArrow(run, "id long, score double" + kept)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score(docs, train(docs, labels)).select(
        F.col("id").alias("doc_id"), held_out_rule(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
