"""Quality classifier by hierarchical empirical Bayes.

Three sources of evidence on a document are combined:

* a logistic classifier (numpy, Newton steps) over the byte frequencies and a few shape figures of the
  whole text, fitted on a bounded sample of labelled documents;
* the posterior quality rate of its host, shrunk toward the global rate;
* the posterior quality rate of its path (the first directory under the host), shrunk toward the host's.

The rates are grouped sums of the classifier's probabilities over all documents. How strongly a site is
shrunk follows from the data: the variance between sites beyond what sampling explains gives the
weight of the prior in documents (method of moments). A document does not count for its own
site's rate. With rate r and the classifier's evidence e (log odds beyond the training rate), the
score is the probability with log odds logit(r) + e; documents with 0.5 or more are kept.

Scale. Texts are read once for scoring; the site levels are grouped sums of integers (millionths), so the
result does not depend on partitioning, combined before the shuffle. The site table is joined
back by key; Spark may split hot hosts. At most ``SAMPLE`` feature rows come to the driver.

Defined cases: null text is empty. A null host or path is a site of its own. Without labels, or with
labels of one class only, the classifier has no evidence and its probability is the labelled rate
(0.5 without labels). Repeated ids in ``labels`` count as bad if any row is. Rows of equal id are scored
row by row; null ids are scored, not trained on. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import one_row_each, staged
from tidemark.llm.toxicity import held_out_rule

SAMPLE = 8000
UNIT = 1_000_000
FEATURES = 261


def features(text: str | None) -> np.ndarray:
    """Square roots of the 256 byte frequencies, and length, repeated lines, distinct words, mean word and
    line length."""
    text = text or ""
    raw = text.encode()
    n, words, lines = len(raw) + 1, text.split(), text.split("\n")
    out = np.empty(FEATURES)
    out[:256] = np.sqrt(np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / n)
    out[256:] = (np.log1p(n) / 10, 1 - len(set(lines)) / len(lines), len(set(words)) / (len(words) + 1),
                 n / (len(words) + 1) / 20, n / len(lines) / 500)
    return out


class Logistic:
    """Ridge logistic regression on standardised features; ``evidence`` is the log odds beyond ``rate``."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 2.0, steps: int = 25):
        self.rate = float(y.mean()) if len(y) else 0.5
        self.mean, self.scale = np.zeros(FEATURES), np.ones(FEATURES)
        self.w = np.zeros(FEATURES + 1)
        self.known = len(y) > 0 and 0 < self.rate < 1
        if not self.known:
            return
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        z = np.column_stack([(x - self.mean) / self.scale, np.ones(len(x))])
        self.w[-1] = np.log(self.rate / (1 - self.rate))
        pull = np.append(np.full(FEATURES, ridge), 1e-6)
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ self.w, -30, 30)))
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(pull), z.T @ (p - y) + pull * self.w)
            self.w -= step
            if np.abs(step).max() < 1e-6:
                break

    def probability(self, x: np.ndarray) -> np.ndarray:
        if not self.known:
            return np.full(len(x), self.rate)
        return 1 / (1 + np.exp(-np.clip(((x - self.mean) / self.scale) @ self.w[:-1] + self.w[-1], -13, 13)))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> Logistic:
    """Fit on at most ``sample`` labelled rows outside `held_out_rule`, the ones with the smallest hash
    of their id; of several rows of an id the one whose text has the smallest hash."""
    marks = (labels.select(labels[id_col].cast("long").alias("id"), labels[label_col].cast("int").alias("y"))
             .where("id is not null and y is not null").where(~held_out_rule(F.col("id")))
             .groupBy("id").agg(F.min("y").alias("y")))
    ids = docs.select(docs[id_col].cast("long").alias("id"))
    chosen = marks.join(ids, "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(sample)

    def run(batches):
        for b in batches:
            rows = [features(t).astype("<f4").tobytes() for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), b.column(1)], ["x", "y"])

    text = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    # at most ``sample`` ids of 12 bytes: a proven bound for the broadcast
    got = (one_row_each(text.join(F.broadcast(chosen), "id"), "id", "y").select("text", "y")
           .mapInArrow(run, "x binary, y int").collect())
    x = np.array([np.frombuffer(r.x, "<f4") for r in got], np.float64).reshape(len(got), FEATURES)
    return Logistic(x, np.array([r.y for r in got], np.float64))


def _concentration(groups: DataFrame, rate: Column, n: str, s: str) -> float:
    """Weight of the prior, in documents, by the method of moments over groups with ``n`` documents, ``s``
    expected good ones, around ``rate``."""
    spread = F.col(n) * F.pow(F.col(s) / F.col(n) - rate, 2)
    noise = rate * (1 - rate)
    r = groups.agg(F.sum(spread), F.sum(noise), F.sum(n), F.sum(F.col(n) * F.col(n)), F.avg(noise)).first()
    if not r[2] or not r[4]:
        return 1e6
    size = r[2] - r[3] / r[2]
    between = (r[0] - r[1]) / size if size > 0 else 0.0
    return float(min(max(r[4] / between - 1, 1.0), 1e6)) if between > 0 else 1e6


def quality(docs: DataFrame, model: Logistic, host: Column, path: Column, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id, host, path, doc_score, host_rate, path_rate, score, kept``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            p = np.empty(b.num_rows)
            for k in range(0, b.num_rows, 1024):
                texts = b.column(3).slice(k, 1024).to_pylist()
                p[k:k + len(texts)] = shared.value.probability(np.array([features(t) for t in texts]))
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(3)), pa.array(np.rint(p * UNIT).astype(np.int64))],
                                             ["id", "host", "path", "p"])

    scored = staged(docs.select(docs[id_col].cast("long").alias("id"), F.coalesce(host, F.lit("")).alias("host"),
                                F.coalesce(path, F.lit("")).alias("path"), docs[text_col].cast("string").alias("text"))
                    .mapInArrow(run, "id long, host string, path string, p long"), "quality-scored")
    paths = staged(scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("s")), "quality-paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))
    total = hosts.agg(F.sum("hn"), F.sum("hs")).first()
    rate = F.lit(min(max(total[1] / total[0] / UNIT, 1e-6), 1 - 1e-6) if total[0] else 0.5)
    units = hosts.select("hn", (F.col("hs") / UNIT).alias("hs"))
    k_host = F.lit(_concentration(units, rate, "hn", "hs"))
    sites = paths.join(hosts, "host")
    host_rate = (F.col("hs") / UNIT + k_host * rate) / (F.col("hn") + k_host)
    k_path = F.lit(_concentration(sites.select("n", (F.col("s") / UNIT).alias("s"), host_rate.alias("r")), F.col("r"), "n", "s"))
    p = F.col("p") / UNIT
    joined = (scored.join(sites, ["host", "path"])
              .withColumn("host_rate", (F.col("hs") / UNIT - p + k_host * rate) / (F.col("hn") - 1 + k_host))
              .withColumn("path_rate", (F.col("s") / UNIT - p + k_path * F.col("host_rate")) / (F.col("n") - 1 + k_path)))
    clip = lambda x: F.least(F.greatest(x, F.lit(1e-6)), F.lit(1 - 1e-6))
    logit = lambda x: F.log(clip(x) / (1 - clip(x)))
    prior = logit(F.lit(model.rate))
    score = 1 / (1 + F.exp(-(logit(F.col("path_rate")) + logit(p) - prior)))
    return joined.select("id", "host", "path", p.alias("doc_score"), "host_rate", "path_rate", score.alias("score"),
                         (score >= 0.5).alias("kept"))


def sited(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """``docs`` with ``__host`` and ``__path``: those of the document's page (the page whose url ends in
    the document's number; the smallest url of several), else its source and language."""
    number = F.regexp_extract("url", "/([0-9]{1,18})(\\.html)?/?([?#].*)?$", 1)
    urls = (pages.select(F.expr("url"), number.alias("num")).where("num <> ''")
            .groupBy(F.col("num").cast("long").alias("__num")).agg(F.min("url").alias("__url")))
    host = F.regexp_extract("__url", "^[a-z]+://([^/?#]+)", 1)
    first = F.regexp_extract("__url", "^[a-z]+://[^/?#]+/([^/?#]*)", 1)
    return (docs.join(urls, docs["doc_id"] == urls["__num"], "left")
            .withColumn("__host", F.when(F.col("__url").isNotNull(), host).otherwise(docs["source"]))
            .withColumn("__path", F.when(F.col("__url").isNotNull(), first).otherwise(docs["lang"])))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    at = sited(docs, spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return quality(at, model, F.col("__host"), F.col("__path")).withColumnRenamed("id", "doc_id")
