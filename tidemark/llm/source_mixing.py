"""Mixing sources to target weights by hierarchical budgeting (DataFrame functions only).

Documents belong to a leaf of the tree domain -> language -> source. A token budget is handed down
the tree: a node divides what it gets among its children by their weights, but no child gets more
than its subtree can supply (``max_epochs`` times its tokens); what a child cannot take is divided
among its siblings by their weights, and only when all of them are full does it go unused
at this level, which the level above has already accounted for by the subtree's capacity. So
shortages are made up by siblings first, then by the parent's siblings, and so on.

A leaf with budget b and a tokens is read for b div a whole epochs; of the next epoch, a seeded
permutation of the leaf, the longest prefix of documents with at most b mod a tokens is taken.

Native and skew-safe: the tree is a table of sums (one row per leaf); the prefix is found by
cumulative sums over ranges of the permutation key (``16 ** digits`` buckets, pre-aggregated per
leaf and bucket), and only the bucket that holds the cut is summed document by document. That
gives each leaf a key at which to cut, and taking documents is a filter on their key. A leaf
with a third of all rows is never sorted in one task.

Integers throughout: weights are integers relative to their siblings, shares are rounded down.

Defined cases: null domain, language or source form a leaf of their own. Null and empty texts have 0
tokens and are taken with the whole epochs of their leaf (and with the prefix if it reaches
them). Rows of equal id are ordered by their text's digest, and rows equal in both are taken or
left together. A null id counts as an empty one. Weights missing from the table are 1; weight 0 takes
nothing. An empty table gives an empty result. Extra columns pass through; internal columns carry
a ``__mix_`` prefix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import discard, staged

DIGITS = 3
SEED = 17
MAX_EPOCHS = 3
BUDGET_PERCENT = 80
TOKEN = "[^ \\t\\n\\r]+"
LEVELS = ("__mix_domain", "__mix_lang", "__mix_source")
DOMAIN_WEIGHTS = {"d0": 4, "d1": 3, "d2": 2, "d3": 1}
LANG_WEIGHTS = {"en": 6, "de": 2, "fr": 2, "es": 1}


def domain_of(source: Column) -> Column:
    """The domain of a source of the documents table: its number modulo 4 (``d-`` without one)."""
    number = F.regexp_extract(source, "([0-9]{1,9})$", 1)
    return F.concat(F.lit("d"), F.when(number.isNull() | (number == ""), F.lit("-"))
                    .otherwise((number.cast("int") % 4).cast("string")))


def weight_of(name: Column, weights: dict[str, int]) -> Column:
    out = F.lit(1)
    for k, v in weights.items():
        out = F.when(name == k, F.lit(int(v))).otherwise(out)
    return out.cast("long")


def divide(children: DataFrame, parent: list[str], budget: str = "given", capacity: str = "cap",
           weight: str = "weight", order: tuple[str, ...] = ()) -> DataFrame:
    """Give every row of ``children`` its share (column ``share``) of its parent's ``budget``.

    With children in ascending order of capacity / weight, a child is full exactly if its capacity is
    no more than its weighted part of what the children before it have left; the others divide
    the rest by weight."""
    d = "decimal(38,0)"
    ratio = F.when(F.col(weight) > 0, F.col(capacity).cast("double") / F.col(weight)).otherwise(F.lit(float("inf")))
    by = Window.partitionBy(*parent)
    upto = by.orderBy("__mix_ratio", *order).rowsBetween(Window.unboundedPreceding, -1)
    rest = by.orderBy("__mix_ratio", *order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    full = ((F.col(capacity).cast(d) * F.col("__mix_w").cast(d) <= (F.col(budget) - F.col("__mix_c")).cast(d) * F.col(weight).cast(d))
            & (F.col(weight) > 0))
    return (children.withColumn("__mix_ratio", ratio)
            .withColumn("__mix_c", F.coalesce(F.sum(capacity).over(upto), F.lit(0).cast("long")))
            .withColumn("__mix_w", F.sum(weight).over(rest))
            .withColumn("__mix_full", full)
            .withColumn("__mix_fc", F.sum(F.when(F.col("__mix_full"), F.col(capacity)).otherwise(F.lit(0).cast("long"))).over(by))
            .withColumn("__mix_fw", F.sum(F.when(~F.col("__mix_full"), F.col(weight)).otherwise(F.lit(0).cast("long"))).over(by))
            .withColumn("share", F.when(F.col("__mix_full"), F.col(capacity))
                        .when((F.col(weight) > 0) & (F.col("__mix_fw") > 0),
                              F.expr(f"cast(cast({budget} - __mix_fc as decimal(38,0)) * {weight} div __mix_fw as bigint)"))
                        .otherwise(F.lit(0).cast("long")))
            .drop("__mix_ratio", "__mix_c", "__mix_w", "__mix_full", "__mix_fc", "__mix_fw"))


def budgets(leaves: DataFrame, budget_percent: int = BUDGET_PERCENT, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Leaf budgets: ``leaves`` has the three LEVELS, their weights ``w0, w1, w2`` and ``tokens``.
    The budget of the root is ``budget_percent`` of all tokens. Adds ``given``."""
    a, b, c = LEVELS
    cap = leaves.withColumn("cap", F.col("tokens") * F.lit(max_epochs))
    domains = cap.groupBy(a, F.col("w0").alias("weight")).agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("t"))
    top = divide(domains.withColumn("root", F.lit(0))
                 .withColumn("given", F.expr(f"cast(sum(t) over (partition by root) * {budget_percent} div 100 as bigint)")),
                 ["root"], order=(a,))
    top = top.select(a, F.col("share").alias("given"))
    langs = cap.groupBy(a, b, F.col("w1").alias("weight")).agg(F.sum("cap").alias("cap"))
    mid = divide(langs.join(top.withColumnRenamed(a, "ja"), F.col(a).eqNullSafe(F.col("ja"))).drop("ja"), [a], order=(b,))
    mid = mid.select(F.col(a).alias("ja"), F.col(b).alias("jb"), F.col("share").alias("given"))
    low = cap.join(mid, F.col(a).eqNullSafe(F.col("ja")) & F.col(b).eqNullSafe(F.col("jb"))).drop("ja", "jb")
    return divide(low.withColumnRenamed("w2", "weight"), [a, b], order=(c,)).select(
        a, b, c, "__mix_leaf", "tokens", F.col("share").alias("given"))


def _key(epoch: Column, ident: Column, digest: Column, seed: int) -> Column:
    """Position of a document in the seeded permutation of an epoch, as a string to sort by."""
    return F.concat_ws("|", F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), ident)), ident, digest)


def cuts(thin: DataFrame, plan: DataFrame, seed: int, digits: int) -> DataFrame:
    """``plan`` with ``cut``: documents of the partial epoch with a key up to it are taken."""
    a, b, c = LEVELS
    keyed = (thin.join(plan, "__mix_leaf")
             .withColumn("key", _key(F.col("whole") + 1, F.col("__mix_id"), F.col("__mix_digest"), seed))
             .withColumn("bucket", F.substring("key", 1, digits)))
    sums = keyed.groupBy("__mix_leaf", "part", "bucket").agg(F.sum("__mix_tokens").alias("t"))
    upto = Window.partitionBy("__mix_leaf").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = (sums.withColumn("before", F.sum("t").over(upto) - F.col("t"))
            .where("before <= part and before + t > part").select("__mix_leaf", "bucket", "before"))
    inside = Window.partitionBy("__mix_leaf").orderBy("key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    last = (keyed.select("__mix_leaf", "bucket", "key", "part", "__mix_tokens").join(edge, ["__mix_leaf", "bucket"])
            .withColumn("run", F.sum("__mix_tokens").over(inside) + F.col("before"))
            .groupBy("__mix_leaf").agg(F.max(F.when(F.col("run") <= F.col("part"), F.col("key"))).alias("key"),
                                       F.first("bucket").alias("bucket")))
    # without an edge the whole epoch fits; without a document inside the edge the bucket's start cuts
    return (plan.join(last, "__mix_leaf", "left")
            .select("__mix_leaf", "whole", F.coalesce("key", "bucket", F.lit("~")).alias("cut")))


def mix(docs: DataFrame, domain: Column | None = None, lang_col: str = "lang", source_col: str = "source",
        id_col: str = "doc_id", text_col: str = "text", domain_weights: dict | None = None,
        lang_weights: dict | None = None, source_weights: dict | None = None,
        budget_percent: int = BUDGET_PERCENT, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
        digits: int = DIGITS) -> DataFrame:
    """Rows of ``docs`` once per epoch in which they are taken, with ``__mix_domain``, ``__mix_epoch``
    (from 1) and ``__mix_tokens`` beside their own columns."""
    a, b, c = LEVELS
    source, text = docs[source_col].cast("string"), docs[text_col].cast("string")
    base = (docs.withColumn(a, domain_of(source) if domain is None else domain)
            .withColumn(b, docs[lang_col].cast("string")).withColumn(c, source)
            .withColumn("__mix_tokens", F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("long"))
            .withColumn("__mix_id", F.coalesce(docs[id_col].cast("string"), F.lit("")))
            .withColumn("__mix_digest", F.md5(F.coalesce(text, F.lit(""))))
            .withColumn("__mix_leaf", F.concat_ws("/", *[F.coalesce(x, F.lit("\x00")) for x in LEVELS])))
    thin = staged(base.select(a, b, c, "__mix_leaf", "__mix_tokens", "__mix_id", "__mix_digest"), "mix-docs")
    leaves = (thin.groupBy(a, b, c, "__mix_leaf").agg(F.sum("__mix_tokens").alias("tokens"))
              .withColumn("w0", weight_of(F.col(a), DOMAIN_WEIGHTS if domain_weights is None else domain_weights))
              .withColumn("w1", weight_of(F.col(b), LANG_WEIGHTS if lang_weights is None else lang_weights))
              .withColumn("w2", weight_of(F.col(c), source_weights or {})))
    plan = staged(budgets(leaves, budget_percent, max_epochs)
                  .withColumn("whole", F.when(F.col("tokens") > 0, F.expr("given div tokens")).otherwise(F.lit(0).cast("long")))
                  .withColumn("part", F.col("given") - F.col("whole") * F.col("tokens"))
                  .select("__mix_leaf", "whole", "part"), "mix-plan")
    cut = staged(cuts(thin, plan, seed, digits), "mix-cuts")
    discard(thin)
    taken = base.join(cut.toDF("__mix_leaf", "__mix_whole", "__mix_cut"), "__mix_leaf")
    key = _key(F.col("__mix_whole") + 1, F.col("__mix_id"), F.col("__mix_digest"), seed)
    last = F.col("__mix_whole") + F.when(key <= F.col("__mix_cut"), 1).otherwise(0)
    return (taken.withColumn("__mix_last", last).where("__mix_last > 0")
            .withColumn("__mix_epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__mix_last"))))
            .select(*[docs[x] for x in docs.columns], a, "__mix_epoch", "__mix_tokens"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs).select("doc_id", F.col("__mix_domain").alias("domain"), "lang", "source",
                            F.col("__mix_epoch").alias("epoch"), F.col("__mix_tokens").alias("n_tokens"))


def sql(domain_weights: dict = DOMAIN_WEIGHTS, lang_weights: dict = LANG_WEIGHTS) -> str:
    """The query in DuckDB SQL."""
    def weight(col, weights):
        return f"CASE {' '.join(f"WHEN {col} = '{k}' THEN {v}" for k, v in weights.items())} ELSE 1 END"

    def divided(src, parent, child):
        full = "(cap * wr <= (given - cb) * weight AND weight > 0)"
        return f"""
  SELECT *, CASE WHEN is_full THEN cap WHEN weight > 0 AND fw > 0 THEN ((given - fc)::HUGEINT * weight) // fw ELSE 0 END AS share
  FROM (SELECT *, sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER (PARTITION BY {parent}) AS fc,
               sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER (PARTITION BY {parent}) AS fw
        FROM (SELECT *, {full} AS is_full
              FROM (SELECT *, coalesce(sum(cap) OVER (PARTITION BY {parent} ORDER BY cap::DOUBLE / weight, {child}
                                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cb,
                           sum(weight) OVER (PARTITION BY {parent} ORDER BY cap::DOUBLE / weight, {child}
                                             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wr
                    FROM {src})))"""

    return f"""
WITH d AS (
  SELECT doc_id, lang, source, coalesce(len(regexp_extract_all(text, '{TOKEN}')), 0) AS n_tokens,
         md5(coalesce(text, '')) AS digest,
         'd' || CASE WHEN regexp_extract(source, '[0-9]{{1,9}}$') = '' THEN '-'
                     ELSE (regexp_extract(source, '[0-9]{{1,9}}$')::INT % 4)::VARCHAR END AS domain
  FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens) AS tokens, sum(n_tokens) * {MAX_EPOCHS} AS cap,
                  {weight('domain', domain_weights)} AS w0, {weight('lang', lang_weights)} AS w1, 1 AS weight
           FROM d GROUP BY ALL),
root AS (SELECT sum(tokens) * {BUDGET_PERCENT} // 100 AS given FROM leaves),
d1 AS ({divided("(SELECT domain, w0 AS weight, sum(cap) AS cap, (SELECT given FROM root) AS given, 0 AS root FROM leaves GROUP BY domain, w0)", "root", "domain")}),
l1 AS ({divided("(SELECT l.domain, l.lang, l.w1 AS weight, sum(l.cap) AS cap, any_value(d1.share) AS given FROM leaves l JOIN d1 USING (domain) GROUP BY l.domain, l.lang, l.w1)", "domain", "lang")}),
s1 AS ({divided("(SELECT l.domain, l.lang, l.source, l.tokens, l.cap, l.weight, l1.share AS given FROM leaves l JOIN l1 USING (domain, lang))", "domain, lang", "source")}),
plan AS (SELECT domain, lang, source, CASE WHEN tokens > 0 THEN share // tokens ELSE 0 END AS whole,
                CASE WHEN tokens > 0 THEN share % tokens ELSE share END AS part FROM s1),
keyed AS (SELECT d.*, whole, part,
                 md5('{SEED}:' || (whole + 1)::BIGINT::VARCHAR || ':' || doc_id) || '|' || doc_id || '|' || digest AS k
          FROM d JOIN plan USING (domain, lang, source)),
marked AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY k RANGE UNBOUNDED PRECEDING) <= part AS taken FROM keyed)
SELECT doc_id, domain, lang, source, unnest(generate_series(1, (whole + taken::INT)::BIGINT)) AS epoch, n_tokens
FROM marked WHERE whole + taken::INT > 0"""
