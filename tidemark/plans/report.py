"""Run-report predicates as DataFrame aggregates (the report itself is a tiny frame)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S


def critical_gate_frame(status: DataFrame, critical: Sequence[str], source_col: str = "source",
                        ok_col: str = "ok") -> DataFrame:
    """One row ``ok``: every critical source is present in ``status`` and ok.

    A critical source that has no status row at all counts as failed.
    """
    crit = list(dict.fromkeys(critical))
    passed = F.count_distinct(F.when(F.col(source_col).isin(crit) & F.col(ok_col), F.col(source_col)))
    return status.agg((passed == F.lit(len(crit))).alias("ok"))


def store_audit(store, specs=None) -> DataFrame:
    """Integrity of stored tables: one row per (table, check) with its violation count.

    Checks: ``duplicate_key`` (keys stored more than once) and ``null_<column>`` for every
    NOT NULL column. One scan and one shuffle (by key, partially aggregated) per table.
    """
    specs = specs or (S.PRICE, S.MARKET, S.NEWS)
    out = None
    for spec in specs:
        spec = store.spec(spec)
        per_key = store.read(spec).groupBy(*spec.key).agg(
            F.count(F.lit(1)).alias("__n"),
            *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in spec.not_null if c not in spec.key])
        checks = [F.count_if(F.col("__n") > 1).alias("duplicate_key")]
        checks += [F.coalesce(F.sum(f"null_{c}"), F.lit(0)).cast("long").alias(f"null_{c}")
                   for c in spec.not_null if c not in spec.key]
        checks += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in spec.key]
        wide = per_key.agg(*checks)
        names = [c for c in wide.columns]
        stacked = wide.select(F.explode(F.array(*[
            F.struct(F.lit(n).alias("check"), F.col(n).cast("long").alias("violations")) for n in names
        ])).alias("c")).select(F.lit(spec.name).alias("table"), "c.check", "c.violations")
        out = stacked if out is None else out.unionByName(stacked)
    return out
