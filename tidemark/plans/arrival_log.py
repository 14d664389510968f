"""Merge on read: last-wins tables whose batches are appended to a log and merged when the table is read.

`LogStore` is a `TableStore` whose ``upsert`` writes the batch beside the table and rewrites no stored
partition, so a write costs what the batch costs, however large the table is. ``read`` and
``read_window`` take, per key, the row of the latest arrival over table and log (`max_by`, combined
before the shuffle); the partition column is part of the grouping, so filters on asset, time and
partition reach both scans. ``fold`` merges the log into the table by the ordinary upsert.

A batch is visible by a marker file, renamed into place after its rows are written and counted; a run lost
before that leaves nothing that is read. A batch that is folded or appended twice changes nothing, because
rows carry their arrival. Files of a folded batch stay until the next fold, for readers that
began before it. First-wins tables (news) keep the ordinary insert.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators.merge import latest_per_key, null_violation
from tidemark.plans.store import ARRIVAL, ARRIVAL_COLUMNS, LANDED_ORDER, ORDER, TableStore, WriteStats


class LogStore(TableStore):
    """``fold_after``: an upsert that leaves this many batches in the log folds them."""

    def __init__(self, *args, fold_after: int = 64, **kw):
        super().__init__(*args, **kw)
        self.fold_after = fold_after

    # -- log --------------------------------------------------------------------------
    def _log(self, spec: S.TableSpec) -> str:
        return f"{self.root}/_log/{spec.name}"

    def _marked(self, spec: S.TableSpec, state: str) -> list[str]:
        """Names of the batches in ``state`` ("live" or "folded")."""
        fs, p = self._fs(self._log(spec))
        names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(n[len(state) + 1:] for n in names if n.startswith(state + "-"))

    def _mark(self, spec: S.TableSpec, name: str, state: str, before: str = "tmp") -> None:
        fs, old = self._fs(f"{self._log(spec)}/{before}-{name}")
        if before == "tmp":
            self._write_bytes(fs, old, "")
        _, new = self._fs(f"{self._log(spec)}/{state}-{name}")
        if not fs.rename(old, new) and not fs.exists(new):
            raise RuntimeError(f"{spec.name}: batch {name} of the log could not be marked {state}")

    def logged(self, spec: S.TableSpec, names: list[str] | None = None) -> DataFrame:
        """Rows of the log's live batches (or of those named), with arrival and partition columns."""
        spec = self.spec(spec)
        schema = self.storage_schema(spec)
        names = self._marked(spec, "live") if names is None else names
        if not names:
            return self.spark.createDataFrame([], schema)
        # each batch folder has partition folders of its own
        parts = [self.spark.read.schema(schema).parquet(f"{self._log(spec)}/{n}") for n in names]
        out = parts[0]
        for more in parts[1:]:
            out = out.unionByName(more)
        return out.select(*schema.fieldNames())

    # -- writes -----------------------------------------------------------------------
    def upsert(self, spec: S.TableSpec, incoming: DataFrame, order=ORDER) -> WriteStats:
        """Append a batch to the log; the stored table is not read. A NULL in a NOT NULL column fails the
        batch, an empty batch is a no-op. ``rows_written`` counts the appended rows."""
        spec = self.spec(spec)
        self._pointer(spec)  # a missing table raises
        name = uuid.uuid4().hex[:12]
        path = f"{self._log(spec)}/{name}"
        obs = Observation(f"{spec.name}-log-{name}")
        rows = self._prepare(spec, incoming, order).withColumn(spec.partition_col, F.expr(spec.partition_expr))
        rows = rows.hint("rebalance", spec.partition_col).sortWithinPartitions(spec.partition_col, *spec.sort_cols)
        rows.observe(obs, F.count(F.lit(1)).alias("n"), F.count_if(null_violation(spec.not_null)).alias("bad")) \
            .write.mode("errorifexists").option("compression", "zstd").partitionBy(spec.partition_col).parquet(path)
        got, stats = dict(obs.get), WriteStats(spec.name)
        stats.rows_in = got["n"]
        fs, p = self._fs(path)
        if got["bad"] or not got["n"]:
            fs.delete(p, True)  # of this run alone
            if got["bad"]:
                raise ValueError(f"NOT NULL constraint failed: {got['bad']} row(s) with NULL in one of "
                                 f"{spec.not_null}; batch not written")
            return stats
        written = self.logged(spec, [name]).count()
        if written != got["n"]:
            raise RuntimeError(f"{spec.name}: {got['n']} rows to append, {written} found; not published")
        self._mark(spec, name, "live")
        stats.rows_written = got["n"]
        if len(self._marked(spec, "live")) >= self.fold_after:
            self.fold(spec)
        return stats

    def fold(self, spec: S.TableSpec) -> WriteStats:
        """Merge the log's live batches into the table and take them out of the log. Lost at any point, it can be
        run again: until a batch is taken out its rows are in both places, with one arrival."""
        spec = self.spec(spec)
        names = self._marked(spec, "live")
        for old in self._marked(spec, "folded"):
            for gone in (old, f"folded-{old}"):
                fs, p = self._fs(f"{self._log(spec)}/{gone}")
                fs.delete(p, True)
        if not names:
            return WriteStats(spec.name)
        rows = self.logged(spec, names)
        for c in ARRIVAL:
            rows = rows.withColumnRenamed(f"_{c}", c)
        stats = super().upsert(spec, rows, LANDED_ORDER)
        for name in names:
            self._mark(spec, name, "folded", before="live")
        return stats

    # -- reads ------------------------------------------------------------------------
    def read(self, spec: S.TableSpec) -> DataFrame:
        """Full table incl. the partition column: per key the latest arrival over table and log."""
        spec = self.spec(spec)
        # the log's names before the pointer: a batch folded in between is read from the table
        logged = self.logged(spec) if spec.conflict == "replace" and self._marked(spec, "live") else None
        if logged is None:
            return super().read(spec)
        rows = self._stored(spec).unionByName(logged)
        return latest_per_key(rows, [*spec.key, spec.partition_col], ARRIVAL_COLUMNS).select(*spec.columns, spec.partition_col)
