"""The ingest run: price, market and news, each isolated, then the gates.

Each source is one read of its landing directory -> classify/quarantine -> shred ->
harmonise -> keyed merge into its table. A failure in one source never stops the others;
the outcome of every source goes into a small run report.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from graphlib import CycleError, TopologicalSorter
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators.audit import top_n_per_group
from tidemark.operators.harmonise import harmonise_market, harmonise_news, harmonise_price, lookback
from tidemark.plans.staging import stage
from tidemark.plans.store import LANDED_ORDER, ORDER, TableStore
from tidemark.sources import shred
from tidemark.sources.landing import CORRUPT, landed_from_frame, quarantine_rows, read_landing

REPORT_SCHEMA = ("source string, ok boolean, payloads long, quarantined long, "
                 "payloads_unsupported long, rows_in long, "
                 "rows_written long, rows_ignored long, rows_null_dropped long, rows_deduped long, "
                 "rows_empty_url long, quarantined_rows long, error string, failure string")


@dataclass
class SourceResult:
    source: str
    ok: bool = False
    payloads: int = 0
    quarantined: int = 0
    payloads_unsupported: int = 0  # good payloads of assets outside the allow-list (rows dropped)
    rows_in: int = 0
    rows_written: int = 0
    rows_ignored: int = 0          # already stored (IGNORE) — attempted minus inserted
    rows_null_dropped: int = 0     # NULL in a NOT NULL column (IGNORE tables skip them)
    rows_deduped: int = 0          # later duplicates of a key within this batch
    rows_empty_url: int = 0        # articles without a URL ("" takes part in the key)
    quarantined_rows: int = 0      # lenient mode: rows whose event time did not parse
    error: str | None = None
    failure: str | None = None     # "data" (batch unusable) or "system" (retry the batch)

    # no columns of the run report
    cause = None                   # the exception behind ``error``
    nothing_usable = False         # every payload was judged and is in quarantine: no row to store


class SourceFailed(RuntimeError):
    """A batch of a source is not, or not wholly, in its table."""


def require_stored(res: SourceResult) -> SourceResult:
    """``res`` of a batch whose outcome is a result; raises if it failed, for then the table lacks rows of the
    batch. (A landing without a usable payload fails as a source, but has no rows that the table could lack.)"""
    if not (res.ok or res.nothing_usable):
        raise SourceFailed(f"{res.source} ({res.failure} failure): {res.error}") from res.cause
    return res


_CLASSIFY = {"price": shred.classify_chart, "market": shred.classify_global, "news": shred.classify_news}


def _landed(spark: SparkSession, landing) -> DataFrame:
    if isinstance(landing, DataFrame):
        return landed_from_frame(landing)
    return read_landing(spark, landing)


def harmonised_rows(kind: str, classified: DataFrame, assets=None, strict: bool = False,
                    lookback_days: int | None = None, max_articles: int | None = None) -> DataFrame:
    """Good payloads of ``kind`` -> harmonised rows (still carrying arrival order).

    ``lookback_days`` keeps price points no older than that many days before their payload's
    ingest time (the request's history bound); ``max_articles`` keeps the newest N articles of
    each news payload (the request's page size). In-batch news dedup on (asset, url) is done
    by the sink's first-arrival rule, which is the same ordering.
    """
    if kind == "price":
        rows = shred.shred_chart(classified)
        if lookback_days is not None:
            # the request's bound: points at or after (request time - days), on raw times
            rows = lookback(rows, "point_ts", F.col("ingest_ts"), lookback_days)
        return harmonise_price(rows, assets, strict)
    if kind == "market":
        return harmonise_market(shred.shred_global(classified), strict)
    if kind == "news":
        rows = shred.shred_news(classified)
        if max_articles is not None:
            # one group per delivered payload: copies of a payload must not use up each other's places
            rows = top_n_per_group(rows, "delivery", [F.col("published_at").desc(), F.col("seq").desc()], max_articles)
        rows = rows.drop("delivery")
        return harmonise_news(rows, assets, strict)
    raise ValueError(f"unknown source {kind!r}")


_SPECS = {"price": S.PRICE, "market": S.MARKET, "news": S.NEWS}


def _error_text(e: Exception) -> str:
    text = str(e)
    return f"{type(e).__name__}: {text.splitlines()[0][:500] if text else ''}"


def failure_kind(e: Exception) -> str:
    """``data``: the batch itself is unusable (column contract, NOT NULL, values that do not
    parse) — the reference loses such a batch too; ``system``: anything else (I/O, lost
    executors beyond retries, ...) — the batch must be retried, not skipped."""
    from pyspark.errors.exceptions import captured
    data_errors = (ValueError, captured.NumberFormatException, captured.DateTimeException,
                   captured.ArithmeticException)
    return "data" if isinstance(e, data_errors) else "system"


def _store_rows(store: TableStore, kind: str, rows: DataFrame, res: SourceResult) -> None:
    """Merge harmonised rows into the source's table and copy the write stats into ``res``."""
    spec = _SPECS[kind]
    order = LANDED_ORDER if "payload_hash" in rows.columns else ORDER
    stats = store.insert_ignore(spec, rows, order) if spec.conflict == "ignore" \
        else store.upsert(spec, rows, order)
    res.rows_in, res.rows_written = stats.rows_in, stats.rows_written
    res.rows_ignored, res.rows_null_dropped = stats.rows_ignored, stats.rows_null_dropped
    res.rows_deduped, res.rows_empty_url = stats.rows_deduped, stats.rows_empty_url


def ingest_source(spark: SparkSession, store: TableStore, kind: str, landing, assets=None,
                  strict: bool = False, **options) -> SourceResult:
    """One source, fully isolated: any error is recorded, never raised. Whoever reads the table next as a
    result passes the outcome through `require_stored`."""
    res = SourceResult(kind)
    staged = None
    try:
        classified = _CLASSIFY[kind](_landed(spark, landing))
        # raw text is only kept for rejected payloads (good ones carry their parsed form)
        bad = F.col("reason").isNotNull()
        classified = classified.withColumn("payload", F.when(bad, F.col("payload"))) \
            .withColumn(CORRUPT, F.when(bad, F.col(CORRUPT)))
        metrics = {"n": F.count(F.lit(1)), "bad": F.count_if(bad)}
        if kind != "market" and not isinstance(assets, DataFrame):
            # good payloads of unsupported assets: their rows are dropped by the allow-list (P3)
            allowed = list(S.VALID_ASSETS if assets is None else assets)
            metrics["unknown"] = F.count_if(~bad & ~F.coalesce(F.col("asset").isin(allowed), F.lit(False)))
        staged = stage(classified, f"classified-{kind}", metrics)
        classified = staged.df
        res.payloads, res.quarantined = staged.metrics["n"], staged.metrics["bad"]
        res.payloads_unsupported = staged.metrics.get("unknown", 0 if kind == "market" else None)
        if res.quarantined:
            store.write_quarantine(quarantine_rows(classified, kind))
        if res.payloads == res.quarantined:
            # payloads of unsupported assets are usable ones: their rows are dropped, the source is fine
            res.nothing_usable = True
            raise ValueError(f"no usable payload: {res.payloads} landed, {res.quarantined} quarantined")
        rows = harmonised_rows(kind, classified, assets, strict, **options)
        _store_or_quarantine(store, kind, rows, res, strict)
        res.ok = True
    except Exception as e:  # noqa: BLE001 - isolation is the point
        res.error, res.failure, res.cause = _error_text(e), failure_kind(e), e
    finally:
        if staged is not None:
            staged.drop()
    return res


def _store_or_quarantine(store: TableStore, kind: str, rows: DataFrame, res: SourceResult, strict: bool) -> None:
    """Store ``rows``. Lenient mode: rows whose event time is NULL (unparseable or missing) are counted
    while the others are stored, and then go to quarantine with their content as JSON."""
    if strict:
        _store_rows(store, kind, rows, res)
        return
    obs = Observation(f"times-{kind}-{uuid.uuid4().hex[:8]}")
    bad = F.col("timestamp").isNull()
    seen = rows.observe(obs, F.count_if(bad).alias("bad"))
    _store_rows(store, kind, seen.where(~bad), res)
    res.quarantined_rows = dict(obs.get)["bad"]
    if res.quarantined_rows:
        asset = F.col("asset") if "asset" in rows.columns else F.lit(None).cast("string")
        store.write_quarantine(rows.where(bad).select(
            F.lit(kind).alias("source"), asset.alias("asset"),
            F.col("batch_id").cast("long").alias("batch_id"), F.col("ingest_ts").cast("timestamp").alias("ingest_ts"),
            F.lit("bad_event_time").alias("reason"), F.to_json(F.struct(*rows.columns)).alias("raw")))


def ingest_frame(spark: SparkSession, store: TableStore, kind: str, df: DataFrame, assets=None,
                 strict: bool = False, batch_id: int = 0) -> SourceResult:
    """Harmonise and store an already-shredded frame in the stored layout (e.g. columns
    ``asset, timestamp, close, market_cap, volume, source`` for prices; news may use
    ``published_at``). Timestamps may be text (offsets honoured) or typed.

    Arrival order: the frame's ``batch_id``/``ingest_ts``/``seq`` columns when present;
    otherwise ``batch_id`` is the argument and ``seq`` the row position
    (``monotonically_increasing_id``: input order for order-preserving sources such as a file
    scan or a local list — give ``seq`` explicitly for frames that come out of a shuffle).
    """
    res = SourceResult(kind)
    try:
        if "batch_id" not in df.columns:
            df = df.withColumn("batch_id", F.lit(batch_id).cast("long"))
        if "ingest_ts" not in df.columns:
            df = df.withColumn("ingest_ts", F.lit(None).cast("timestamp"))
        if "seq" not in df.columns:
            df = df.withColumn("seq", F.monotonically_increasing_id())
        df = df.checkpoint(eager=True)            # fixes the row positions
        harmonise = {"price": lambda d: harmonise_price(d, assets, strict),
                     "market": lambda d: harmonise_market(d, strict),
                     "news": lambda d: harmonise_news(d, assets, strict)}[kind]
        _store_or_quarantine(store, kind, harmonise(df), res, strict)
        res.ok = True
    except Exception as e:  # noqa: BLE001 - isolation is the point
        res.error, res.failure, res.cause = _error_text(e), failure_kind(e), e
    return res


def run_ingest(spark: SparkSession, store: TableStore, price=None, market=None, news=None,
               assets=None, strict: bool = False, parallel: bool = True,
               lookback_days: int | None = None, max_articles: int | None = None) -> list[SourceResult]:
    """Price, market and news; a source with no landing input fails.

    The sources are independent (own landing input, own table), so by default they run as
    concurrent Spark jobs from a small thread pool; results come back in source order.
    ``assets`` is one allow-list for all sources or a dict ``{source: allow-list}``.
    """
    def allow(kind):
        return assets.get(kind) if isinstance(assets, dict) else assets

    def one(kind, landing):
        if landing is None:
            return SourceResult(kind, error="no landing input")
        opts = {"lookback_days": lookback_days} if kind == "price" else \
            {"max_articles": max_articles} if kind == "news" else {}
        return ingest_source(spark, store, kind, landing, allow(kind), strict, **opts)

    work = [("price", price), ("market", market), ("news", news)]
    if not parallel:
        return [one(k, land) for k, land in work]
    with ThreadPoolExecutor(max_workers=len(work), thread_name_prefix="ingest") as pool:
        futures = [pool.submit(one, k, land) for k, land in work]
        return [f.result() for f in futures]


def report_frame(spark: SparkSession, results: list[SourceResult]) -> DataFrame:
    """The run report as a DataFrame (three rows)."""
    rows = [tuple(asdict(r).values()) for r in results]
    return spark.createDataFrame(rows, REPORT_SCHEMA)


# --- gates -------------------------------------------------------------------------------

CRITICAL_SOURCES = ("price", "market")

# Dependencies between later stages: stage -> sources/stages it needs. A stage whose needs
# are not all met is not run; stages not listed as a need (e.g. news, sentiment features)
# may fail without stopping others.
STAGE_REQUIRES = {
    "price_features": (),
    "market_features": (),
    "sentiment_features": (),
    "master_features": ("price_features", "market_features"),
    "volatility": (),
    "regime": ("volatility",),
    "sentiment": ("regime",),
    "risk": ("volatility", "regime"),
}


def critical_gate(status: dict[str, bool], critical=CRITICAL_SOURCES) -> bool:
    return all(status.get(s, False) for s in critical)


def stage_levels(names, requires=None) -> list[list[str]]:
    """The stages in levels: each needs only stages of levels before its own (needs that are no stages of this run
    count by their status alone). Needs in a cycle raise ValueError."""
    requires, names = STAGE_REQUIRES if requires is None else requires, set(names)
    order = TopologicalSorter({n: [r for r in requires.get(n, ()) if r in names] for n in names})
    try:
        order.prepare()
    except CycleError as e:
        raise ValueError(f"stages need each other in a cycle: {' -> '.join(e.args[1])}") from e
    levels = []
    while order.is_active():
        levels.append(sorted(order.get_ready()))
        order.done(*levels[-1])
    return levels


def run_stages(stages: dict, status: dict[str, bool] | None = None, requires=None) -> dict[str, bool]:
    """Run ``stages`` (name -> callable) after what they need, in whatever order they are given; the stages of
    one level run together. A stage whose needs are not all met is not run; failures are isolated."""
    requires = STAGE_REQUIRES if requires is None else requires
    status = dict(status or {})

    def run(name: str) -> bool:
        if not all(status.get(n, False) for n in requires.get(name, ())):
            return False
        try:
            stages[name]()
            return True
        except Exception:  # noqa: BLE001
            return False

    for level in stage_levels(stages, requires):
        with ThreadPoolExecutor(max_workers=len(level), thread_name_prefix="stage") as pool:
            done = list(pool.map(run, level))
        status.update(zip(level, done))
    return status


def run_all(spark: SparkSession, store: TableStore, price=None, market=None, news=None,
            features=None, models=None, assets=None) -> dict[str, bool]:
    """Ingest -> critical gate -> features -> empty-output gate -> models.

    ``features`` returns a DataFrame (feature stages have no defined content yet: the default
    yields an empty frame, so the run stops at the second gate); ``models`` maps model stage
    names to callables.
    """
    ingest = {r.source: r.ok for r in run_ingest(spark, store, price, market, news, assets)}
    if not critical_gate(ingest):
        return ingest
    feats = features() if features is not None else spark.createDataFrame([], "asset string")
    has_rows = not feats.isEmpty()
    feature_flags = {k: has_rows for k in ("price_features", "market_features",
                                           "sentiment_features", "master_features")}
    if not has_rows:
        return {**ingest, **feature_flags}
    default_models = {k: (lambda: None) for k in ("volatility", "regime", "sentiment", "risk")}
    model_flags = run_stages(models or default_models)
    return {**ingest, **feature_flags, **{k: model_flags[k] for k in (models or default_models)}}
