"""Merge on read, statistics from footers, the interleaved layout, stages in dependency order."""

import datetime as dt
import threading
import urllib.parse

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.plans.arrival_log import LogStore
from tidemark.plans.ingest import STAGE_REQUIRES, run_stages, stage_levels
from tidemark.plans.store import TableStore
from tests.test_store import PRICE_IN, news, price

T0 = dt.datetime(2024, 1, 31, 20)


def hours(n, start=T0):
    return [start + dt.timedelta(hours=k) for k in range(n)]


def content(store, spec=S.PRICE):
    return sorted(tuple(r) for r in store.read(spec).select(*spec.columns).collect())


# --- merge on read --------------------------------------------------------------------------

def batches(spark):
    """Overlapping keys over a month's end, a null over a value, an older batch handled last, a replay."""
    t = hours(8)
    two = price(spark, [(a, h, 2.0, None) for a in ("BTC", "ETH") for h in t[2:]], batch=2)
    one = price(spark, [("BTC", h, 1.0, 1.0) for h in t], batch=1)
    three = price(spark, [("ETH", t[0], 3.0, 3.0), ("ETH", t[0], 3.5, 3.0), ("ETH", t[4], 3.0, 3.0)], batch=3)
    return [two, one, three, two]


@pytest.mark.parametrize("fold_at", [(), (1,), (0, 2), (0, 1, 2, 3)])
def test_log_and_table_give_what_upserts_give(spark, tmp_path, fold_at):
    plain, log = TableStore(spark, str(tmp_path / "plain")), LogStore(spark, str(tmp_path / "log"))
    for s in (plain, log):
        s.create_tables([S.PRICE])
    for k, b in enumerate(batches(spark)):
        plain.upsert(S.PRICE, b)
        log.upsert(S.PRICE, b)
        if k in fold_at:
            log.fold(S.PRICE)
        assert content(log) == content(plain)
    window = (dt.datetime(2024, 1, 31, 22), dt.datetime(2024, 2, 1, 1), "ETH")
    assert sorted(map(tuple, log.read_window(S.PRICE, *window).collect())) == sorted(map(tuple, plain.read_window(S.PRICE, *window).collect()))
    log.fold(S.PRICE)
    log.fold(S.PRICE)
    assert content(log) == content(plain) and log.logged(S.PRICE).count() == 0
    assert log._marked(S.PRICE, "folded") == []                      # files of folded batches go with the next fold


def test_append_reads_and_rewrites_no_stored_partition(spark, tmp_path, monkeypatch):
    log = LogStore(spark, str(tmp_path / "log"))
    log.create_tables([S.PRICE])
    log.upsert(S.PRICE, price(spark, [("BTC", h, 1.0, 1.0) for h in hours(20)]))
    log.fold(S.PRICE)
    before = log._pointer(S.PRICE)
    monkeypatch.setattr(log, "_stored", lambda *a: pytest.fail("the stored table was read"))
    assert log.upsert(S.PRICE, price(spark, [("BTC", T0, 5.0, 1.0)], batch=2)).rows_written == 1
    monkeypatch.undo()
    assert log._pointer(S.PRICE) == before
    assert [r.close for r in log.read_window(S.PRICE, T0, T0, "BTC").collect()] == [5.0]


def test_log_window_filters_reach_both_scans(spark, tmp_path):
    log = LogStore(spark, str(tmp_path / "log"))
    log.create_tables([S.PRICE])
    log.upsert(S.PRICE, price(spark, [("BTC", h, 1.0, 1.0) for h in hours(20)]))
    log.fold(S.PRICE)
    log.upsert(S.PRICE, price(spark, [("BTC", T0, 5.0, 1.0)], batch=2))
    plan = log.read_window(S.PRICE, T0, T0, "BTC")._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter " in line]
    assert len(filters) == 2 and all("= BTC" in f and "month#" in f and "timestamp#" in f for f in filters), plan
    assert plan.index("Aggregate") < plan.index("Filter ")


def test_log_guards_and_automatic_fold(spark, tmp_path):
    log = LogStore(spark, str(tmp_path / "log"), fold_after=2)
    with pytest.raises(FileNotFoundError):
        log.upsert(S.PRICE, price(spark, [("BTC", T0, 1.0, 1.0)]))
    log.create_tables()
    with pytest.raises(ValueError, match="NOT NULL"):
        log.upsert(S.PRICE, price(spark, [("BTC", T0, 1.0, 1.0), (None, T0, 1.0, 1.0)]))
    assert log.upsert(S.PRICE, spark.createDataFrame([], PRICE_IN)).rows_in == 0
    assert log._marked(S.PRICE, "live") == [] and log.read(S.PRICE).count() == 0
    log.upsert(S.PRICE, price(spark, [("BTC", T0, 1.0, 1.0)]))
    assert log._stored(S.PRICE).count() == 0 and log.read(S.PRICE).count() == 1
    log.upsert(S.PRICE, price(spark, [("BTC", T0, 2.0, 1.0)], batch=2))
    assert log._marked(S.PRICE, "live") == [] and log._stored(S.PRICE).count() == 1
    log.insert_ignore(S.NEWS, news(spark, [("BTC", "h", "u", T0)]))
    assert log.read(S.NEWS).count() == 1                             # first-wins tables as before


def test_a_fold_lost_after_the_merge_is_done_again(spark, tmp_path, monkeypatch):
    log = LogStore(spark, str(tmp_path / "log"))
    log.create_tables([S.PRICE])
    for b in (1, 2):
        log.upsert(S.PRICE, price(spark, [("BTC", h, float(b), 1.0) for h in hours(5)], batch=b))
    monkeypatch.setattr(log, "_mark", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        log.fold(S.PRICE)
    monkeypatch.undo()
    want = [2.0] * 5
    assert [r[2] for r in content(log)] == want and len(log._marked(S.PRICE, "live")) == 2
    log.fold(S.PRICE)
    assert [r[2] for r in content(log)] == want and log.logged(S.PRICE).count() == 0


# --- statistics from footers ----------------------------------------------------------------

def test_footer_stats_read_no_rows(spark, tmp_path):
    s = TableStore(spark, str(tmp_path / "s"))
    s.create_tables([S.PRICE])
    assert s.footer_stats(S.PRICE).count() == 0
    s.upsert(S.PRICE, price(spark, [("BTC", h, float(k), None if k % 3 else 1.0) for k, h in enumerate(hours(10))]))
    s.upsert(S.PRICE, price(spark, [("ETH", T0, 99.0, None)], batch=2))
    plan = s._footer_frame(S.PRICE)._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [" in plan and "PushedAggregation: []" not in plan and "PushedGroupBy: [v, month]" in plan
    got = {r["month"]: r.asDict() for r in s.footer_stats(S.PRICE).collect()}
    want = {r["month"]: r.asDict() for r in s.read(S.PRICE).groupBy("month").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("market_cap").isNull()).alias("null_market_cap"),
        F.count_if(F.col("volume").isNull()).alias("null_volume"), F.min("close").alias("min_close"), F.max("close").alias("max_close")).collect()}
    assert set(got) == {"2024-01", "2024-02"}
    for month, row in want.items():
        assert {k: got[month][k] for k in row} == row


def test_footer_stats_leave_the_session_alone(spark, tmp_path):
    s = TableStore(spark, str(tmp_path / "s"))
    s.create_tables([S.NEWS])
    names = ("spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown")
    before = [spark.conf.get(n) for n in names]
    s.insert_ignore(S.NEWS, news(spark, [("BTC", "h", "u", T0), ("BTC", "g", "v", T0)]))
    assert [(r.asset_part, r.n, r.null_headline) for r in s.footer_stats(S.NEWS).collect()] == [("BTC", 2, 0)]
    assert [spark.conf.get(n) for n in names] == before


# --- interleaved layout ---------------------------------------------------------------------

def opened(store, spec, asset=None, at=None):
    """Row groups whose footer statistics allow ``asset`` and ``at``, and all row groups."""
    hit = total = 0
    for f in store.read(spec).inputFiles():
        meta = pq.ParquetFile(urllib.parse.unquote(f.removeprefix("file://"))).metadata
        names = [meta.schema.column(k).name for k in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            total += 1
            ok = True
            for name, value in (("asset", asset), ("timestamp", at)):
                if value is not None:
                    st = meta.row_group(g).column(names.index(name)).statistics
                    assert st is not None and st.has_min_max
                    ok &= st.min <= value <= st.max
            hit += ok
    return hit, total


def test_interleaved_compaction_skips_on_either_column(spark, tmp_path):
    spark_rows = [(f"A{a:02d}", h, float(a), 1.0) for a in range(16) for h in hours(256, dt.datetime(2024, 1, 1))]
    s = TableStore(spark, str(tmp_path / "s"))
    s.create_tables([S.PRICE])
    s.upsert(S.PRICE, price(spark, spark_rows))
    before = content(s)
    at = dt.datetime(2024, 1, 5, 7, tzinfo=dt.timezone.utc)
    s.compact(S.PRICE, files=16)
    by_asset = opened(s, S.PRICE, asset="A05"), opened(s, S.PRICE, at=at)
    s.compact(S.PRICE, files=16, interleave=True)
    assert content(s) == before
    both = opened(s, S.PRICE, asset="A05"), opened(s, S.PRICE, at=at)
    assert by_asset[1][0] >= 14                                      # an hour is in every file of the order by asset
    assert max(both[0][0], both[1][0]) <= 8 and both[0][1] >= 12     # interleaved: a part of the files for either
    assert opened(s, S.PRICE, asset="A05", at=at)[0] <= 3
    assert s.read_window(S.PRICE, at, at).count() == 16
    s.upsert(S.PRICE, price(spark, spark_rows[:1], batch=2))         # later writes go on as before
    assert content(s)[1:] == before[1:]


def test_interleaved_compaction_of_small_tables(spark, tmp_path):
    s = TableStore(spark, str(tmp_path / "s"))
    s.create_tables([S.PRICE, S.MARKET])
    assert s.compact(S.PRICE, interleave=True) == []
    s.upsert(S.PRICE, price(spark, [("BTC", T0, 1.0, None)]))        # one asset, one hour
    assert s.compact(S.PRICE, interleave=True) == ["2024-01"] and s.read(S.PRICE).count() == 1
    with pytest.raises(ValueError, match="asset"):
        s.compact(S.MARKET, interleave=True)


# --- dependency order -----------------------------------------------------------------------

def test_stage_levels_whatever_the_order_given():
    names = ["risk", "sentiment", "master_features", "regime", "market_features", "volatility", "price_features"]
    for order in (names, names[::-1], sorted(names)):
        assert stage_levels(order, STAGE_REQUIRES) == [
            ["market_features", "price_features", "volatility"], ["master_features", "regime"], ["risk", "sentiment"]]
    assert stage_levels([], STAGE_REQUIRES) == []
    assert stage_levels(["risk"], STAGE_REQUIRES) == [["risk"]]      # needs outside the run are no stages of it


def test_a_cycle_of_needs_is_named_and_nothing_runs():
    ran = []
    stages = {n: (lambda n=n: ran.append(n)) for n in "abcd"}
    with pytest.raises(ValueError, match="cycle") as e:
        run_stages(stages, requires={"a": ("c",), "b": ("a",), "c": ("b",)})
    assert all(n in str(e.value) for n in "abc") and ran == []


def test_shuffled_stages_run_after_their_needs():
    ran, lock = [], threading.Lock()

    def note(name, fail=False):
        def run():
            with lock:
                ran.append(name)
            if fail:
                raise RuntimeError(name)
        return run

    stages = {n: note(n) for n in ("risk", "sentiment", "regime", "volatility")}
    assert run_stages(stages) == dict.fromkeys(stages, True)
    assert ran.index("volatility") < ran.index("regime") < min(ran.index("risk"), ran.index("sentiment"))
    ran.clear()
    stages["regime"] = note("regime", fail=True)
    assert run_stages(stages) == {"volatility": True, "regime": False, "risk": False, "sentiment": False}
    assert sorted(ran) == ["regime", "volatility"]
    # a need met before the run counts, a missing one does not
    assert run_stages({"regime": note("x")}, {"volatility": True})["regime"] is True
    assert run_stages({"regime": note("x")})["regime"] is False


def test_independent_stages_run_together():
    gate = threading.Barrier(2, timeout=20)                          # passes only if both are running
    got = run_stages({"price_features": gate.wait, "market_features": gate.wait})
    assert got == {"price_features": True, "market_features": True}
