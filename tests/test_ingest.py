import datetime as dt

import pytest

from tests.conftest import CHART, GLOBAL, NEWS, env_line, write_lines
from tidemark import schemas as S
from tidemark.plans.ingest import (
    STAGE_REQUIRES, critical_gate, report_frame, run_all, run_ingest, run_stages,
)
from tidemark.plans.store import TableStore
from tidemark.streaming.stream import run_stream_to_completion

T0 = "2024-04-21T00:10:00Z"


def chart(points):
    return {"prices": [[t, v] for t, v in points], "market_caps": [[t, v * 10] for t, v in points],
            "total_volumes": [[t, v * 100] for t, v in points]}


@pytest.fixture
def store(spark, tmp_path):
    s = TableStore(spark, str(tmp_path / "store"))
    s.create_tables()
    return s


def landing(tmp_path, name, lines):
    return write_lines(str(tmp_path / name), lines)


def test_full_run_all_sources(spark, store, tmp_path):
    p = landing(tmp_path, "price", [env_line("BTC", T0, 1, CHART), env_line("LUNA", T0, 1, CHART)])
    m = landing(tmp_path, "market", [env_line(None, T0, 1, GLOBAL)])
    n = landing(tmp_path, "news", [env_line("BTC", T0, 1, NEWS), env_line("ETH", T0, 1, NEWS)])
    res = {r.source: r for r in run_ingest(spark, store, p, m, n)}
    assert all(r.ok for r in res.values()), res
    assert store.read(S.PRICE).count() == 1
    assert store.read(S.MARKET).first().timestamp == dt.datetime(2024, 4, 21, 0, 0)
    assert store.read(S.NEWS).count() == 2
    rep = report_frame(spark, list(res.values()))
    assert rep.count() == 3 and set(rep.columns) >= {"source", "ok", "error"}


def test_one_failed_source_does_not_stop_others(spark, store, tmp_path):
    p = landing(tmp_path, "price", ["{broken"])                    # no usable payload
    m = landing(tmp_path, "market", [env_line(None, T0, 1, GLOBAL)])
    n = landing(tmp_path, "news", [env_line("BTC", T0, 1, NEWS)])
    res = {r.source: r for r in run_ingest(spark, store, p, m, n)}
    assert not res["price"].ok and "no usable payload" in res["price"].error
    assert res["price"].quarantined == 1
    assert res["market"].ok and res["news"].ok


def test_bad_asset_payload_isolated(spark, store, tmp_path):
    bad = {"prices": [[1713654000000, None]]}
    p = landing(tmp_path, "price", [env_line("BTC", T0, 1, bad), env_line("ETH", T0, 1, CHART)])
    r = run_ingest(spark, store, price=p)[0]
    assert r.ok and r.quarantined == 1
    assert [x.asset for x in store.read(S.PRICE).collect()] == ["ETH"]


def test_in_batch_news_dedup_keep_first(spark, store, tmp_path):
    arts = {"Data": [{"TITLE": "first", "URL": "u", "PUBLISHED_ON": 1713654000},
                     {"TITLE": "second", "URL": "u", "PUBLISHED_ON": 1713657600}]}
    n = landing(tmp_path, "news", [env_line("BTC", T0, 1, arts)])
    run_ingest(spark, store, news=n)
    assert [r.headline for r in store.read(S.NEWS).collect()] == ["first"]


def test_later_batch_wins_for_prices(spark, store, tmp_path):
    p = landing(tmp_path, "price", [env_line("BTC", "2024-04-21T01:00:00Z", 2, chart([(1713654000000, 2.0)])),
                                    env_line("BTC", T0, 1, chart([(1713654000000, 1.0)]))])
    run_ingest(spark, store, price=p)
    assert [r.close for r in store.read(S.PRICE).collect()] == [2.0]


def test_gates():
    assert critical_gate({"price": True, "market": True, "news": False})
    assert not critical_gate({"price": True, "market": False, "news": True})
    assert not critical_gate({"price": False, "market": True, "news": True})


def test_stage_dependencies():
    def boom():
        raise RuntimeError("x")
    ok = lambda: None
    st = run_stages({"volatility": boom, "regime": ok, "sentiment": ok, "risk": ok})
    assert st == {"volatility": False, "regime": False, "sentiment": False, "risk": False}
    st = run_stages({"volatility": ok, "regime": ok, "sentiment": boom, "risk": ok})
    assert st == {"volatility": True, "regime": True, "sentiment": False, "risk": True}
    st = run_stages({"price_features": ok, "market_features": boom, "sentiment_features": ok,
                     "master_features": ok})
    assert st["master_features"] is False and st["sentiment_features"] is True
    assert STAGE_REQUIRES["risk"] == ("volatility", "regime")


def test_run_all_stops_at_gates(spark, store, tmp_path):
    p = landing(tmp_path, "price", [env_line("BTC", T0, 1, CHART)])
    m = landing(tmp_path, "market", [env_line(None, T0, 1, GLOBAL)])
    out = run_all(spark, store, price=p, market=None, news=None)
    assert set(out) == {"price", "market", "news"} and out["price"] and not out["market"]
    out = run_all(spark, store, price=p, market=m, news=None)
    assert len(out) == 7 and not out["master_features"]          # empty features stop the run
    feats = lambda: spark.createDataFrame([("BTC",)], "asset string")
    out = run_all(spark, store, price=p, market=m, news=None, features=feats)
    assert len(out) == 11 and out["risk"]


def test_stream_equals_batch(spark, tmp_path):
    lines = [env_line("BTC", T0, 1, chart([(1713654000000, 1.0), (1713655000000, 2.0)])),
             env_line("ETH", T0, 1, chart([(1713654000000, 5.0)]))]
    later = [env_line("BTC", "2024-04-21T02:00:00Z", 2, chart([(1713654000000, 3.0), (1713661200000, 4.0)]))]
    batch_store = TableStore(spark, str(tmp_path / "b"))
    batch_store.create_tables()
    src = landing(tmp_path, "land_all", lines + later)
    run_ingest(spark, batch_store, price=src)

    stream_store = TableStore(spark, str(tmp_path / "s"))
    stream_store.create_tables()
    land = str(tmp_path / "land_stream")
    write_lines(land, lines)
    ck = str(tmp_path / "ck")
    run_stream_to_completion(spark, stream_store, "price", land, ck, report_path=str(tmp_path / "rep"))
    write_lines(land, later)
    run_stream_to_completion(spark, stream_store, "price", land, ck, report_path=str(tmp_path / "rep"))
    run_stream_to_completion(spark, stream_store, "price", land, ck)        # nothing new: no change
    a = sorted(tuple(r) for r in batch_store.read(S.PRICE).collect())
    b = sorted(tuple(r) for r in stream_store.read(S.PRICE).collect())
    assert a == b and len(a) == 3
    assert spark.read.parquet(str(tmp_path / "rep")).where("ok").count() == 2


def test_lookback_days_bounds_history(spark, store, tmp_path):
    day = 86_400_000
    ingest = 1713657600000                                     # 2024-04-21 00:00Z
    ten = 600_000
    # request at 00:10: the bound is 00:10 the day before, on raw (unfloored) point times
    pts = [(ingest - 3 * day, 1.0), (ingest - day + ten - 60_000, 2.0), (ingest - day + ten, 3.0),
           (ingest + 60_000, 4.0)]
    p = landing(tmp_path, "price", [env_line("BTC", "2024-04-21T00:10:00Z", 1, chart(pts))])
    run_ingest(spark, store, price=p, lookback_days=1)
    assert sorted(r.close for r in store.read(S.PRICE).collect()) == [3.0, 4.0]


def test_max_articles_keeps_newest_per_payload(spark, store, tmp_path):
    arts = {"Data": [{"TITLE": f"t{i}", "URL": f"u{i}", "PUBLISHED_ON": 1713654000 + i * 60} for i in range(25)]}
    n = landing(tmp_path, "news", [env_line("BTC", T0, 1, arts), env_line("ETH", T0, 1, NEWS)])
    res = run_ingest(spark, store, news=n, max_articles=20)[2]
    assert res.ok and res.rows_written == 21
    got = sorted(int(r.headline[1:]) for r in store.read(S.NEWS).where("asset = 'BTC'").collect())
    assert got == list(range(5, 25))


def test_report_counts_dedup_and_empty_urls(spark, store, tmp_path):
    arts = {"Data": [{"TITLE": "a", "PUBLISHED_ON": 1713654000}, {"TITLE": "b", "PUBLISHED_ON": 1713654000},
                     {"TITLE": "c", "URL": "x", "PUBLISHED_ON": 1713654000}]}
    n = landing(tmp_path, "news", [env_line("BTC", T0, 1, arts)])
    r = run_ingest(spark, store, news=n)[2]
    assert (r.rows_in, r.rows_written, r.rows_deduped, r.rows_empty_url) == (3, 2, 1, 2)
    r2 = run_ingest(spark, store, news=n)[2]
    assert (r2.rows_written, r2.rows_ignored) == (0, 2)


def test_quarantined_payloads_are_kept(spark, store, tmp_path):
    bad = {"prices": [[1713654000000, None]]}
    p = landing(tmp_path, "price", [env_line("BTC", T0, 1, bad), env_line("ETH", T0, 1, CHART), "{oops"])
    r = run_ingest(spark, store, price=p)[0]
    assert r.ok and r.quarantined == 2
    q = {(x.source, x.asset, x.reason) for x in store.read_quarantine().collect()}
    assert q == {("price", "BTC", "invalid_values"), ("price", None, "corrupt_envelope")}
    assert all(x.raw for x in store.read_quarantine().collect())


def test_ingest_frame_strict_and_lenient_times(spark, store):
    from tidemark.plans.ingest import ingest_frame
    ddl = "asset string, timestamp string, close double, market_cap double, volume double, source string"
    rows = [("TRX", "2023-03-09 02:05:00+00:00", 3.0, 1.0, 1.0, "feed"), ("TRX", "2023-03-09T02:41:00Z", 4.0, 1.0, 1.0, "feed"),
            ("ADA", "noon or so", 2.0, 1.0, 1.0, "feed"), ("ADA", "12:30:00", 2.0, 1.0, 1.0, "feed"),
            ("MOON", "2023-03-09 18:00:00+00:00", 1.0, 0.0, 0.0, "feed")]
    df = spark.createDataFrame(rows, ddl).coalesce(1)
    strict = ingest_frame(spark, store, "price", df, strict=True)
    assert not strict.ok and store.read(S.PRICE).count() == 0      # unparseable time fails the batch
    lenient = ingest_frame(spark, store, "price", df)
    assert lenient.ok and lenient.quarantined_rows == 2
    assert [(r.asset, r.close) for r in store.read(S.PRICE).collect()] == [("TRX", 4.0)]
    assert [r.reason for r in store.read_quarantine().collect()] == ["bad_event_time"] * 2


def test_news_stream_replay_after_failure_changes_nothing(spark, tmp_path):
    arts = {"Data": [{"TITLE": f"t{i}", "URL": f"u{i}", "PUBLISHED_ON": 1713654000 + i} for i in range(5)]}
    st = TableStore(spark, str(tmp_path / "ns"))
    st.create_tables([S.NEWS])
    land = str(tmp_path / "news_land")
    write_lines(land, [env_line("BTC", T0, 1, arts)])
    run_stream_to_completion(spark, st, "news", land, str(tmp_path / "ck1"))
    before = sorted(tuple(r) for r in st.read(S.NEWS).collect())
    # a fresh checkpoint re-delivers the same files, as a replay after a lost commit would
    run_stream_to_completion(spark, st, "news", land, str(tmp_path / "ck2"))
    assert sorted(tuple(r) for r in st.read(S.NEWS).collect()) == before
    assert sorted(r.id for r in st.read(S.NEWS).collect()) == [1, 2, 3, 4, 5]


def test_empty_landing_fails_source_cleanly(spark, store, tmp_path):
    import os
    empty = str(tmp_path / "empty_land")
    os.makedirs(empty)
    r = run_ingest(spark, store, price=empty)[0]
    assert not r.ok and r.payloads == 0 and "no usable payload" in r.error
    assert store.read(S.PRICE).count() == 0


def test_readings_end_to_end_through_the_store(spark, store):
    from tests.test_harmonise import READINGS, last_of_hour, readings
    from tidemark.plans.ingest import ingest_frame
    df = readings(spark).drop("batch_id").coalesce(1)
    r = ingest_frame(spark, store, "price", df)
    assert r.ok and (r.rows_in, r.rows_written) == (len(READINGS) - 2, len(last_of_hour()))
    window = ("2023-03-09 00:00:00", "2023-03-09 23:00:00")
    day = store.read_window(S.PRICE, *window).collect()
    assert {(x.asset, x.timestamp.hour): x.close for x in day} == last_of_hour()
    again = ingest_frame(spark, store, "price", df)                     # replay: nothing changes
    assert again.ok and sorted(store.read_window(S.PRICE, *window).collect()) == sorted(day)


def test_failure_kinds(spark, store, tmp_path):
    from tidemark.plans.ingest import failure_kind, ingest_source
    assert failure_kind(ValueError("Missing required columns: ['x']")) == "data"
    assert failure_kind(RuntimeError("disk gone")) == "system"
    r = ingest_source(spark, store, "price", landing(tmp_path, "p", ["{broken"]))
    assert r.failure == "data"
    gone = TableStore(spark, str(tmp_path / "no_tables"))          # tables never created
    r = ingest_source(spark, gone, "price", landing(tmp_path, "p2", [env_line("BTC", T0, 1, CHART)]))
    assert not r.ok and r.failure == "system"


def test_report_counts_unsupported_asset_payloads(spark, store, tmp_path):
    p = landing(tmp_path, "price", [env_line("BTC", T0, 1, CHART), env_line("LUNA", T0, 1, CHART),
                                    env_line("PEPE", T0, 1, {"prices": [[1, None]]})])
    r = run_ingest(spark, store, price=p)[0]
    assert (r.payloads, r.quarantined, r.payloads_unsupported, r.rows_written) == (3, 1, 1, 1)


def test_stream_keeps_late_and_equal_envelopes(spark, tmp_path):
    """A late payload, and another payload with the same envelope, are both taken; a copy changes nothing."""
    st = TableStore(spark, str(tmp_path / "dd"))
    st.create_tables([S.PRICE])
    land, rep = str(tmp_path / "dd_land"), str(tmp_path / "dd_rep")
    hour = 3_600_000
    line = env_line("BTC", T0, 1, chart([(1713654000000, 1.0)]))
    write_lines(land, [line, "{broken one", "{broken two"])
    write_lines(land, [line, env_line("BTC", T0, 1, chart([(1713654000000 + hour, 2.0)]))])
    write_lines(land, [env_line("ETH", "2024-04-01T00:00:00Z", 1, chart([(1711929600000, 3.0)]))])
    run_stream_to_completion(spark, st, "price", land, str(tmp_path / "dd_ck"), report_path=rep, max_files_per_trigger=1)
    r = spark.read.parquet(rep).collect()
    assert sum(x.payloads for x in r) == 6 and sum(x.quarantined for x in r) == 2
    assert sorted(x.close for x in st.read(S.PRICE).collect()) == [1.0, 2.0, 3.0]


def test_older_batch_handled_last_does_not_win(spark, tmp_path):
    newer = env_line("BTC", "2024-04-21T02:00:00Z", 2, chart([(1713654000000, 200.0)]))
    older = env_line("BTC", T0, 1, chart([(1713654000000, 100.0)]))
    seen = []
    for name, files in (("ab", [newer, older]), ("ba", [older, newer])):
        st = TableStore(spark, str(tmp_path / name))
        st.create_tables([S.PRICE])
        land = str(tmp_path / f"{name}_land")
        for k, line in enumerate(files):
            write_lines(land, [line])
            run_stream_to_completion(spark, st, "price", land, str(tmp_path / f"{name}_ck"))
        seen.append([r.close for r in st.read(S.PRICE).collect()])
    assert seen == [[200.0], [200.0]]


def test_max_articles_counts_every_delivery_on_its_own(spark, tmp_path):
    arts = {"Data": [{"TITLE": f"t{i}", "URL": f"u{i}", "PUBLISHED_ON": 1713654000 + i * 60} for i in range(30)]}
    stored = []
    for times in (1, 2):
        st = TableStore(spark, str(tmp_path / f"m{times}"))
        st.create_tables([S.NEWS])
        run_ingest(spark, st, news=landing(tmp_path, f"news{times}", [env_line("BTC", T0, 1, arts)] * times), max_articles=20)
        stored.append(sorted(r.headline for r in st.read(S.NEWS).collect()))
    assert stored[0] == stored[1] and len(stored[0]) == 20


def test_handling_a_landing_again_leaves_the_quarantine_alone(spark, store, tmp_path):
    assert store.read_quarantine().count() == 0                       # a fresh store has an empty one
    p = landing(tmp_path, "price", [env_line("BTC", T0, 1, CHART), "{oops", env_line("ETH", T0, 1, {"prices": [[1, None]]})])
    for _ in range(2):
        assert run_ingest(spark, store, price=p)[0].quarantined == 2
        assert store.read_quarantine().count() == 2


def test_payloads_of_unsupported_assets_only_are_no_failure(spark, store, tmp_path):
    r = run_ingest(spark, store, price=landing(tmp_path, "price", [env_line("MOON", T0, 1, CHART)]))[0]
    assert r.ok and (r.payloads, r.payloads_unsupported, r.rows_in) == (1, 1, 0)


def test_conflicting_payloads_with_same_envelope_identity_resolve_deterministically(spark, tmp_path):
    a = env_line("BTC", T0, 7, chart([(1713654000000, 1.0)]))
    b = env_line("BTC", T0, 7, chart([(1713654000000, 2.0)]))
    results = []
    for i, lines in enumerate(([a, b], [b, a])):
        st = TableStore(spark, str(tmp_path / f"order{i}"))
        st.create_tables([S.PRICE])
        land = str(tmp_path / f"order_land{i}")
        for line in lines:                                  # one file each, so order varies
            write_lines(land, [line])
        run_ingest(spark, st, price=land)
        results.append([r.close for r in st.read(S.PRICE).collect()])
    assert results[0] == results[1] and len(results[0]) == 1


# --- queries over ingested tables: a failed batch is no result -------------------------------

def driver_tables(spark, path, documents):
    """Tables that the landing payloads are derived from: documents (id, source, text) and a few events."""
    spark.createDataFrame(documents, "doc_id long, source string, text string").write.parquet(f"{path}/documents.parquet")
    events = [(i, "click", dt.datetime(2024, 1, 3, i % 24), float(i)) for i in range(1, 600)]
    spark.createDataFrame(events, "event_id long, event_type string, ts timestamp_ntz, value double") \
        .write.parquet(f"{path}/events.parquet")
    return str(path)


ARTICLES = [(5, "src0", "calm"), (6, "src0", "wind"), (105, "src0", "calm"), (106, "src1", "rain"), (107, "src1", "")]


@pytest.mark.parametrize("fails", [1, 2])
def test_a_failed_batch_is_no_result_of_stored_news_ids(spark, tmp_path, monkeypatch, fails):
    from tidemark.plans import endtoend
    from tidemark.plans.ingest import SourceFailed
    sf = driver_tables(spark, tmp_path / "t", ARTICLES)
    calls, insert = [], TableStore.insert_ignore

    def insert_ignore(self, *args, **kwargs):
        calls.append(1)
        if len(calls) == fails:
            raise OSError("disk gone")
        return insert(self, *args, **kwargs)
    monkeypatch.setattr(TableStore, "insert_ignore", insert_ignore)
    with pytest.raises(SourceFailed, match="news .system failure.: OSError: disk gone"):
        endtoend.q_stored_news_ids(spark, sf)
    assert len(calls) == fails                                      # no batch after a failed one
    del calls[:]
    monkeypatch.setattr(TableStore, "insert_ignore", insert)
    assert tuple(endtoend.q_stored_news_ids(spark, sf).first()) == (3, 3, 1, 3, 2, 1)


@pytest.mark.parametrize("documents, result", [
    (ARTICLES[:2], (2, 2, 1, 2, 0, 0)),                             # no payload in the first batch
    ([*ARTICLES[:2], (105, None, "rain")], (2, 2, 1, 2, 0, 0)),     # only a rejected one
    (ARTICLES[2:], (2, 2, 1, 2, 2, 2)),                             # the second batch lands the first again
])
def test_stored_news_ids_of_batches_without_rows(spark, tmp_path, documents, result):
    from tidemark.plans import endtoend
    assert tuple(endtoend.q_stored_news_ids(spark, driver_tables(spark, tmp_path / "t", documents)).first()) == result


def test_a_failed_batch_is_no_result_of_other_queries(spark, tmp_path, monkeypatch):
    from tidemark.plans import endtoend
    from tidemark.plans.ingest import SourceFailed
    sf = driver_tables(spark, tmp_path / "t", ARTICLES)

    def fail(*args, **kwargs):
        raise OSError("disk gone")
    monkeypatch.setattr(TableStore, "insert_ignore", fail)
    monkeypatch.setattr(TableStore, "upsert", fail)
    for name in ("stored_price_table", "stored_market_window", "stored_news_table", "stored_stats_pushed", "stored_price_interleaved",
                 "news_max_articles_redelivered", "quarantine_after_replay"):
        with pytest.raises(SourceFailed, match="disk gone"):
            endtoend.END_TO_END_QUERIES[name](spark, sf)
    report = {r.source: (r.ok, r.failure) for r in endtoend.q_run_report(spark, sf).collect()}
    assert report == {k: (False, "system") for k in ("price", "market", "news")}   # the report tells failures
