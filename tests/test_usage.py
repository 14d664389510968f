"""The README usage workflow, end to end through the top-level API."""

import datetime as dt

from tests.conftest import CHART, GLOBAL, NEWS, env_line, write_lines


def test_readme_workflow(spark, tmp_path):
    from tidemark import TableStore, ingest_frame, report_frame, run_all, run_ingest, start_ingest_stream
    from tidemark import schemas as S

    store = TableStore(spark, str(tmp_path / "market"))
    store.create_tables()
    t0 = "2024-04-21T00:10:00Z"
    price = write_lines(str(tmp_path / "landing/price"), [env_line("BTC", t0, 1, CHART), "{bad"])
    market = write_lines(str(tmp_path / "landing/global"), [env_line(None, t0, 1, GLOBAL)])
    news = write_lines(str(tmp_path / "landing/news"), [env_line("ETH", t0, 1, NEWS)])

    results = run_ingest(spark, store, price=price, market=market, news=news, lookback_days=2, max_articles=20)
    rep = {r.source: r for r in report_frame(spark, results).collect()}
    assert all(r.ok for r in rep.values()) and rep["price"].quarantined == 1
    flags = run_all(spark, store, price=price, market=market, news=news)
    assert flags["price"] and flags["market"] and flags["master_features"] is False

    df = spark.createDataFrame([("BTC", "2024-04-20 23:59:00+00:00", 1.0, None, None, "x"),
                                ("BTC", "garbage", 2.0, None, None, "x")],
                               "asset string, timestamp string, close double, market_cap double, "
                               "volume double, source string")
    r = ingest_frame(spark, store, "price", df, batch_id=2)         # arrives after the landed batch 1
    assert r.ok and r.quarantined_rows == 1

    btc = store.read_window(S.PRICE, dt.datetime(2024, 4, 20), dt.datetime(2024, 4, 21), "BTC").collect()
    assert [x.close for x in btc] == [1.0]                    # the frame's row replaced the chart's
    eth = store.read_window(S.NEWS, "2024-04-20 00:00:00", "2024-04-21 00:00:00", "ETH").collect()
    assert len(eth) == 1
    reasons = {(x.source, x.reason) for x in store.read_quarantine().groupBy("source", "reason").count().collect()}
    assert reasons == {("price", "corrupt_envelope"), ("price", "bad_event_time")}

    q = start_ingest_stream(spark, store, "price", price, str(tmp_path / "chk"), available_now=True)
    q.awaitTermination()
    assert store.read(S.PRICE).count() == 1
