import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.plans.store import TableStore

PRICE_IN = ("asset string, timestamp timestamp, close double, market_cap double, volume double, "
            "source string, batch_id long, ingest_ts timestamp, seq long")
MARKET_IN = ("timestamp timestamp, btc_dominance double, total_market_cap_usd double, "
             "total_volume_usd double, source string, batch_id long, ingest_ts timestamp, seq long")
NEWS_IN = ("asset string, headline string, url string, timestamp timestamp, votes_positive long, "
           "votes_negative long, source string, batch_id long, ingest_ts timestamp, seq long")
T10 = dt.datetime(2024, 1, 1, 10, 0)


@pytest.fixture
def store(spark, tmp_path):
    s = TableStore(spark, str(tmp_path / "store"))
    s.create_tables()
    return s


def price(spark, rows, batch=1):
    return spark.createDataFrame([(a, t, c, mc, 1e9, "coingecko", batch, t, i)
                                  for i, (a, t, c, mc) in enumerate(rows)], PRICE_IN)


def news(spark, rows, batch=1):
    return spark.createDataFrame([(a, h, u, t, 0, 0, "cryptocompare", batch, t, i)
                                  for i, (a, h, u, t) in enumerate(rows)], NEWS_IN)


def market(spark, rows, batch=1):
    return spark.createDataFrame([(t, d, 1e12, 1e10, "coingecko", batch, t, i)
                                  for i, (t, d) in enumerate(rows)], MARKET_IN)


def test_create_is_idempotent_and_tables_empty(spark, store):
    store.create_tables()
    for spec in (S.PRICE, S.MARKET, S.NEWS):
        df = store.read(spec)
        assert df.count() == 0
        assert [f.name for f in df.schema.fields][:len(spec.columns)] == spec.columns


def test_missing_table_raises(spark, tmp_path):
    s = TableStore(spark, str(tmp_path / "nothing"))
    with pytest.raises(Exception):
        s.read(S.PRICE).count()
    with pytest.raises(Exception):
        s.read_window(S.NEWS, T10, T10, "BTC").count()
    with pytest.raises(Exception):
        s.upsert(S.PRICE, price(spark, [("BTC", T10, 1.0, 1.0)]))
    with pytest.raises(Exception):
        s.upsert(S.MARKET, market(spark, [(T10, 50.0)]))
    with pytest.raises(Exception):
        s.insert_ignore(S.NEWS, news(spark, [("BTC", "h", "u", T10)]))


def test_price_upsert_then_replace(spark, store):
    store.upsert(S.PRICE, price(spark, [("TRX", T10, 11.0, 3.0), ("ADA", T10, 12.0, 4.0), ("SOL", T10, 13.0, None)]))
    assert store.read(S.PRICE).count() == 3
    store.upsert(S.PRICE, price(spark, [("ADA", T10, 0.25, 9.0)], batch=2))
    got = {r.asset: (r.close, r.market_cap) for r in store.read(S.PRICE).collect()}
    assert got == {"TRX": (11.0, 3.0), "ADA": (0.25, 9.0), "SOL": (13.0, None)}


def test_replace_is_whole_row_null_overwrites(spark, store):
    store.upsert(S.PRICE, price(spark, [("BTC", T10, 1.0, 5.0)]))
    store.upsert(S.PRICE, price(spark, [("BTC", T10, 2.0, None)], batch=2))
    r = store.read(S.PRICE).first()
    assert (r.close, r.market_cap) == (2.0, None)


def test_in_batch_last_arrival_wins_regardless_of_time_order(spark, store):
    rows = [("BTC", dt.datetime(2024, 1, 1, 10, 0), 1.0, 1.0), ("BTC", dt.datetime(2024, 1, 1, 10, 0), 3.0, 1.0),
            ("BTC", dt.datetime(2024, 1, 1, 10, 0), 2.0, 1.0)]
    store.upsert(S.PRICE, price(spark, rows))
    assert [r.close for r in store.read(S.PRICE).collect()] == [2.0]


def test_replay_is_idempotent_and_other_months_untouched(spark, store, tmp_path):
    jan = price(spark, [("BTC", dt.datetime(2024, 1, 5, 1), 1.0, 1.0), ("ETH", dt.datetime(2024, 1, 6, 1), 2.0, 1.0)])
    feb = price(spark, [("BTC", dt.datetime(2024, 2, 5, 1), 3.0, 1.0)])
    store.upsert(S.PRICE, jan)
    store.upsert(S.PRICE, feb)
    before = store._pointer(S.PRICE)["parts"]["month=2024-01"]
    snapshot = sorted(tuple(r) for r in store.read(S.PRICE).collect())
    store.upsert(S.PRICE, feb)              # replay
    assert sorted(tuple(r) for r in store.read(S.PRICE).collect()) == snapshot
    assert store._pointer(S.PRICE)["parts"]["month=2024-01"] == before


def test_not_null_violation_fails_batch_nothing_written(spark, store):
    bad = price(spark, [("BTC", T10, 1.0, 1.0), ("ETH", T10, None, 1.0)])
    with pytest.raises(ValueError, match="NOT NULL"):
        store.upsert(S.PRICE, bad)
    assert store.read(S.PRICE).count() == 0


def test_nan_is_null(spark, store):
    with pytest.raises(ValueError, match="NOT NULL"):
        store.upsert(S.PRICE, price(spark, [("BTC", T10, float("nan"), 1.0)]))
    store.upsert(S.PRICE, price(spark, [("BTC", T10, 1.0, float("nan"))]))
    assert store.read(S.PRICE).first().market_cap is None


def test_empty_batch_is_noop(spark, store):
    st = store.upsert(S.PRICE, price(spark, []))
    assert st.rows_written == 0 and store.read(S.PRICE).count() == 0
    st = store.insert_ignore(S.NEWS, news(spark, []))
    assert st.rows_written == 0 and store.read(S.NEWS).count() == 0


def test_market_upsert(spark, store):
    store.upsert(S.MARKET, market(spark, [(T10, 18.25), (T10 + dt.timedelta(hours=3), 19.0)]))
    store.upsert(S.MARKET, market(spark, [(T10, 17.75)], batch=2))
    assert sorted(r.btc_dominance for r in store.read(S.MARKET).collect()) == [17.75, 19.0]


def test_news_insert_ignore_first_wins(spark, store):
    store.insert_ignore(S.NEWS, news(spark, [("TRX", "quiet day", "p/quiet", T10), ("SOL", "loud day", "p/loud", T10),
                                            ("SOL", "long night", "p/night", T10)]))
    st = store.insert_ignore(S.NEWS, news(spark, [("SOL", "loud day, again", "p/loud", T10), ("SOL", "dawn", "p/dawn", T10)], batch=2))
    assert (st.rows_written, st.rows_ignored) == (1, 1)
    got = {r.url: r.headline for r in store.read(S.NEWS).collect()}
    assert got == {"p/quiet": "quiet day", "p/loud": "loud day", "p/night": "long night", "p/dawn": "dawn"}


def test_an_earlier_arrival_handled_later_takes_its_place(spark, store):
    store.insert_ignore(S.NEWS, news(spark, [("SOL", "second", "p/1", T10), ("SOL", "other", "p/2", T10)], batch=5))
    ids = {r.url: r.id for r in store.read(S.NEWS).collect()}
    st = store.insert_ignore(S.NEWS, news(spark, [("SOL", "first", "p/1", T10), ("SOL", "new", "p/3", T10)], batch=4))
    assert (st.rows_written, st.rows_ignored) == (2, 0)
    got = {r.url: (r.headline, r.id) for r in store.read(S.NEWS).collect()}
    assert got == {"p/1": ("first", ids["p/1"]), "p/2": ("other", ids["p/2"]), "p/3": ("new", 3)}
    up = store.upsert(S.PRICE, price(spark, [("SOL", T10, 2.0, 1.0)], batch=5))
    down = store.upsert(S.PRICE, price(spark, [("SOL", T10, 1.0, 1.0), ("TRX", T10, 3.0, 1.0)], batch=4))
    assert (up.rows_written, down.rows_written, down.rows_ignored) == (1, 1, 1)
    assert sorted((r.asset, r.close) for r in store.read(S.PRICE).collect()) == [("SOL", 2.0), ("TRX", 3.0)]


def test_a_run_lost_before_the_switch_changes_nothing(spark, store, monkeypatch):
    store.upsert(S.PRICE, price(spark, [("SOL", T10, 1.0, 1.0), ("TRX", T10, 2.0, 1.0)]))
    store.insert_ignore(S.NEWS, news(spark, [("SOL", "h", "p/1", T10)]))
    before = [sorted(tuple(r) for r in store.read(t).collect()) for t in (S.PRICE, S.NEWS)]

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(TableStore, "_switch", lost)
        for write in (lambda: store.upsert(S.PRICE, price(spark, [("SOL", T10, 9.0, 1.0)], batch=2)),
                      lambda: store.insert_ignore(S.NEWS, news(spark, [("SOL", "x", "p/2", T10)], batch=2)),
                      lambda: store.compact(S.PRICE)):
            with pytest.raises(RuntimeError, match="driver lost"):
                write()
    assert [sorted(tuple(r) for r in store.read(t).collect()) for t in (S.PRICE, S.NEWS)] == before
    for _ in range(2):                                                 # the replay converges
        store.upsert(S.PRICE, price(spark, [("SOL", T10, 9.0, 1.0)], batch=2))
        store.insert_ignore(S.NEWS, news(spark, [("SOL", "x", "p/2", T10)], batch=2))
    assert sorted((r.asset, r.close) for r in store.read(S.PRICE).collect()) == [("SOL", 9.0), ("TRX", 2.0)]
    assert sorted((r.url, r.id) for r in store.read(S.NEWS).collect()) == [("p/1", 1), ("p/2", 2)]


def test_a_second_writer_fails_and_old_versions_go(spark, store):
    pointer = store._pointer(S.PRICE)
    for k in range(4):
        store.upsert(S.PRICE, price(spark, [("SOL", T10, float(k), 1.0)], batch=k))
    with pytest.raises(RuntimeError, match="another writer"):
        store._switch(S.PRICE, {**pointer, "version": 4})
    assert [r.close for r in store.read(S.PRICE).collect()] == [3.0]
    left = [d for d in os.listdir(store.path(S.PRICE)) if os.path.isdir(os.path.join(store.path(S.PRICE), d, "month=2024-01"))]
    assert sorted(d.split("-")[0] for d in left) == ["v=3", "v=4"]


@pytest.mark.parametrize("retries", [0, 3])
def test_two_writers_keep_the_first_ones_rows(spark, store, monkeypatch, retries):
    """Writer B reads, writes and publishes between A's write and A's switch."""
    store.retries = retries
    store.upsert(S.PRICE, price(spark, [("SOL", T10, 1.0, 1.0), ("TRX", T10, 2.0, 1.0)], batch=1))
    switch, other = TableStore._switch, TableStore(spark, store.root)
    calls = []

    def late(self, spec, pointer):
        if self is store and not calls:
            calls.append(1)
            other.upsert(S.PRICE, price(spark, [("SOL", T10, 99.0, 1.0), ("BTC", T10, 7.0, 1.0)], batch=3))
        return switch(self, spec, pointer)

    monkeypatch.setattr(TableStore, "_switch", late)
    write = lambda: store.upsert(S.PRICE, price(spark, [("SOL", T10, 5.0, 1.0), ("ETH", T10, 6.0, 1.0)], batch=2))
    if retries:
        write()
    else:
        with pytest.raises(RuntimeError, match="another writer"):
            write()
    want = {"SOL": 99.0, "TRX": 2.0, "BTC": 7.0, **({"ETH": 6.0} if retries else {})}  # batch 3 arrived after batch 2
    assert {r.asset: r.close for r in store.read(S.PRICE).collect()} == want
    assert {r.asset: r.close for r in other.read(S.PRICE).collect()} == want
    pointer = store._pointer(S.PRICE)
    named = {v for vs in pointer["parts"].values() for v in vs}
    assert all(os.path.isdir(store._version_path(S.PRICE, v)) for v in named)


def test_a_stream_and_a_batch_write_together(spark, store):
    """Two threads insert headlines and upsert prices at once: nothing is lost, ids stay unique."""
    from concurrent.futures import ThreadPoolExecutor

    stores = [TableStore(spark, store.root, retries=20) for _ in range(2)]

    def run(k):
        for j in range(3):
            n = 2 * j + k
            stores[k].insert_ignore(S.NEWS, news(spark, [("BTC", "h", f"u{n}", T10), ("ETH", "h", "same", T10)], batch=n + 1))
            stores[k].upsert(S.PRICE, price(spark, [("BTC", T10, float(n), 1.0), (f"A{n}", T10, 1.0, 1.0)], batch=n + 1))

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(run, range(2)))
    rows = store.read(S.NEWS).collect()
    assert sorted(r.url for r in rows) == ["same"] + [f"u{n}" for n in range(6)] and len({r.id for r in rows}) == 7
    prices = {r.asset: r.close for r in store.read(S.PRICE).collect()}
    assert prices["BTC"] == 5.0 and len(prices) == 7


def test_news_same_url_other_asset_is_other_key(spark, store):
    store.insert_ignore(S.NEWS, news(spark, [("BTC", "h", "https://x/1", T10), ("ETH", "h", "https://x/1", T10)]))
    assert store.read(S.NEWS).count() == 2


def test_news_null_url_skipped_empty_url_is_a_key(spark, store):
    st = store.insert_ignore(S.NEWS, news(spark, [("BTC", "a", None, T10), ("BTC", "b", "", T10),
                                                 ("BTC", "c", "", T10)]))
    assert (st.rows_null_dropped, st.rows_written, st.rows_deduped, st.rows_ignored, st.rows_empty_url) == \
        (1, 1, 1, 0, 2)
    assert [r.headline for r in store.read(S.NEWS).collect()] == ["b"]


def test_news_ids_unique_increasing_across_batches(spark, store):
    store.insert_ignore(S.NEWS, news(spark, [("BTC", f"h{i}", f"u{i}", T10) for i in range(7)]))
    store.insert_ignore(S.NEWS, news(spark, [("ETH", f"h{i}", f"u{i}", T10) for i in range(5)] +
                                     [("BTC", "dup", "u1", T10)], batch=2))
    df = store.read(S.NEWS)
    ids_btc = sorted(r.id for r in df.where("asset='BTC'").collect())
    ids_eth = sorted(r.id for r in df.where("asset='ETH'").collect())
    assert len(set(ids_btc + ids_eth)) == 12
    assert max(ids_btc) < min(ids_eth)
    assert sorted(ids_btc + ids_eth) == list(range(1, 13))


def test_windows_of_all_tables(spark, store):
    d = dt.datetime
    hours = [d(2022, 11, 30, 22), d(2022, 11, 30, 23), d(2022, 12, 1, 0), d(2022, 12, 1, 1)]
    store.upsert(S.PRICE, price(spark, [("ADA", t, float(i), 1.0) for i, t in enumerate(hours)] + [("TRX", hours[2], 7.0, 1.0)]))
    store.upsert(S.MARKET, market(spark, [(t, float(i)) for i, t in enumerate(hours[1:])]))
    store.insert_ignore(S.NEWS, news(spark, [("ADA", "a", "p/a", hours[0]), ("ADA", "b", "p/b", hours[3]), ("TRX", "c", "p/c", hours[1])]))
    s, e = (t.replace(tzinfo=dt.timezone.utc) for t in (hours[1], hours[2]))       # across a month's end, both included
    assert sorted(r.close for r in store.read_window(S.PRICE, s, e, "ADA").collect()) == [1.0, 2.0]
    assert store.read_window(S.PRICE, s, e).count() == 3 and store.read_window(S.PRICE, s, e, "XRP").count() == 0
    assert store.read_window(S.MARKET, s, e).count() == 2
    assert [r.url for r in store.read_window(S.NEWS, s, e).collect()] == ["p/c"]
    assert store.read_window(S.NEWS, s, e, "ADA").count() == 0
    for spec in (S.PRICE, S.MARKET, S.NEWS):
        assert store.read_window(spec, e, s).count() == 0                          # reversed bounds
        assert store.read_window(spec, d(1999, 1, 1), d(1999, 1, 2)).count() == 0
    out = store.read_window(S.PRICE, s, e, "ADA")
    assert out.columns == S.PRICE.columns
    assert dict(out.dtypes)["timestamp"] == "timestamp"


def test_round_trip_same_day_window_inclusive_both_ends(spark, store):
    d = dt.datetime
    rows = [("BTC", d(2025, 3, 1, h), float(h), 1.0) for h in (0, 5, 10, 23)] + [("BTC", d(2025, 3, 2, 0), 99.0, 1.0)]
    store.upsert(S.PRICE, price(spark, rows))
    same_day = store.read_window(S.PRICE, "2025-03-01 05:00:00", "2025-03-01 10:00:00", "BTC")
    assert sorted(r.close for r in same_day.collect()) == [5.0, 10.0]
    whole = store.read_window(S.PRICE, d(2025, 3, 1), d(2025, 3, 2), "BTC")
    assert whole.count() == 5


def test_window_read_prunes_partitions_and_pushes_filters(spark, store):
    d = dt.datetime
    store.upsert(S.PRICE, price(spark, [("BTC", d(2025, 1, 1, 0), 1.0, 1.0), ("BTC", d(2025, 3, 1, 0), 2.0, 1.0)]))
    df = store.read_window(S.PRICE, d(2025, 1, 1), d(2025, 1, 2), "BTC")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "month" in plan
    assert "PushedFilters" in plan and "asset" in plan
    assert df.count() == 1


def test_stored_keys_unique(spark, store):
    from tidemark.operators.audit import key_violations
    store.upsert(S.PRICE, price(spark, [("BTC", T10, float(i), 1.0) for i in range(5)]))
    store.upsert(S.PRICE, price(spark, [("BTC", T10, 9.0, 1.0)], batch=2))
    assert key_violations(store.read(S.PRICE), S.PRICE.key).count() == 0


def test_day_grain_rewrites_only_touched_day_and_prunes(spark, tmp_path):
    d = dt.datetime
    s = TableStore(spark, str(tmp_path / "daystore"), time_grain="day")
    s.create_tables([S.PRICE])
    s.upsert(S.PRICE, price(spark, [("BTC", d(2025, 1, 1, 5), 1.0, 1.0), ("BTC", d(2025, 1, 2, 5), 2.0, 1.0)]))
    before = s._pointer(S.PRICE)["parts"]["day=2025-01-01"]
    st = s.upsert(S.PRICE, price(spark, [("BTC", d(2025, 1, 2, 5), 3.0, 1.0)], batch=2))
    assert st.partitions == ["2025-01-02"]
    assert s._pointer(S.PRICE)["parts"]["day=2025-01-01"] == before
    w = s.read_window(S.PRICE, d(2025, 1, 2), d(2025, 1, 2, 23), "BTC")
    assert [r.close for r in w.collect()] == [3.0]
    assert "PartitionFilters" in w._jdf.queryExecution().executedPlan().toString()
    # reopening with another grain keeps the recorded layout
    again = TableStore(spark, str(tmp_path / "daystore"), time_grain="month")
    assert again.spec(S.PRICE).partition_col == "day"
    assert again.read(S.PRICE).count() == 2


def test_compaction_keeps_rows_and_ids(spark, store):
    for b in range(4):
        store.insert_ignore(S.NEWS, news(spark, [("BTC", f"h{b}{i}", f"u{b}{i}", T10) for i in range(3)], batch=b))
    before = sorted(tuple(r) for r in store.read(S.NEWS).collect())
    files_before = store.read(S.NEWS).inputFiles()
    assert store.compact(S.NEWS) == ["BTC"]
    files_after = store.read(S.NEWS).inputFiles()
    assert sorted(tuple(r) for r in store.read(S.NEWS).collect()) == before
    assert len(files_after) < len(files_before)


def test_upsert_is_partition_scoped_whatever_the_overwrite_setting(spark, store):
    d = dt.datetime
    store.upsert(S.PRICE, price(spark, [("BTC", d(2024, 1, 5, 1), 1.0, 1.0), ("BTC", d(2024, 2, 5, 1), 2.0, 1.0)]))
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    for mode in ("static", "dynamic"):
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
        try:
            store.upsert(S.PRICE, price(spark, [("BTC", d(2024, 2, 5, 1), 3.0, 1.0)], batch=2))
        finally:
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    assert sorted(r.close for r in store.read(S.PRICE).collect()) == [1.0, 3.0]


def test_frame_level_not_null_guard(spark):
    from tidemark.operators.merge import guard_not_null, normalise_nan
    df = normalise_nan(spark.createDataFrame([("a", 1.0), ("b", float("nan"))], "k string, v double"))
    assert guard_not_null(df, ["v"], "drop").count() == 1
    with pytest.raises(ValueError, match="NOT NULL"):
        guard_not_null(df, ["v"], "fail")
    assert guard_not_null(df, ["k"], "fail").count() == 2


def test_store_audit_zero_after_merges_and_flags_a_duplicate(spark, store):
    from tidemark.plans.report import store_audit
    store.upsert(S.PRICE, price(spark, [("BTC", T10, 1.0, 1.0), ("ETH", T10, 2.0, 1.0)]))
    store.upsert(S.PRICE, price(spark, [("BTC", T10, 3.0, 1.0)], batch=2))
    store.insert_ignore(S.NEWS, news(spark, [("BTC", "h", "u", T10)]))
    audit = {(r.table, r.check): r.violations for r in store_audit(store).collect()}
    assert audit[("price_ohlcv", "duplicate_key")] == 0 and audit[("news_headlines", "null_url")] == 0
    assert all(v == 0 for v in audit.values())
    # a duplicate smuggled in by a plain append is caught
    store._publish(S.PRICE, store._pointer(S.PRICE), store._stored(S.PRICE).where("asset = 'ETH'"), replace=False)
    audit = {(r.table, r.check): r.violations for r in store_audit(store, [S.PRICE]).collect()}
    assert audit[("price_ohlcv", "duplicate_key")] == 1


def test_news_key_buckets_prune_existence_check_and_keep_semantics(spark, tmp_path):
    s = TableStore(spark, str(tmp_path / "bucketed"), key_buckets=8)
    s.create_tables([S.NEWS])
    s.insert_ignore(S.NEWS, news(spark, [("BTC", f"h{i}", f"https://x/{i}", T10) for i in range(40)]))
    st = s.insert_ignore(S.NEWS, news(spark, [("BTC", "again", "https://x/3", T10),
                                              ("BTC", "new", "https://x/new", T10)], batch=2))
    assert (st.rows_written, st.rows_ignored) == (1, 1)
    assert len(st.partitions) <= 2 and all(p.startswith("BTC#") for p in st.partitions)
    got = {r.url: r.headline for r in s.read_window(S.NEWS, T10, T10, "BTC").collect()}
    assert len(got) == 41 and got["https://x/3"] == "h3" and got["https://x/new"] == "new"
    assert len(s._pointer(S.NEWS)["parts"]) > 1
    plan = s.read(S.NEWS).where(F.col("asset_part").isin(st.partitions))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters" in plan
    again = TableStore(spark, str(tmp_path / "bucketed"))          # layout is recorded
    assert again.spec(S.NEWS).key_buckets == 8
    assert sorted(r.id for r in again.read(S.NEWS).collect()) == list(range(1, 42))


def test_key_broadcast_bounded_by_bytes(spark, store):
    store.broadcast_bytes = 10                     # tiny bound: must fall back to a plain join
    try:
        store.insert_ignore(S.NEWS, news(spark, [("BTC", "h", "https://x/1", T10)]))
        st = store.insert_ignore(S.NEWS, news(spark, [("BTC", "h2", "https://x/1", T10),
                                                     ("BTC", "h3", "https://x/2", T10)], batch=2))
        assert (st.rows_written, st.rows_ignored) == (1, 1)
        side = store._keys_side(spark.range(1), 1, 11)
        assert "broadcast" not in side._jdf.queryExecution().analyzed().toString().lower()
    finally:
        store.broadcast_bytes = 64 << 20


def test_window_bounds_in_other_zones_are_converted_to_utc(spark, store):
    d = dt.datetime
    store.upsert(S.PRICE, price(spark, [("BTC", d(2025, 1, 1, 0), 1.0, 1.0), ("BTC", d(2025, 1, 1, 1), 2.0, 1.0)]))
    ist = dt.timezone(dt.timedelta(hours=5, minutes=30))
    w = store.read_window(S.PRICE, d(2025, 1, 1, 5, 30, tzinfo=ist), d(2025, 1, 1, 5, 30, tzinfo=ist), "BTC")
    assert [r.close for r in w.collect()] == [1.0]                   # 05:30+05:30 == 00:00Z, inclusive
    w = store.read_window(S.PRICE, "2025-01-01T01:00:00+00:00", "2025-01-01T03:30:00+02:30", "BTC")
    assert [r.close for r in w.collect()] == [2.0]


def test_store_audit_on_day_grain_and_bucketed_news(spark, tmp_path):
    from tidemark.plans.report import store_audit
    s = TableStore(spark, str(tmp_path / "layouts"), time_grain="day", key_buckets=4)
    s.create_tables()
    d = dt.datetime
    s.upsert(S.PRICE, price(spark, [("BTC", d(2025, 1, 1, 1), 1.0, 1.0), ("BTC", d(2025, 1, 2, 1), 2.0, 1.0)]))
    s.upsert(S.MARKET, market(spark, [(d(2025, 1, 1, 1), 50.0)]))
    s.insert_ignore(S.NEWS, news(spark, [("BTC", f"h{i}", f"u{i}", T10) for i in range(9)]))
    audit = {(r.table, r.check): r.violations for r in store_audit(s).collect()}
    assert audit and all(v == 0 for v in audit.values())
    assert {t for t, _ in audit} == {"price_ohlcv", "market_signals", "news_headlines"}
    assert s.compact(S.PRICE) == ["2025-01-01", "2025-01-02"]
    assert s.read(S.PRICE).count() == 2


def test_insert_ignore_stages_no_texts(spark, store, monkeypatch):
    """What decides about rows is keys and arrivals; texts are written once, into the table."""
    from tidemark.plans import store as module
    staged, stage = [], module.stage
    monkeypatch.setattr(module, "stage", lambda df, *a, **kw: staged.append(set(df.columns)) or stage(df, *a, **kw))
    store.insert_ignore(S.NEWS, news(spark, [("SOL", "second", "p/1", T10), ("SOL", "other", "p/2", T10)], batch=5))
    st = store.insert_ignore(S.NEWS, news(spark, [("SOL", "first", "p/1", T10), ("SOL", "new", "p/3", T10),
                                                  ("SOL", "twice", "p/3", T10), ("SOL", "p/2 again", None, T10)], batch=4))
    assert len(staged) == 5 and not any("headline" in columns for columns in staged)
    assert (st.rows_in, st.rows_written, st.rows_ignored, st.rows_deduped, st.rows_null_dropped) == (4, 2, 0, 1, 1)
    assert {r.url: (r.headline, r.id) for r in store.read(S.NEWS).where("url <> 'p/2'").collect()}["p/3"] == ("new", 3)
    assert {r.headline for r in store.read(S.NEWS).collect()} == {"first", "other", "new"}


def test_batch_that_changes_between_reads_is_not_published(spark, store):
    store.insert_ignore(S.NEWS, news(spark, [("SOL", "h", "p/1", T10)]))
    url = F.udf(lambda u: u + uuid.uuid4().hex).asNondeterministic()
    batch = news(spark, [("SOL", f"h{k}", "p/", T10) for k in range(3)], batch=2).withColumn("url", url("url"))
    with pytest.raises(RuntimeError, match="not published"):
        store.insert_ignore(S.NEWS, batch)
    assert store.read(S.NEWS).count() == 1


def test_ids_are_given_to_keys_not_to_texts(spark, store, monkeypatch):
    seen, with_ids = [], TableStore._with_ids
    monkeypatch.setattr(TableStore, "_with_ids", lambda self, rows, start: seen.append(rows.columns) or with_ids(self, rows, start))
    store.insert_ignore(S.NEWS, news(spark, [("BTC", f"h{i}", f"u{i}", T10) for i in range(9)], batch=3))
    store.insert_ignore(S.NEWS, news(spark, [("BTC", f"g{i}", f"u{i}", T10) for i in range(8, 12)], batch=2))
    assert len(seen) == 2 and not any("headline" in columns for columns in seen)
    got = {r.url: (r.id, r.headline) for r in store.read(S.NEWS).collect()}
    assert sorted(i for i, _ in got.values()) == list(range(1, 13))
    assert all(got[f"u{k}"][0] <= 9 for k in range(9)) and got["u8"][1] == "g8"


def test_texts_are_dealt_once_by_partition(spark, store, monkeypatch):
    """One exchange deals the texts that a table gets, and stored rows that are written again are dealt by none."""
    plans, publish = [], TableStore._publish

    def kept(self, spec, pointer, df, *a, **kw):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return publish(self, spec, pointer, df, *a, **kw)

    monkeypatch.setattr(TableStore, "_publish", kept)
    store.insert_ignore(S.NEWS, news(spark, [("BTC", f"h{i}", f"u{i}", T10) for i in range(9)], batch=3))
    store.insert_ignore(S.NEWS, news(spark, [("BTC", f"g{i}", f"u{i}", T10) for i in range(8, 12)], batch=2))
    assert len(plans) == 2
    for plan in plans:
        dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and ("__cut" in line or "url" in line)]
        assert len(dealt) == 1 and "__cut" in dealt[0] and "rebalance" not in plan.lower()
    assert {r.url: r.headline for r in store.read(S.NEWS).collect()}["u8"] == "g8"


@pytest.mark.parametrize("limits", [{}, {"cut_bytes": 200}, {"broadcast_bytes": 0}, {"broadcast_rows": 0, "broadcast_bytes": 0, "cut_bytes": 200}])
def test_rows_do_not_depend_on_how_they_are_dealt(spark, tmp_path, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(TableStore, name, value)
    s = TableStore(spark, str(tmp_path / "dealt"))
    s.create_tables([S.NEWS])
    own = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else tiny groups meet in one task
    once = [("BTC", f"h{i}", f"u{i}", T10) for i in range(40)]
    s.insert_ignore(S.NEWS, news(spark, once + [("BTC", f"copy {k}", "u7", T10) for k in range(60)] + [("ETH", "e", "u7", T10)], batch=5))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", own)
    if "cut_bytes" in limits:
        assert len([f for f in s.read(S.NEWS).inputFiles() if "asset_part=BTC" in f]) > 1
    st = s.insert_ignore(S.NEWS, news(spark, [("BTC", "older", "u3", T10), ("BTC", "new", "v", T10), ("BTC", "newer", "v", T10)], batch=4))
    assert (st.rows_in, st.rows_written, st.rows_ignored, st.rows_deduped) == (3, 2, 0, 1)
    got = sorted((r.asset, r.url, r.headline) for r in s.read(S.NEWS).collect())
    assert got == sorted([("BTC", u, "older" if u == "u3" else h) for _, h, u, _ in once] + [("BTC", "v", "new"), ("ETH", "u7", "e")])
    ids = {(r.asset, r.url): r.id for r in s.read(S.NEWS).collect()}
    assert sorted(ids.values()) == list(range(1, 43)) and ids["BTC", "v"] == 42
