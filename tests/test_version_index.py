"""Key bitmaps and statistics kept per version folder; the quarantine's digests."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators import audit
from tidemark.plans import version_index as VI
from tidemark.plans.store import TableStore
from tests.test_store import T10, market, news, price


@pytest.fixture
def store(spark, tmp_path):
    s = TableStore(spark, str(tmp_path / "store"))
    s.create_tables()
    return s


def test_a_key_that_is_stored_is_never_ruled_out(spark, store):
    urls = [f"u{k}" for k in range(3000)]
    store.insert_ignore(S.NEWS, news(spark, [("BTC", "h", u, T10) for u in urls]))
    bitmaps = VI.derived(store, S.NEWS, store._pointer(S.NEWS), "keys")
    asked = spark.createDataFrame([("BTC", u, "BTC") for u in urls + [f"x{k}" for k in range(3000)]], "asset string, url string, asset_part string")
    found = {r.url for r in VI.may_hold(asked, bitmaps, store.spec(S.NEWS)).collect()}
    assert set(urls) <= found
    assert len(found) - len(urls) < 3000 / 8


def test_new_articles_leave_stored_keys_unread(spark, store):
    for batch in range(4):
        got = store.insert_ignore(S.NEWS, news(spark, [("BTC", "h", f"b{batch}-{k}", T10) for k in range(20)]
                                                      + [("ETH", "h", f"e{batch}", T10)], batch))
        assert (got.rows_written, got.rows_ignored, got.folders_stored) == (21, 0, 2 * batch)
        assert got.folders_read <= batch / 2  # a few set bits may be met by chance
    again = store.insert_ignore(S.NEWS, news(spark, [("BTC", "later", "b1-7", T10), ("BTC", "h", "new", T10)], 9))
    assert (again.rows_written, again.rows_ignored, again.folders_stored) == (1, 1, 8)
    assert 1 <= again.folders_read <= 2
    assert store.read(S.NEWS).where("url = 'b1-7'").first()["headline"] == "h"
    assert store.read(S.NEWS).groupBy("asset", "url").count().where("count > 1").count() == 0


def test_an_earlier_arrival_still_takes_the_stored_place(spark, store):
    store.insert_ignore(S.NEWS, news(spark, [("BTC", "late", "u", T10), ("BTC", "x", "v", T10)], 5))
    store.insert_ignore(S.NEWS, news(spark, [("BTC", "early", "u", T10)], 1))
    assert {(r.url, r.headline) for r in store.read(S.NEWS).collect()} == {("u", "early"), ("v", "x")}


def test_only_versions_without_states_are_read(spark, store, monkeypatch):
    read = []
    made = VI.KINDS["stats"]
    monkeypatch.setitem(VI.KINDS, "stats", lambda rows, spec: read.append({r[0] for r in rows.select("v").distinct().collect()}) or made(rows, spec))
    assert store.batch_stats(S.PRICE).count() == 0
    feb = dt.datetime(2024, 2, 1)
    store.upsert(S.PRICE, price(spark, [("BTC", T10, 1.0, 1.0), ("ETH", feb, 2.0, 2.0)], 1))
    store.batch_stats(S.PRICE).collect()
    store.upsert(S.PRICE, price(spark, [("BTC", T10, 3.0, 1.0), ("BTC", T10 + dt.timedelta(hours=1), 3.0, 1.0)], 2))
    for _ in range(2):
        got = sorted(tuple(r) for r in store.batch_stats(S.PRICE).collect())
    assert got == sorted(tuple(r) for r in audit.batch_stats_by_asset(store.read(S.PRICE)).collect())
    assert len(read) == 2 and all(len(v) == 1 for v in read) and read[0] != read[1]


def test_statistics_of_a_table_without_assets(spark, store):
    store.upsert(S.MARKET, market(spark, [(T10, 50.0), (T10 + dt.timedelta(hours=3), 51.0)]))
    row = store.batch_stats(S.MARKET).collect()
    assert [(r.asset, r.n) for r in row] == [(None, 2)]


def test_what_is_derived_goes_with_its_version(spark, store):
    for batch in range(6):
        store.upsert(S.PRICE, price(spark, [("BTC", T10, float(batch), 1.0)], batch))
        store.batch_stats(S.PRICE).collect()
    markers = [n for n in os.listdir(VI.folder(store, S.PRICE, "stats")) if n.startswith("of-")]
    assert len(markers) <= 3
    assert store.batch_stats(S.PRICE).first()["n"] == 1


def test_quarantine_reads_digests_of_the_batches_in_question_only(spark, store):
    def bad(rows):
        return spark.createDataFrame([("price", a, b, T10, "broken", raw) for a, b, raw in rows], S.QUARANTINE_SCHEMA)

    rows = [("BTC", 1, "{"), ("BTC", 1, "{"), (None, 1, None), ("BTC", None, "x"), ("BTC", None, None), ("B", 2, "TC{")]
    for _ in range(2):
        store.write_quarantine(bad(rows))
        assert store.read_quarantine().count() == 5
    store.write_quarantine(bad([("BTC", 3, "{"), ("BTC", 1, "{")]))
    store.write_quarantine(bad([]))
    assert sorted((r.asset or "", r.batch_id or 0, r.raw or "") for r in store.read_quarantine().collect()) == \
        sorted([("BTC", 1, "{"), ("", 1, ""), ("BTC", 0, "x"), ("BTC", 0, ""), ("B", 2, "TC{"), ("BTC", 3, "{")])
    assert store.read_quarantine().columns == S.QUARANTINE_SCHEMA.fieldNames()
