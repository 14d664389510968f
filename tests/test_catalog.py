"""Driver bindings: every query vs its DuckDB oracle, and end-to-end runs vs brute force."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, digest
from tidemark import schemas as S
from tidemark.plans import endtoend

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def exact_floats():
    """Compare float values exactly (no rounding) in the value hash."""
    import os
    old = os.environ.get("ORACLE_EXACT")
    os.environ["ORACLE_EXACT"] = "1"
    yield
    if old is None:
        os.environ.pop("ORACLE_EXACT", None)
    else:
        os.environ["ORACLE_EXACT"] = old


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(got) == len(want)
    assert digest(df.columns, got) == digest(ocols, want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["asset", "timestamp", "close"]
    assert df.count() > 0


def brute_force_prices(events: pd.DataFrame) -> dict:
    ev = events.sort_values("event_id").copy()
    ev["block"] = ev.event_id // 256
    bad_blocks = set(ev[(ev.event_type == "error") & (ev.event_id % 97 == 0)][["event_type", "block"]]
                     .itertuples(index=False, name=None))
    ev = ev[ev.event_type.isin(endtoend.PRICE_ASSETS)]
    ev = ev[[(a, b) not in bad_blocks for a, b in zip(ev.event_type, ev.block)]]
    last_in_block = ev.groupby(["event_type", "block"]).event_id.transform("max")
    size = ev.groupby(["event_type", "block"]).event_id.transform("size")
    ev["volume"] = [None if (i == m and n > 1) else v * 10
                    for i, m, n, v in zip(ev.event_id, last_in_block, size, ev.value)]
    ev["hour"] = ev.ts.dt.floor("h")
    win = ev.loc[ev.groupby(["event_type", "hour"]).event_id.idxmax()]
    return {(r.event_type, r.hour.to_pydatetime()): (r.value, r.value * 1000, r.volume)
            for r in win.itertuples()}


def test_end_to_end_matches_brute_force(spark):
    store, results = endtoend.ingest_into_store(spark, SF)
    assert all(r.ok for r in results), results
    events = pd.read_parquet(f"{SF}/events.parquet")
    want = brute_force_prices(events)
    got = {(r.asset, r.timestamp): (r.close, r.market_cap, r.volume) for r in store.read(S.PRICE).collect()}
    assert got.keys() == want.keys()
    for k, (c, m, v) in want.items():
        gc, gm, gv = got[k]
        assert gc == pytest.approx(c) and gm == pytest.approx(m)
        missing = v is None or v != v
        assert (gv is None and missing) or gv == pytest.approx(v)
    # market: one row per hour, values from the hour's aggregate
    hours = events.ts.dt.floor("h").nunique()
    assert store.read(S.MARKET).count() == hours
    # news: first arrival per (source, text digest) among supported sources
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    docs = docs[docs.source.isin(endtoend.NEWS_ASSETS) & (docs.text != "")]
    want_news = docs.sort_values("doc_id").drop_duplicates(["source", "text"])
    got_news = store.read(S.NEWS).select("asset", "headline", "id").collect()
    assert sorted((r.asset, r.headline) for r in got_news) == \
        sorted(zip(want_news.source, want_news.text))
    assert sorted(r.id for r in got_news) == list(range(1, len(got_news) + 1))
    # replaying the same landing changes nothing
    before = sorted(tuple(r) for r in store.read(S.PRICE).collect())
    endtoend.ingest_into_store(spark, SF, store)
    assert sorted(tuple(r) for r in store.read(S.PRICE).collect()) == before
    assert store.read(S.NEWS).count() == len(got_news)


def test_quarantine_counts_rows(spark):
    df = E.queries()["quarantine_counts"](spark, SF)
    bad = {(r.source, r.asset, r.reason): r.payloads for r in df.where("reason is not null").collect()}
    events = pd.read_parquet(f"{SF}/events.parquet")
    err = events[events.event_type == "error"]
    n_bad = err[err.event_id % 97 == 0].event_id.floordiv(256).nunique()
    assert bad.get(("price", "error", "invalid_values"), 0) == n_bad
