import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators.harmonise import (
    allowlist_audit, asset_dim, require_known_assets, filter_assets, floor_timestamps, harmonise_market,
    harmonise_news, harmonise_price, map_symbols, reject_assets, require_columns, skip_empty_text,
)
from tidemark.operators.merge import latest_per_key

PRICE_DDL = "asset string, timestamp string, close double, market_cap double, volume double, source string"
NEWS_DDL = ("asset string, headline string, url string, published_at string, votes_positive long, "
            "votes_negative long, source string")


# (asset, minutes after midnight of 9 March 2023, close): several points of an hour, hours apart, and
# two assets that are not supported
READINGS = [("SHIB", 61, 5.0), ("SHIB", 95, 6.5), ("TRX", 119, 1.5), ("TRX", 120, 2.5), ("TRX", 179, 3.5),
            ("DOGE", 240, 9.0), ("PEPE", 241, 1.0), ("DOGE", 299, 8.0), ("DOGE", 300, 7.0), ("ADA", 1439, 4.0),
            ("SHIB", 62, 7.5), ("WIF", 600, 2.0), ("ADA", 1380, 4.5)]


def readings(spark):
    start = dt.datetime(2023, 3, 9)
    rows = [(a, str(start + dt.timedelta(minutes=m)) + "+00:00", c, 50.0 + i, None, "feed", i) for i, (a, m, c) in enumerate(READINGS)]
    return spark.createDataFrame(rows, PRICE_DDL + ", seq long").withColumn("batch_id", F.lit(0))


def last_of_hour():
    """(asset, hour) -> close of the last reading that arrived."""
    return {(a, m // 60): c for a, m, c in READINGS if a not in ("PEPE", "WIF")}


def test_missing_columns_message_lists_in_contract_order(spark):
    df = spark.createDataFrame([("BTC", "2024-01-01")], "asset string, timestamp string")
    with pytest.raises(ValueError, match=r"Missing required columns: \['close', 'market_cap', 'volume', 'source'\]"):
        require_columns(df, S.PRICE_REQUIRED_COLUMNS)


def test_no_columns_at_all_raises(spark):
    with pytest.raises(ValueError, match="Missing required columns"):
        harmonise_price(spark.createDataFrame([], "x int").drop("x"))


def test_price_without_close_raises(spark):
    df = readings(spark).drop("close")
    with pytest.raises(ValueError, match=r"\['close'\]"):
        harmonise_price(df)


def test_news_without_published_at_raises(spark):
    df = spark.createDataFrame([], NEWS_DDL).drop("published_at")
    with pytest.raises(ValueError, match=r"\['timestamp'\]"):
        harmonise_news(df)


def test_market_without_btc_dominance_raises(spark):
    df = spark.createDataFrame([], "timestamp string, total_market_cap_usd double, "
                                   "total_volume_usd double, source string")
    with pytest.raises(ValueError, match=r"\['btc_dominance'\]"):
        harmonise_market(df)


def test_readings_are_filtered_floored_and_last_wins(spark):
    out = harmonise_price(readings(spark))
    assert out.count() == len(READINGS) - 2        # harmonise keeps every row of a supported asset
    assert out.where("asset in ('PEPE', 'WIF')").count() == 0
    assert out.where("minute(timestamp) <> 0 or second(timestamp) <> 0").count() == 0
    merged = latest_per_key(out, ["asset", "timestamp"], ["batch_id", "seq"])
    got = {(r.asset, r.timestamp.hour): r.close for r in merged.collect()}
    assert got == last_of_hour() and got[("SHIB", 1)] == 7.5 and got[("ADA", 23)] == 4.5


def test_minutes_and_seconds_zeroed(spark):
    df = spark.createDataFrame([("BTC", "2024-04-20 14:37:52", 1.0, None, None, "x")], PRICE_DDL)
    r = harmonise_price(df).first()
    assert (r.timestamp.hour, r.timestamp.minute, r.timestamp.second) == (14, 0, 0)


def test_unknown_asset_gives_empty(spark):
    df = spark.createDataFrame([("PEPE", "2024-01-01 00:00:00", 1.0, None, None, "x")], PRICE_DDL)
    assert harmonise_price(df).count() == 0


def test_asset_filter_exact_case_sensitive_and_null_dropped(spark):
    df = spark.createDataFrame([("btc",), ("BTC",), (None,), (" BTC",)], "asset string")
    assert [r.asset for r in filter_assets(df).collect()] == ["BTC"]
    dim = asset_dim(spark)
    assert [r.asset for r in filter_assets(df, dim).collect()] == ["BTC"]
    assert sorted(r.asset for r in reject_assets(df).collect()) == [" BTC", "btc"]


def test_allowlist_audit_counts_in_one_pass(spark):
    r = allowlist_audit(readings(spark)).first()
    assert (r.rows_in, r.rows_kept) == (len(READINGS), len(READINGS) - 2)


def test_symbol_map(spark):
    df = spark.createDataFrame([("BTC",), ("AVAX",), ("LUNA",)], "asset string")
    got = {r.asset: r.vendor_id for r in map_symbols(df, asset_dim(spark)).collect()}
    assert got == {"BTC": "bitcoin", "AVAX": "avalanche-2"}


def test_market_time_floored_no_asset_filter(spark):
    df = spark.createDataFrame([("2023-03-09 03:29:31+00:00", 33.0, 10.0, 2.0, "feed")],
                               "timestamp string, btc_dominance double, total_market_cap_usd double, "
                               "total_volume_usd double, source string")
    r = harmonise_market(df).first()
    assert r.timestamp == dt.datetime(2023, 3, 9, 3, 0)


def test_news_is_renamed_filtered_and_floored(spark):
    rows = [("TRX", "first", "p/1", "2023-03-09T22:59:59Z", 2, 1, "feed"), ("MOON", "second", "p/2", "2023-03-09T22:00:00Z", 0, 0, "feed"),
            ("AVAX", "third", "p/3", "2023-03-09 00:00:00", 0, 3, "feed")]
    out = harmonise_news(spark.createDataFrame(rows, NEWS_DDL))
    assert "published_at" not in out.columns and "timestamp" in out.columns
    assert sorted((r.asset, r.timestamp) for r in out.collect()) == [("AVAX", dt.datetime(2023, 3, 9)), ("TRX", dt.datetime(2023, 3, 9, 22))]


def test_offsets_converted_and_mixed_separators(spark):
    df = spark.createDataFrame([("2024-01-01T02:05:00+05:30",), ("2024-01-01 02:05:00",),
                                ("2024-01-01T02:59:59Z",)], "timestamp string")
    got = [r.timestamp for r in floor_timestamps(df).collect()]
    assert got == [dt.datetime(2023, 12, 31, 20, 0), dt.datetime(2024, 1, 1, 2, 0), dt.datetime(2024, 1, 1, 2, 0)]


def test_null_timestamp_stays_null(spark):
    df = spark.createDataFrame([(None,)], "timestamp string")
    assert floor_timestamps(df).first().timestamp is None


def test_unparseable_timestamp_strict_fails_lenient_nulls(spark):
    df = spark.createDataFrame([("2024-01-01 02:05:00",), ("not a time",)], "timestamp string")
    with pytest.raises(Exception):
        floor_timestamps(df, strict=True).collect()
    got = [r.timestamp for r in floor_timestamps(df, strict=False).collect()]
    assert got == [dt.datetime(2024, 1, 1, 2, 0), None]


def test_floor_independent_of_session_zone(spark):
    df = spark.createDataFrame([("2024-01-01 02:45:00+00:00",)], "timestamp string")
    floored = floor_timestamps(df).select(F.unix_seconds("timestamp").alias("s"))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        s = floored.first().s
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert s == int(dt.datetime(2024, 1, 1, 2, 0, tzinfo=dt.timezone.utc).timestamp())


def test_skip_empty_keeps_whitespace(spark):
    df = spark.createDataFrame([("",), (None,), ("  ",), ("x",)], "t string")
    assert sorted(r.t for r in skip_empty_text(df, "t").collect()) == ["  ", "x"]


def test_unknown_symbol_strict_raises_listing_valid(spark):
    df = spark.createDataFrame([("BTC",), ("FAKE",)], "asset string")
    with pytest.raises(ValueError, match=r"\['FAKE'\] not found.*Valid symbols: \['BTC', 'ETH'"):
        require_known_assets(df)
    ok = spark.createDataFrame([("BTC",), ("SHIB",)], "asset string")
    assert require_known_assets(ok).count() == 2


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.datetimes(min_value=dt.datetime(2000, 1, 1), max_value=dt.datetime(2040, 1, 1)),
                          st.integers(-12 * 4, 14 * 4), st.sampled_from([" ", "T"])), min_size=1, max_size=30))
def test_floor_matches_python_for_offsets_and_separators(spark, items):
    texts, want = [], []
    for naive, quarters, sep in items:
        naive = naive.replace(microsecond=0)
        off = dt.timedelta(minutes=15 * quarters)
        sign = "+" if off >= dt.timedelta(0) else "-"
        mins = abs(int(off.total_seconds())) // 60
        texts.append((naive.strftime(f"%Y-%m-%d{sep}%H:%M:%S") + f"{sign}{mins // 60:02d}:{mins % 60:02d}",))
        utc = naive - off
        want.append(utc.replace(minute=0, second=0))
    got = [r.timestamp for r in floor_timestamps(spark.createDataFrame(texts, "timestamp string")).collect()]
    assert got == want


def test_time_of_day_alone_is_not_a_time(spark):
    from tidemark.functions.timefn import parse_utc
    texts = ["05:07:00", "T05:07", "5:07", "2023-03-09", "2023-03-09T05:07", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(parse_utc("t", strict=False)).collect()]
    assert got[:3] == [None, None, None] and got[5] is None
    assert got[3:5] == [dt.datetime(2023, 3, 9), dt.datetime(2023, 3, 9, 5, 7)]
    with pytest.raises(Exception, match="no date"):
        df.where("t like '5%'").select(parse_utc("t")).collect()


def test_unknown_symbols_are_counted_when_the_list_is_cut(spark):
    df = spark.createDataFrame([(f"X{i:02d}",) for i in range(30)], "asset string")
    with pytest.raises(ValueError, match=r"30 symbol\(s\) .*first 20 shown"):
        require_known_assets(df)


def test_a_large_symbol_map_is_not_broadcast(spark):
    from tidemark.operators import harmonise
    small, large = asset_dim(spark), asset_dim(spark, {f"A{i}": "v" for i in range(harmonise.DIM_ROWS + 1)})
    hinted = lambda d: "broadcast" in d._jdf.queryExecution().analyzed().toString().lower()
    assert hinted(small) and not hinted(large)
