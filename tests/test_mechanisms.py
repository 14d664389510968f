"""VARIANT payloads, many windows in one read, streaming state."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.window import read_windows
from tidemark.plans.mechanisms import q_read_many_windows
from tidemark.sources import variant as V
from tidemark.sources.shred import classify_chart
from tidemark.sources.landing import landed_from_frame
from tidemark.streaming.stateful import first_seen, hourly_last, latest_updates, run_updates
from tests.conftest import UTC

T0 = dt.datetime(2025, 1, 1, 10, tzinfo=UTC)


def landed(spark, *payloads):
    return spark.createDataFrame([("BTC", T0, k, p if isinstance(p, str) or p is None else json.dumps(p)) for k, p in enumerate(payloads)],
                                 "asset string, ingest_ts timestamp, batch_id long, payload string")


def test_missing_null_number_and_text_are_four_things(spark):
    articles = [{"TITLE": "a"}, {"TITLE": "b", "URL": None, "PUBLISHED_ON": None}, {"TITLE": "c", "URL": "u", "PUBLISHED_ON": 1735725600},
                {"TITLE": "d", "URL": "", "PUBLISHED_ON": "1735725600"}, {"TITLE": ""}, {"TITLE": None}, {"URL": "x"},
                {"TITLE": "e", "URL": 5, "PUBLISHED_ON": 1735725600.5}, {"TITLE": "f", "PUBLISHED_ON": {"x": 1}},
                {"TITLE": "g", "PUBLISHED_ON": 1e30}]
    rows = V.shred_news_variant(landed(spark, {"Data": articles}, "{broken", None, {"Data": None}, {}, {"Data": []})).collect()
    got = {r.headline: (r.url, r.url_state, r.published_kind, r.published_at.timestamp()) for r in rows}
    ingest, given = T0.replace(tzinfo=None).timestamp(), 1735725600
    assert got["a"] == ("", "missing", "missing", 0)
    assert got["b"][:3] == (None, "null", "null") and got["b"][3] == got["d"][3] == got["f"][3] == got["g"][3] == pytest.approx(ingest)
    assert got["c"] == ("u", "value", "number", given)
    assert got["d"][:3] == ("", "value", "text") and got["f"][2] == "other"
    assert got["e"] == ("5", "value", "number", given + 0.5) and set(got) == set("abcdefg")


def test_null_array_fails_a_chart_missing_one_does_not(spark):
    df = landed(spark, {"prices": [[1, 2.0]]}, {"prices": [[1, 2.0]], "market_caps": None}, {"prices": None}, {}, "{broken", None)
    got = [r.bad for r in df.orderBy("batch_id").select(V.chart_has_null_array(F.col("payload")).alias("bad")).collect()]
    assert got == [False, True, True, False, False, False]
    strict = [r.reason for r in classify_chart(landed_from_frame(df), strict_nulls=True).orderBy("batch_id").collect()]
    assert strict == [None, "invalid_values", "invalid_values", None, "unparseable_payload", "unparseable_payload"]
    lenient = [r.reason for r in classify_chart(landed_from_frame(df)).orderBy("batch_id").collect()]
    assert lenient[:4] == [None] * 4


def windows_brute(rows, requests):
    return sorted((q, r) for q, asset, s, e in requests for r, a, t in rows
                  if None not in (s, e, t) and s <= t <= e and (asset is None or asset == a))


@pytest.mark.parametrize("grain", ["hour", "day", "month"])
def test_many_windows_equal_one_by_one(spark, grain):
    base = dt.datetime(2024, 2, 28)
    rows = [(k, "ABC"[k % 3], base + dt.timedelta(minutes=37 * k)) for k in range(200)] + [(900, "A", None), (901, None, base)]
    requests = [(1, "A", base, base + dt.timedelta(hours=5)), (2, "B", base + dt.timedelta(days=1), base), (3, None, base, base),
                (4, "A", dt.datetime(1900, 1, 1), dt.datetime(2100, 1, 1)), (5, "Z", base, base + dt.timedelta(days=9)), (6, None, None, base),
                (7, "C", rows[5][2], rows[5][2]), (1, "A", base, base + dt.timedelta(minutes=74)), (8, None, base, base + dt.timedelta(days=3))]
    df = spark.createDataFrame(rows, "row long, asset string, timestamp timestamp_ntz")
    asked = spark.createDataFrame(requests, "request_id long, asset string, start timestamp_ntz, end timestamp_ntz")
    out = read_windows(df, asked, grain=grain)
    assert sorted((r.request_id, r.row) for r in out.collect()) == windows_brute(rows, requests)
    plan = out._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert read_windows(df.limit(0), asked, grain=grain).count() == 0 and read_windows(df, asked.limit(0), grain=grain).count() == 0


@pytest.mark.parametrize("grain", ["hour", "day", "month"])
def test_totals_of_many_windows_without_their_pairs(spark, grain):
    base = dt.datetime(2024, 2, 28)
    rng = random.Random(7)
    rows = [(k if k % 11 else None, "ABC"[k % 3], base + dt.timedelta(seconds=rng.randrange(0, 400_000, 600), microseconds=k % 2))
            for k in range(300)] + [(900, "A", None), (901, None, base)]
    requests = [(rng.randrange(60), rng.choice(["A", "B", "", None]), base + dt.timedelta(seconds=s, microseconds=u % 2),
                 base + dt.timedelta(seconds=s + rng.choice([-1, 0, 0, 600, 1800, 7200, 90_000, 10**9]), microseconds=u % 3))
                for u, s in enumerate(rng.randrange(-1200, 400_000, 600) for _ in range(150))] + [(70, None, None, base), (71, "A", base, None)]
    df = spark.createDataFrame(rows, "row long, asset string, timestamp timestamp_ntz")
    asked = spark.createDataFrame(requests, "request_id long, asset string, start timestamp_ntz, end timestamp_ntz")
    totals = {"n": ("count", None), "ids": ("count", "row"), "low": ("min", "row"), "high": ("max", "row")}
    out = read_windows(df, asked, grain=grain, totals=totals)
    pairs = read_windows(df, asked, grain=grain).groupBy("request_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("row").alias("ids"), F.min("row").alias("low"), F.max("row").alias("high"))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, pairs.collect())) and pairs.count() > 30
    assert read_windows(df.limit(0), asked, totals=totals).count() == 0 and read_windows(df, asked.limit(0), totals=totals).count() == 0


def test_many_windows_query_forms_no_pairs(spark, tmp_path):
    """A thousand events at one time: a million pairs, none of which may come out of a join."""
    at = dt.datetime(2024, 1, 1)
    kinds = ["purchase", "view"]
    events = spark.createDataFrame([(k, at, 1, kinds[k % 2], 1.0, "") for k in range(1000)],
                                   "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    events.write.parquet(str(tmp_path / "events.parquet"))
    out = q_read_many_windows(spark, str(tmp_path))
    assert sorted(map(tuple, out.collect())) == [(k, 500, 1, 999) for k in range(0, 1000, 2)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan  # running totals; rows meet requests in no join
    assert not [j for j in plan.splitlines() if "Join " in j and "__at" in j]


def test_streaming_state_survives_a_restart(spark, tmp_path):
    hour = lambda k: dt.datetime(2025, 1, 1, k)
    files = [[("BTC", hour(1), 1.0, 5), ("BTC", hour(1), 9.0, 2)], [("BTC", hour(1), 3.0, 4), ("ETH", hour(2), 7.0, 1)],
             [("BTC", hour(1), None, 6), ("ETH", hour(3), 8.0, 3)], [("ETH", hour(2), 6.0, 0)]]
    schema = "asset string, timestamp timestamp_ntz, close double, seq long"
    land, out, check = (str(tmp_path / x) for x in ("land", "out", "check"))
    for k, file in enumerate(files):  # one run per file, always from the same checkpoint
        spark.createDataFrame(file, schema).coalesce(1).write.mode("append").parquet(land)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(land)
        run_updates(hourly_last(stream, ["asset", "timestamp"], ["seq"], ["close"]), out, check, partitions=2)
    got = {(r.asset, r.timestamp.hour): (r.close, r.seq) for r in latest_updates(spark, out, ["asset", "timestamp"]).collect()}
    assert got == {("BTC", 1): (None, 6), ("ETH", 2): (7.0, 1), ("ETH", 3): (8.0, 3)}
    batch = hourly_last(spark.read.schema(schema).parquet(land), ["asset", "timestamp"], ["seq"], ["close"])
    assert {(r.asset, r.timestamp.hour): (r.close, r.seq) for r in batch.collect()} == got


def test_first_seen_forgets_nothing_over_a_restart(spark, tmp_path):
    land, out, check = (str(tmp_path / x) for x in ("land", "out", "check"))
    for part in ([("BTC", "a"), ("BTC", "a"), ("ETH", "a")], [("BTC", "a"), ("BTC", None)], [("BTC", None), ("BTC", "b")]):
        spark.createDataFrame(part, "asset string, url string").coalesce(1).write.mode("append").parquet(land)
        stream = spark.readStream.schema("asset string, url string").parquet(land)
        run_updates(first_seen(stream, ["asset", "url"]), out, check, partitions=2)
    assert sorted(map(str, ((r.asset, r.url) for r in spark.read.parquet(out).collect()))) == \
        sorted(map(str, [("BTC", "a"), ("ETH", "a"), ("BTC", None), ("BTC", "b")]))
