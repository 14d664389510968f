import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import CHART, CHART_EMPTY, GLOBAL, NEWS, NEWS_EMPTY, env_line, write_lines
from tidemark.functions.nested import vote_counts
from tidemark.sources import shred
from tidemark.sources.landing import quarantine_rows, read_landing

T0 = "2024-04-21T00:10:00Z"


def landed(spark, tmp_path, *lines):
    return read_landing(spark, write_lines(str(tmp_path / "landing"), list(lines)))


def test_chart_one_point(spark, tmp_path):
    df = shred.shred_chart(shred.classify_chart(landed(spark, tmp_path, env_line("BTC", T0, 1, CHART))))
    r = df.collect()
    assert len(r) == 1
    r = r[0]
    assert (r.asset, r.close, r.market_cap, r.volume, r.source) == ("BTC", 17.25, 3400.5, 81.75, "coingecko")
    assert r.timestamp == dt.datetime(2024, 4, 20, 23, 0)


def test_chart_empty_gives_no_rows_and_no_quarantine(spark, tmp_path):
    c = shred.classify_chart(landed(spark, tmp_path, env_line("BTC", T0, 1, CHART_EMPTY)))
    assert shred.shred_chart(c).count() == 0
    assert quarantine_rows(c, "price").count() == 0


def test_chart_ragged_tail_is_null_and_extra_points_dropped(spark, tmp_path):
    p = {"prices": [[1704067200000, 1.0], [1704070800000, 2.0], [1704074400000, 3.0]],
         "market_caps": [[1704067200000, 10.0]],
         "total_volumes": [[1, 100.0], [2, 200.0], [3, 300.0], [4, 400.0]]}
    df = shred.shred_chart(shred.classify_chart(landed(spark, tmp_path, env_line("ETH", T0, 1, p))))
    got = sorted((r.seq, r.close, r.market_cap, r.volume) for r in df.collect())
    assert got == [(0, 1.0, 10.0, 100.0), (1, 2.0, None, 200.0), (2, 3.0, None, 300.0)]


def test_chart_null_in_used_pair_quarantines_that_payload_only(spark, tmp_path):
    bad = {"prices": [[1704067200000, None]], "market_caps": [], "total_volumes": []}
    bad_cap = {"prices": [[1704067200000, 1.0]], "market_caps": [[1704067200000, None]], "total_volumes": []}
    unused_null = {"prices": [[1704067200000, 1.0]], "market_caps": [[1, 2.0], [2, None]], "total_volumes": []}
    c = shred.classify_chart(landed(spark, tmp_path, env_line("BTC", T0, 1, bad),
                                    env_line("ETH", T0, 1, bad_cap), env_line("SOL", T0, 1, CHART),
                                    env_line("XRP", T0, 1, unused_null)))
    assert sorted((r.asset, r.reason) for r in quarantine_rows(c, "price").collect()) == \
        [("BTC", "invalid_values"), ("ETH", "invalid_values")]
    assert sorted(r.asset for r in shred.shred_chart(c).collect()) == ["SOL", "XRP"]


def test_corrupt_line_isolated_good_lines_kept(spark, tmp_path):
    c = shred.classify_chart(landed(spark, tmp_path, env_line("BTC", T0, 1, CHART), "{not json at all",
                                    env_line("ETH", T0, 1, '{"prices": [[1, 2.0]'),
                                    env_line("SOL", T0, 1, {"prices": "oops"})))
    reasons = sorted(str(r.reason) for r in c.collect())
    assert reasons == ["None", "corrupt_envelope", "corrupt_envelope", "unparseable_payload"]
    assert [r.asset for r in shred.shred_chart(c).collect()] == ["BTC"]


def test_global_snapshot_time_is_ingest_hour(spark, tmp_path):
    c = shred.classify_global(landed(spark, tmp_path, env_line(None, "2024-01-01T03:47:12Z", 7, GLOBAL)))
    r = shred.shred_global(c).first()
    assert (r.btc_dominance, r.total_market_cap_usd, r.total_volume_usd, r.source) == (41.5, 7000.25, 333.5, "coingecko")
    assert r.timestamp == dt.datetime(2024, 1, 1, 3, 0)


def test_global_missing_btc_quarantined_missing_total_accepted(spark, tmp_path):
    no_btc = {"data": {"market_cap_percentage": {"eth": 1.0}, "total_market_cap": {"usd": 1.0}}}
    no_total = {"data": {"market_cap_percentage": {"btc": 50.0}}}
    c = shred.classify_global(landed(spark, tmp_path, env_line(None, T0, 1, no_btc), env_line(None, T0, 2, no_total)))
    assert [r.reason for r in quarantine_rows(c, "market").collect()] == ["invalid_values"]
    r = shred.shred_global(c).first()
    assert (r.btc_dominance, r.total_market_cap_usd, r.total_volume_usd) == (50.0, None, None)


def test_news_one_article(spark, tmp_path):
    r = shred.shred_news(shred.classify_news(landed(spark, tmp_path, env_line("BTC", T0, 1, NEWS)))).collect()
    assert len(r) == 1
    r = r[0]
    assert (r.asset, r.headline, r.url, r.votes_positive, r.votes_negative, r.source) == \
        ("BTC", "Harbour lights dim early", "https://paper.test/harbour", 0, 0, "cryptocompare")
    assert r.published_at == dt.datetime(2024, 4, 20, 23, 33)


def test_news_empty_list_and_empty_title(spark, tmp_path):
    p = {"Data": [{"TITLE": "", "URL": "u1", "PUBLISHED_ON": 1}, {"URL": "u2", "PUBLISHED_ON": 1},
                  {"TITLE": "  ", "URL": "u3", "PUBLISHED_ON": 1}]}
    df = shred.shred_news(shred.classify_news(landed(spark, tmp_path, env_line("BTC", T0, 1, NEWS_EMPTY),
                                                     env_line("ETH", T0, 1, p))))
    assert [(r.asset, r.url) for r in df.collect()] == [("ETH", "u3")]


def test_news_url_absent_vs_null_and_time_fallbacks(spark, tmp_path):
    p = {"Data": [{"TITLE": "a", "PUBLISHED_ON": 1713654000},
                  {"TITLE": "b", "URL": None, "PUBLISHED_ON": 1713654000},
                  {"TITLE": "c", "URL": "u"},
                  {"TITLE": "d", "URL": "v", "PUBLISHED_ON": "yesterday"},
                  {"TITLE": "e", "URL": "w", "PUBLISHED_ON": None}]}
    df = shred.shred_news(shred.classify_news(landed(spark, tmp_path, env_line("BTC", "2024-05-01T10:30:00Z", 1, p))))
    got = {r.headline: (r.url, r.published_at) for r in df.collect()}
    assert got["a"][0] == "" and got["b"][0] is None
    assert got["c"][1] == dt.datetime(1970, 1, 1)
    assert got["d"][1] == dt.datetime(2024, 5, 1, 10, 30) == got["e"][1]


def test_vote_counts(spark):
    df = spark.createDataFrame([({"UPVOTES": "3", "DOWNVOTES": None},), (None,), ({},)],
                               "v map<string,string>")
    got = [tuple(r.vc) for r in df.select(vote_counts("v").alias("vc")).collect()]
    assert got == [(3, 0), (0, 0), (0, 0)]


def test_epoch_helpers(spark):
    from tidemark.functions.timefn import epoch_millis_to_ts, epoch_seconds_to_ts, iso_utc_text
    df = spark.range(1).select(epoch_millis_to_ts(F.lit(1704067200000)).alias("a"),
                               epoch_seconds_to_ts(F.lit(1713654000)).alias("b"))
    r = df.select("a", "b", iso_utc_text("b").alias("s")).first()
    assert r.a == dt.datetime(2024, 1, 1) and r.b == dt.datetime(2024, 4, 20, 23, 0)
    assert r.s == "2024-04-20T23:00:00+00:00"


def test_nested_landing_folders_read_in_one_scan(spark, tmp_path):
    root = tmp_path / "nested"
    write_lines(str(root / "dt=2024-04-20" / "h=23"), [env_line("BTC", T0, 1, CHART)])
    write_lines(str(root / "dt=2024-04-21" / "h=00"), [env_line("ETH", T0, 2, CHART)])
    df = read_landing(spark, str(root), recursive=True, glob="*.json")
    assert sorted(r.asset for r in df.collect()) == ["BTC", "ETH"]


def test_explicit_null_arrays_count_as_missing(spark, tmp_path):
    p = {"prices": [[1704067200000, 1.0]], "market_caps": None, "total_volumes": None}
    empty = {"prices": None}
    c = shred.classify_chart(landed(spark, tmp_path, env_line("BTC", T0, 1, p), env_line("ETH", T0, 1, empty)))
    assert quarantine_rows(c, "price").count() == 0
    got = [(r.asset, r.close, r.market_cap, r.volume) for r in shred.shred_chart(c).collect()]
    assert got == [("BTC", 1.0, None, None)]


def test_absurd_epochs_never_fail_the_job(spark, tmp_path):
    huge_chart = {"prices": [[1e20, 1.0]], "market_caps": [], "total_volumes": []}
    arts = {"Data": [{"TITLE": "far", "URL": "u1", "PUBLISHED_ON": 1e20},
                     {"TITLE": "ok", "URL": "u2", "PUBLISHED_ON": 1713654000}]}
    c = shred.classify_chart(landed(spark, tmp_path, env_line("BTC", T0, 1, huge_chart), env_line("ETH", T0, 1, CHART)))
    assert [(r.asset, r.reason) for r in quarantine_rows(c, "price").collect()] == [("BTC", "invalid_values")]
    assert [r.asset for r in shred.shred_chart(c).collect()] == ["ETH"]
    n = shred.shred_news(shred.classify_news(landed(spark, tmp_path / "n", env_line("SOL", "2024-05-01T10:30:00Z", 1, arts))))
    got = {r.headline: r.published_at for r in n.collect()}
    assert got["far"] == dt.datetime(2024, 5, 1, 10, 30) and got["ok"] == dt.datetime(2024, 4, 20, 23, 0)
