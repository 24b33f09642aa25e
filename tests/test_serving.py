import pytest
from pyspark.sql import functions as F

from hourglass.operators import serving
from hourglass.plans import inspect

VIEW = [
    ("http://a.org/x", "h", 100, 5),
    ("http://a.org/x", "h", 102, 7),
    ("http://a.org/x", "h", 110, 1),     # outside the range
    ("http://a.org/x", "d", 4, 13),      # other granularities are ignored by the range sum
    ("http://b.org/", "h", 99, 3),
]
RT = [  # url, hour_bucket, secs, personid, events
    ("http://a.org/x", 102, 102 * 3600 + 1, "1", 1),   # covered by batch (hour_done = 102)
    ("http://a.org/x", 103, 103 * 3600 + 1, "1", 2),   # same second written twice
    ("http://a.org/x", 103, 103 * 3600 + 9, "2", 1),
    ("http://a.org/x", 106, 106 * 3600, "2", 1),       # after the range
    ("http://b.org/", 50, 50 * 3600, "3", 1),          # before the range
    ("http://b.org/", 101, 101 * 3600, "3", 1),
]


@pytest.fixture()
def tables(spark):
    v = spark.createDataFrame(VIEW, "url string, granularity string, bucket long, total_pageviews long")
    rt = spark.createDataFrame(RT, "url string, hour_bucket long, secs long, personid string, events long")
    return v, rt


def result(df):
    return {r.url: r.asDict() for r in df.collect()}


def test_count_merges_batch_and_realtime(spark, tables):
    v, rt = tables
    got = result(serving.count_pageviews(v, rt, ["http://a.org/x", "http://b.org/", "http://c.org/"],
                                         100, 105))
    a = got["http://a.org/x"]
    assert (a["batch_pageviews"], a["hour_done"], a["realtime_pageviews"], a["pageviews"]) == \
        (12, 102, 2, 14)
    b = got["http://b.org/"]   # no batch data in range: realtime from the start, not from hour 1
    assert (b["batch_pageviews"], b["hour_done"], b["realtime_pageviews"]) == (0, None, 1)
    assert got["http://c.org/"]["pageviews"] == 0


def test_every_event_mode_counts_writes(spark, tables):
    v, rt = tables
    got = result(serving.count_pageviews(v, rt, ["http://a.org/x"], 100, 105, mode="every_event"))
    assert got["http://a.org/x"]["realtime_pageviews"] == 3


def test_legacy_lower_bound_reads_from_hour_one(spark, tables):
    v, rt = tables
    got = result(serving.count_pageviews(v, rt, ["http://b.org/"], 100, 105,
                                         legacy_lower_bound=True))
    assert got["http://b.org/"]["realtime_pageviews"] == 2


def test_empty_range_and_query_normalization(spark, tables):
    v, rt = tables
    got = result(serving.count_pageviews(v, rt, ["HTTP://a.org:80/x?ref=1"], 105, 100))
    assert got["http://a.org/x"]["pageviews"] == 0
    got = result(serving.count_pageviews(v, rt, ["HTTP://a.org:80/x?ref=1"], 100, 105,
                                         normalize=False))
    assert got["HTTP://a.org:80/x?ref=1"]["pageviews"] == 0


def test_string_dates(spark, tables):
    v, rt = tables
    start = serving.query_hour(100)
    assert start == 100
    # 01.01.1970|00 is hour 0
    got = result(serving.count_pageviews(v, rt, ["http://b.org/"], "01.01.1970|00",
                                         "05.01.1970|05"))   # hours 0..101
    b = got["http://b.org/"]
    # batch hour 99 (3 views) -> realtime only after hour 99: the hour-101 row, not hour 50
    assert (b["batch_pageviews"], b["hour_done"], b["realtime_pageviews"]) == (3, 99, 1)


def test_get_pageviews_detail(spark, tables):
    v, rt = tables
    rows = serving.get_pageviews(v, rt, ["http://a.org/x"], 100, 105).collect()
    batch = sorted((r.hour_bucket, r.pageviews) for r in rows if r.source == "batch")
    real = sorted((r.hour_bucket, r.secs, r.pageviews) for r in rows if r.source == "realtime")
    assert batch == [(100, 5), (102, 7)]
    assert real == [(103, 103 * 3600 + 1, 1), (103, 103 * 3600 + 9, 1)]


def test_range_filter_reaches_the_scan(spark, tables, workdir):
    v, _ = tables
    v.write.partitionBy("granularity").parquet(f"{workdir}/view")
    stored = spark.read.parquet(f"{workdir}/view")
    q = serving.batch_range(stored, spark.createDataFrame([("http://a.org/x",)], "url string"),
                            100, 105)
    pushed = " ".join(inspect.pushed_filters(q))
    assert "GreaterThanOrEqual(bucket,100)" in pushed and "LessThanOrEqual(bucket,105)" in pushed
    assert any("granularity" in p for p in inspect.partition_filters(q))
    assert "BroadcastHashJoin" in inspect.plan_text(q) or "BroadcastExchange" in inspect.plan_text(q)
    assert F is not None


def test_point_lookup_pushes_url_into_scan(spark, tables, workdir):
    v, rt = tables
    v.write.partitionBy("granularity").parquet(f"{workdir}/view")
    stored = spark.read.parquet(f"{workdir}/view")
    q = serving.count_pageviews(stored, rt, ["http://a.org/x?x=1"], 100, 105)
    pushed = " ".join(inspect.pushed_filters(q))
    assert "EqualTo(url,http://a.org/x)" in pushed or "In(url, [http://a.org/x])" in pushed, pushed
    assert result(q)["http://a.org/x"]["pageviews"] == 14


def test_cover_is_exact_and_small():
    import random
    rnd = random.Random(7)
    sizes = {"h": 1, "d": 24, "w": 168, "m": 672}
    for _ in range(300):
        a = rnd.randrange(0, 20000)
        b = a + rnd.randrange(0, 20000)
        pieces = serving.cover(a, b)
        hours = []
        for g, lo, hi in pieces:
            s = sizes[g]
            hours.extend(range(lo * s, (hi + 1) * s))
        assert hours == list(range(a, b + 1))
        assert sum(hi - lo + 1 for _, lo, hi in pieces) <= (b - a + 1) // 672 + 2 * (3 + 6 + 23) + 1
    assert serving.cover(5, 4) == []


def test_coarse_cover_equals_hour_sum_on_stored_view(spark, workdir):
    from hourglass.operators import decode, storage, views
    import json
    docs = [json.dumps({"messagetype": "pageview", "pedigree": str(s), "personid": "1",
                        "pageid": f"http://u{s % 3}.org/"})
            for s in range(0, 3600 * 24 * 90, 3600 * 7 + 13)]
    facts = decode.to_facts(decode.parse_messages(
        spark.createDataFrame([(d,) for d in docs], "value string")))
    storage.write_view(views.batch_view(facts, with_last_hour=True), f"{workdir}/v")
    layout = storage.read_view(spark, f"{workdir}/v", keep_layout=True)
    plain = storage.read_view(spark, f"{workdir}/v")
    urls = spark.createDataFrame([("http://u0.org/",), ("http://u1.org/",), ("http://u2.org/",),
                                  ("http://none.org/",)], "url string")
    for a, b in [(0, 2159), (5, 1500), (700, 701), (30, 40), (100, 1400)]:
        got = sorted(serving.batch_range(layout, urls, a, b).collect())
        want = sorted(serving.batch_range(plain, urls, a, b).collect())
        assert got == want, (a, b)
    q = serving.batch_range(layout, urls, 5, 1500)
    pushed = " ".join(inspect.pushed_filters(q)) + " ".join(inspect.partition_filters(q))
    assert "granularity" in pushed and "period" in pushed


def test_salted_shuffle_path_equals_broadcast_path(spark, tables):
    v, rt = tables
    urls = spark.createDataFrame([("http://a.org/x",), ("http://b.org/",), ("http://c.org/",)],
                                 "url string")
    want = sorted(serving.count_pageviews(v, rt, urls, 100, 105).collect())
    want_ev = sorted(serving.count_pageviews(v, rt, urls, 100, 105, mode="every_event").collect())
    want_rows = sorted(serving.get_pageviews(v, rt, urls, 100, 105).collect())
    q = serving.count_pageviews(v, rt, urls, 100, 105, broadcast_rows=0)   # shuffle path
    assert "_salt" in inspect.plan_text(q, "extended")
    assert sorted(q.collect()) == want
    assert sorted(serving.count_pageviews(v, rt, urls, 100, 105, mode="every_event",
                                          broadcast_rows=0).collect()) == want_ev
    assert sorted(serving.get_pageviews(v, rt, urls, 100, 105,
                                        broadcast_rows=0).collect()) == want_rows


def test_hour_ranges_are_numeric_not_string_ordered(spark):
    # as strings "h-9" > "h-10"; the range 9..10 must still include both hours
    v = spark.createDataFrame([("http://a.org/", "h", 9, 1), ("http://a.org/", "h", 10, 2)],
                              "url string, granularity string, bucket long, total_pageviews long")
    rt = spark.createDataFrame([("http://a.org/", 11, 11 * 3600, "1", 1)],
                               "url string, hour_bucket long, secs long, personid string, events long")
    got = result(serving.count_pageviews(v, rt, ["http://a.org/"], 9, 11))["http://a.org/"]
    assert (got["batch_pageviews"], got["hour_done"], got["realtime_pageviews"]) == (3, 10, 1)


def test_counts_beyond_32_bits(spark):
    from hourglass.operators import views
    big = 5_000_000_000
    v = spark.createDataFrame([("http://a.org/", "h", 9, big)],
                              "url string, granularity string, bucket long, total_pageviews long")
    rt = spark.createDataFrame([], "url string, hour_bucket long, secs long")
    assert result(serving.count_pageviews(v, rt, ["http://a.org/"], 0, 20))[
        "http://a.org/"]["pageviews"] == big
    back = views.from_key_value(views.to_key_value(v)).first()
    assert back.total_pageviews == big


def test_salting_spreads_a_hot_url_over_tasks(spark):
    from hourglass.operators.joins import salted_range_join
    hot = [("http://hot.org/", 100, 100 * 3600 + i) for i in range(900)]
    cold = [(f"http://c{i}.org/", 100, 100 * 3600 + i) for i in range(100)]
    rt = spark.createDataFrame(hot + cold, "url string, hour_bucket long, secs long")
    bounds = spark.createDataFrame([(u, 99, 101) for u in ["http://hot.org/"] +
                                    [f"http://c{i}.org/" for i in range(100)]],
                                   "url string, lo long, hi long")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = salted_range_join(rt, bounds, "url", "hour_bucket", "lo", "hi", salt_of="secs",
                              salts=16)
        parts = (j.where(F.col("url") == "http://hot.org/")
                 .select(F.spark_partition_id().alias("p")).distinct().count())
        assert parts > 1                      # the hot URL is split over several tasks
        assert j.count() == 1000              # and nothing is lost or duplicated
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("listed", [True, False])
def test_each_view_is_read_once(spark, workdir, listed):
    """Executed plans of both queries: one scan of the stored view, one of the realtime table."""
    from hourglass.operators import storage
    rows = [(f"http://p{i % 3}.org/a", 473352 + i) for i in range(60)]
    view = spark.createDataFrame([(u, "h", h, 2, h) for u, h in rows],
                                 "url string, granularity string, bucket long, total_pageviews long, last_hour long")
    storage.write_view(view, f"{workdir}/view")
    spark.createDataFrame([(u, h + 30, (h + 30) * 3600) for u, h in rows], "url string, hour_bucket long, secs long") \
        .write.parquet(f"{workdir}/realtime")
    v = storage.read_view(spark, f"{workdir}/view", keep_layout=True)
    rt = spark.read.parquet(f"{workdir}/realtime")
    urls = [u for u, _ in rows[:3]]
    asked = urls if listed else spark.createDataFrame([(u,) for u in urls], "url string")
    for fn in (serving.count_pageviews, serving.get_pageviews):
        df = fn(v, rt, asked, 473360, 473450)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
        assert sum("/view]" in s for s in scans) == 1, plan
        assert sum("/realtime]" in s for s in scans) == 1, plan
