"""Stream = batch: the same messages through the streaming jobs in several
micro-batches, with a restart from the checkpoint, give the batch answer."""

import json

import pytest
from pyspark.sql import functions as F

from hourglass.operators import decode, realtime
from hourglass.sources import messages as M
from hourglass.sources import testdata as td
from hourglass.streaming import ingest, speed
from tests.conftest import SF_SMALL


def deliver(spark, df, folder, order_col):
    """Append each range slice of ``df`` to ``folder`` as its own file (in order)."""
    staged = folder + "_staged"
    df.repartitionByRange(4, order_col).sortWithinPartitions(order_col).select("value") \
        .write.mode("overwrite").text(staged)
    files = sorted(spark.read.text(staged).inputFiles())
    return files


def test_speed_layer_equals_batch_with_restart(spark, workdir):
    lines = td.message_lines(spark, SF_SMALL, coarse=True)
    files = deliver(spark, lines, f"{workdir}/x", "id")
    queue = f"{workdir}/queue"
    for part in (files[:2], files[2:]):
        for f in part:
            spark.read.text(f).write.mode("append").text(queue)
        qs = speed.start_speed(M.text_source(spark, queue, max_files_per_trigger=1),
                               f"{workdir}/rt", f"{workdir}/ck", trigger={"availableNow": True})
        speed.await_all(qs)
    parsed = decode.parse_messages(lines, strict_urls=True)
    rows = decode.realtime_rows(parsed)
    want = {
        "pageviews": realtime.pageview_table(rows["pageviews"]),
        "pages": realtime.latest_per_key(rows["pages"], "pages"),
        "persons": realtime.latest_per_key(rows["persons"], "persons"),
        "equivs": realtime.latest_per_key(rows["equivs"], "equivs"),
    }
    for t, w in want.items():
        got = speed.read_realtime(spark, f"{workdir}/rt", t)
        # which person of a second stays depends on the batch it came in (speed_pageviews checks it)
        cols = sorted(set(w.columns) - ({"personid"} if t == "pageviews" else set()))
        assert sorted(got.select(*cols).collect()) == sorted(w.select(*cols).collect()), t


def test_last_write_wins_even_when_later_version_arrives_first(spark, workdir):
    older = json.dumps({"messagetype": "person", "pedigree": "100", "personid": "7",
                        "gendertype": "MALE", "fullname": "Old", "city": "a", "state": "b",
                        "country": "c"})
    newer = json.dumps({"messagetype": "person", "pedigree": "200", "personid": "7",
                        "gendertype": "MALE", "fullname": "New", "city": "a", "state": "b",
                        "country": "c"})
    queue = f"{workdir}/q"
    for doc in (newer, older):   # the later version is delivered first
        spark.createDataFrame([(doc,)], "value string").coalesce(1).write.mode("append").text(queue)
    qs = speed.start_speed(M.text_source(spark, queue, max_files_per_trigger=1), f"{workdir}/rt",
                           f"{workdir}/ck", trigger={"availableNow": True},
                           tables=("persons",))
    speed.await_all(qs)
    r = speed.read_realtime(spark, f"{workdir}/rt", "persons").collect()
    assert len(r) == 1 and r[0].fullname == "New" and r[0].pedigree == "200"


def test_late_pageviews_are_merged_not_dropped(spark, workdir):
    """Micro-batches are aggregated on their own and merged on read, so a
    message far older than what came before still counts."""
    def pv(secs, who):
        return json.dumps({"messagetype": "pageview", "pedigree": str(secs), "personid": who,
                           "pageid": "http://a.org/x"})
    queue = f"{workdir}/q"
    batches = [[pv(100_000, "1")], [pv(100_000 + 7200 * 30, "2")], [pv(100_000, "3")]]
    for b in batches:
        spark.createDataFrame([(d,) for d in b], "value string").coalesce(1) \
            .write.mode("append").text(queue)
    qs = speed.start_speed(M.text_source(spark, queue, max_files_per_trigger=1), f"{workdir}/rt",
                           f"{workdir}/ck", trigger={"availableNow": True},
                           tables=("pageviews",))
    speed.await_all(qs)
    assert len(qs["speed"].recentProgress) == 3
    got = {r.secs: (r.events, r.personid)
           for r in speed.read_realtime(spark, f"{workdir}/rt", "pageviews").collect()}
    # the late second-write of the first key adds up, and its person stays
    assert got[100_000] == (2, "3") and got[100_000 + 7200 * 30] == (1, "2")
    # no streaming state at all
    assert all(not p["stateOperators"] for p in qs["speed"].recentProgress)


def test_ingest_stream_equals_batch_decode(spark, workdir):
    lines = td.message_lines(spark, SF_SMALL)
    files = deliver(spark, lines, f"{workdir}/x", "id")
    queue = f"{workdir}/queue"
    for part in (files[:3], files[3:]):
        for f in part:
            spark.read.text(f).write.mode("append").text(queue)
        q = ingest.start_ingest(M.text_source(spark, queue, max_files_per_trigger=1),
                                f"{workdir}/new", f"{workdir}/ck", trigger={"availableNow": True})
        q.awaitTermination()
    from hourglass.operators import storage
    got = storage.read_new_facts(spark, f"{workdir}/new")
    want = decode.to_facts(decode.parse_messages(lines))
    # nonces depend on the line only, so whole rows compare equal
    assert sorted(got.collect()) == sorted(want.collect())
    gq = storage.read_quarantine(spark, f"{workdir}/new").groupBy("reason").count()
    wq = decode.to_quarantine(decode.parse_messages(lines)).groupBy("reason").count()
    assert sorted(gq.collect()) == sorted(wq.collect())
    assert F is not None


def test_realtime_compaction_and_expiry(spark, workdir):
    lines = td.message_lines(spark, SF_SMALL, kinds=("pageview",), coarse=True)
    files = deliver(spark, lines, f"{workdir}/x", "id")
    queue = f"{workdir}/queue"
    rt_root, snaps = f"{workdir}/rt", []
    for i, part in enumerate((files[:2], files[2:])):
        for f in part:
            spark.read.text(f).write.mode("append").text(queue)
        qs = speed.start_speed(M.text_source(spark, queue, max_files_per_trigger=1), rt_root,
                               f"{workdir}/ck", trigger={"availableNow": True},
                               tables=("pageviews",))
        speed.await_all(qs)
        if i == 0:   # compact after the first delivery; the second lands on top of it
            snaps.append(f"{workdir}/snap0")
            speed.compact_realtime(spark, rt_root, "pageviews", snaps[0])
    full = speed.read_realtime(spark, rt_root, "pageviews")
    via_snapshot = speed.read_realtime(spark, rt_root, "pageviews", snapshot_path=snaps[0])
    assert sorted(full.collect()) == sorted(via_snapshot.collect())
    cut = 473688
    speed.compact_realtime(spark, rt_root, "pageviews", f"{workdir}/snap1", previous_snapshot=snaps[0],
                           absorbed=full.where(F.col("hour_bucket") < cut))
    expired = speed.read_realtime(spark, rt_root, "pageviews", snapshot_path=f"{workdir}/snap1")
    assert sorted(expired.collect()) == sorted(full.where(F.col("hour_bucket") >= cut).collect())


def pageviews(spark, workdir, *secs_and_urls):
    docs = [json.dumps({"messagetype": "pageview", "pedigree": str(s), "personid": "1", "pageid": u})
            for s, u in secs_and_urls]
    spark.createDataFrame([(d,) for d in docs], "value string").coalesce(1).write.mode("append").text(f"{workdir}/q")
    speed.await_all(speed.start_speed(M.text_source(spark, f"{workdir}/q"), f"{workdir}/rt", f"{workdir}/ck",
                                      trigger={"availableNow": True}))


def view_of(spark, *rows):
    """A stored batch view of (url, hour) page views."""
    from hourglass import schemas as S
    lines = [(json.dumps({"messagetype": "pageview", "pedigree": str(h * 3600), "personid": "1", "pageid": u}),) for u, h in rows]
    facts = decode.to_facts(decode.parse_messages(spark.createDataFrame(lines, "value string")))
    assert S.PAGE_VIEW == 4
    return facts


def test_expiry_keeps_what_the_batch_has_not_counted(spark, workdir):
    """The view has URL A at an hour, realtime has URL B at the same hour."""
    from hourglass.operators import storage
    from hourglass.plans import jobs
    a, b = "http://a.org/", "http://b.org/"
    storage.rebuild_view(spark, f"{workdir}/view", view_of(spark, (a, 10)), ["r"])
    pageviews(spark, workdir, (36000, a), (36001, b), (36002, b))
    at = (f"{workdir}/view", f"{workdir}/rt")
    count = lambda snap: {r.url: r.pageviews for r in jobs.count_pageviews(
        spark, *at, [a, b], 0, 20, snapshot_path=snap).collect()}
    assert count(None) == {a: 1, b: 2}
    jobs.expire_realtime(spark, *at, f"{workdir}/s0")
    assert count(f"{workdir}/s0") == {a: 1, b: 2}


def test_an_empty_snapshot_still_knows_its_last_batch(spark, workdir):
    import pytest

    from hourglass.operators import storage
    from hourglass.plans import jobs
    a, at = "http://a.org/", (f"{workdir}/view", f"{workdir}/rt")
    storage.rebuild_view(spark, at[0], view_of(spark, (a, 10)), ["r"])
    pageviews(spark, workdir, (36000, a))
    assert jobs.expire_realtime(spark, *at, f"{workdir}/s0") == 0
    table = lambda snap: [(r.hour_bucket, r.events) for r in speed.read_realtime(
        spark, at[1], "pageviews", f"{snap}/pageviews").collect()]
    assert table(f"{workdir}/s0") == []
    pageviews(spark, workdir, (12 * 3600, a))
    assert table(f"{workdir}/s0") == [(12, 1)]
    assert jobs.expire_realtime(spark, *at, f"{workdir}/s1", f"{workdir}/s0") == 1
    assert table(f"{workdir}/s1") == [(12, 1)]
    # the folder that the first snapshot folded is gone, and reading without a snapshot says so
    assert speed.committed_batches(spark, at[1]) == [1]
    with pytest.raises(ValueError, match="folded and removed"):
        speed.read_realtime(spark, at[1], "pageviews")


def test_unfinished_batches_are_not_read_or_folded(spark, workdir):
    from hourglass.session import delete_folder
    a = "http://a.org/"
    pageviews(spark, workdir, (3600, a))
    pageviews(spark, workdir, (7200, a))
    delete_folder(spark, f"{workdir}/rt/batch_id=1/_SUCCESS")
    read = lambda snap=None: sorted(r.secs for r in speed.read_realtime(
        spark, f"{workdir}/rt", "pageviews", snap).collect())
    assert read() == [3600]
    assert speed.compact_realtime(spark, f"{workdir}/rt", "pageviews", f"{workdir}/s") == 0
    spark.range(1).write.parquet(f"{workdir}/mark")       # the batch's write finishes later
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{workdir}/rt/batch_id=1/_SUCCESS")
    p.getFileSystem(conf).create(p, True).close()
    assert read(f"{workdir}/s") == [3600, 7200] == read()


def test_quarantine_of_the_speed_layer(spark, workdir):
    pageviews(spark, workdir, (3600, "http://a.org/"), (3600, "bad url"), (3601, "bad url"), (10**12, "http://a.org/"))
    got = {r.reason: r.messages for r in speed.read_quarantine(spark, f"{workdir}/rt").groupBy("reason").agg(
        F.sum("messages").alias("messages")).collect()}
    assert got == {"bad_url": 2, "bad_pedigree": 1}


def test_old_entity_messages_after_new_pageviews_are_kept(spark, workdir):
    """Late-January pageviews arrive first; person, page and equiv messages
    with early-January pedigrees arrive afterwards and are all kept."""
    queue = f"{workdir}/q"
    pv = td.message_lines(spark, SF_SMALL, kinds=("pageview",))
    ent = td.message_lines(spark, SF_SMALL, kinds=("person", "page", "equiv"))
    for df in (pv, ent):
        df.select("value").coalesce(1).write.mode("append").text(queue)
    qs = speed.start_speed(M.text_source(spark, queue, max_files_per_trigger=1),
                           f"{workdir}/rt", f"{workdir}/ck", trigger={"availableNow": True})
    speed.await_all(qs)
    rows = decode.realtime_rows(decode.parse_messages(ent, strict_urls=True))
    for t in ("pages", "persons", "equivs"):
        want = realtime.latest_per_key(rows[t], t)
        got = speed.read_realtime(spark, f"{workdir}/rt", t)
        cols = sorted(want.columns)
        assert sorted(got.select(*cols).collect()) == sorted(want.select(*cols).collect()), t


def test_the_quarantine_outlives_expiry(spark, workdir):
    from hourglass.plans import jobs
    at = (f"{workdir}/view", f"{workdir}/rt")
    pageviews(spark, workdir, (3600, "http://a.org/"), (3600, "bad url"))
    jobs.expire_realtime(spark, *at, f"{workdir}/s0")
    jobs.expire_realtime(spark, *at, f"{workdir}/s1", f"{workdir}/s0")
    assert speed.committed_batches(spark, at[1]) == []
    with pytest.raises(ValueError, match="folded and removed"):
        speed.read_quarantine(spark, at[1])
    pageviews(spark, workdir, (3601, "bad url"))
    got = [(r.reason, r.messages) for r in speed.read_quarantine(spark, at[1], f"{workdir}/s1/quarantine").groupBy(
        "reason").agg(F.sum("messages").alias("messages")).collect()]
    assert got == [("bad_url", 2)]


def test_hour_bitmaps_count_distinct_seconds(spark):
    """Any seconds, before and after the epoch, in parts merged by OR."""
    secs = [0, 0, 1, -1, -3599, -3600, -3601, 3599, 3600, 7199, 7200, 7200, 2**31 - 1, -2**31]
    rows = spark.createDataFrame([("u", s, i % 2) for i, s in enumerate(secs * 2)], "url string, secs long, part int") \
        .selectExpr("url", "secs div 3600 AS hour_bucket", "secs", "part", "1L AS events")
    parts = [speed.hour_rows(rows.where(F.col("part") == k)) for k in (0, 1)]
    merged = speed._merge(parts[0].unionByName(parts[1]), speed.HOURS)
    got = {(r.hour_bucket, r.n, r.events) for r in merged.select(
        "hour_bucket", F.bitmap_count("seconds").alias("n"), "events").collect()}
    want = {}
    for x in secs * 2:
        want.setdefault(int(x / 3600), []).append(x)
    assert got == {(h, len(set(v)), len(v)) for h, v in want.items()}
    assert merged.agg(F.max(F.octet_length("seconds"))).first()[0] <= 900


def test_a_lookup_opens_one_bucket_of_each_batch(spark, workdir):
    from hourglass.operators import storage
    from hourglass.plans import inspect, jobs
    urls = [f"http://h{i}.org/" for i in range(40)]
    at = (f"{workdir}/view", f"{workdir}/rt")
    storage.rebuild_view(spark, at[0], view_of(spark, (urls[0], 1)), ["r"])
    pageviews(spark, workdir, *[(3600 + i, u) for i, u in enumerate(urls)])
    pageviews(spark, workdir, *[(9000 + i, u) for i, u in enumerate(urls)])
    batch = lambda keys: speed.read_realtime(spark, at[1], speed.HOURS, keys=keys)
    filters = " ".join(inspect.partition_filters(batch([urls[3]])))
    assert "bucket" in filters, filters
    rows = speed._read_batches(spark, at[1], [0, 1]).where("tbl = 'hours'")
    assert {r.n for r in rows.groupBy("batch_id").agg(F.count_distinct("bucket").alias("n")).collect()} == {speed.BUCKETS}
    # the plan's scan opens one file of each batch
    files = speed._with_keys(rows, "k1", [urls[3]])
    assert files.select(F.input_file_name()).distinct().count() == 2
    got = jobs.count_pageviews(spark, *at, [urls[3]], 0, 10).collect()
    assert [(r.url, r.pageviews) for r in got] == [(urls[3], 2)]
    assert "bucket" in " ".join(inspect.partition_filters(jobs.count_pageviews(spark, *at, [urls[3]], 0, 10)))
    # long lists and DataFrames give the same counts
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    assert {(r.url, r.pageviews) for r in jobs.count_pageviews(spark, *at, frame, 0, 10, broadcast_rows=0).collect()} \
        == {(r.url, r.pageviews) for r in jobs.count_pageviews(spark, *at, urls, 0, 10).collect()}
    assert jobs.count_pageviews(spark, *at, urls, 0, 10, mode="every_event").count() == 40


def test_adjacency_segments_stay_bounded(spark):
    """One person with 5,000 equivalents, another with none too many: segments hold all, in bounded rows."""
    hot = spark.range(5000).select(F.lit("p").alias("personid1"), F.col("id").cast("string").alias("personid2"),
                                   F.lit("9").alias("pedigree"))
    cold = spark.createDataFrame([("q", "b", "1"), ("q", "a", None), (None, "a", "3")],
                                 "personid1 string, personid2 string, pedigree string")
    rows = hot.unionByName(cold)
    for most in (1 << 20, 0):        # the persons with many equivalents broadcast, or joined by salts
        seg = realtime.adjacency_segments(rows, size=256, broadcast_rows=most)
        got = seg.select("personid1", F.size("neighbours").alias("n"), "neighbours").collect()
        assert max(r.n for r in got) <= 2 * 256 and sum(r.n for r in got) == 5003
        assert all(r.neighbours == sorted(r.neighbours, key=lambda x: x.personid2) for r in got)
        assert sorted(map(str, realtime.explode_segments(seg).collect())) == sorted(map(str, rows.collect()))
