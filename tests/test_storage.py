import json

import pytest
from pyspark.sql import functions as F

from hourglass import schemas as S
from hourglass.operators import decode, master, storage, views
from hourglass.sources import facts as FS
from hourglass.sources import messages as M
from hourglass.streaming import ingest


def sample_lines(spark, n=30):
    docs = []
    for i in range(n):
        docs.append(json.dumps({"messagetype": "pageview", "pedigree": str(1704067200 + i * 600),
                                "personid": str(i % 4), "pageid": f"http://p{i % 3}.org/a?i={i}"}))
    docs.append(json.dumps({"messagetype": "page", "pedigree": "1704067200",
                            "url": "http://p0.org/a", "pageview": "3"}))
    docs.append(json.dumps({"messagetype": "equiv", "pedigree": "1704067200",
                            "personid1": "1", "personid2": "cookie_1"}))
    docs.append("junk")
    return spark.createDataFrame([(d,) for d in docs], "value string")


def test_partition_validity(spark):
    facts = decode.to_facts(decode.parse_messages(sample_lines(spark)))
    assert FS.invalid_partitions(facts).count() == 0
    assert FS.invalid_facts(facts).count() == 0
    broken = facts.withColumn("value_id", F.lit(7))
    assert FS.invalid_partitions(broken).count() == 3
    no_nonce = facts.withColumn("page_view", F.col("page_view").withField("nonce", F.lit(None)))
    probs = {r.problem for r in FS.invalid_facts(no_nonce).collect()}
    assert probs == {"bad_page_view"}
    moved = facts.where("dataunit_id = 3").withColumn("dataunit_id", F.lit(4))
    assert {r.problem for r in FS.invalid_facts(moved).collect()} == {"branch_mismatch"}


def test_ingest_absorb_exactly_once_and_compaction(spark, workdir):
    lines = sample_lines(spark)
    M.write_lines(lines, f"{workdir}/in", 3)
    src = M.text_source(spark, f"{workdir}/in", max_files_per_trigger=1)
    q = ingest.start_ingest(src, f"{workdir}/new", f"{workdir}/ck_i", trigger={"availableNow": True})
    q.awaitTermination()
    assert storage.read_quarantine(spark, f"{workdir}/new").count() == 1
    master.absorb(spark, f"{workdir}/new", f"{workdir}/master", f"{workdir}/ck_a", "r1")
    # a second run with nothing new appends nothing
    master.absorb(spark, f"{workdir}/new", f"{workdir}/master", f"{workdir}/ck_a", "r2")
    found = master.read_master(spark, f"{workdir}/master")
    assert found.count() == 32
    # more input arrives: only it is absorbed (bag semantics: duplicates kept)
    M.write_lines(lines.limit(5), f"{workdir}/in2", 1)
    spark.read.text(f"{workdir}/in2").write.mode("append").text(f"{workdir}/in")
    q = ingest.start_ingest(M.text_source(spark, f"{workdir}/in"), f"{workdir}/new",
                            f"{workdir}/ck_i", trigger={"availableNow": True})
    q.awaitTermination()
    master.absorb(spark, f"{workdir}/new", f"{workdir}/master", f"{workdir}/ck_a", "r3")
    found = master.read_master(spark, f"{workdir}/master")
    assert found.count() == 37
    FS.write_facts(found, f"{workdir}/plain")
    storage.compact(spark, f"{workdir}/plain", f"{workdir}/plain2")
    m2 = FS.read_facts(spark, f"{workdir}/plain2")
    assert sorted(FS.partition_counts(m2).collect()) == sorted(FS.partition_counts(found).collect())


def test_view_sinks_round_trip(spark, workdir):
    facts = decode.to_facts(decode.parse_messages(sample_lines(spark)))
    v = views.batch_view(facts)
    storage.write_view(views.batch_view(facts, with_last_hour=True), f"{workdir}/view")
    storage.write_view_kv(v, f"{workdir}/kv", shards=4)
    storage.write_view_sharded(v, "hg_test_view", f"{workdir}/tbl", shards=4)
    want = sorted(v.collect())
    assert sorted(storage.read_view(spark, f"{workdir}/view").collect()) == want
    assert sorted(views.from_key_value(storage.read_view_kv(spark, f"{workdir}/kv")).collect()) == want
    assert sorted(spark.table("hg_test_view").select(*S.BATCH_VIEW.fieldNames()).collect()) == want
    # url-only sharding: every URL lives in exactly one kv file
    kv = storage.read_view_kv(spark, f"{workdir}/kv").select(
        views.key_url("key").alias("u"), F.input_file_name().alias("f"))
    assert kv.groupBy("u").agg(F.count_distinct("f").alias("n")).where("n > 1").count() == 0
    # full-key sharding keeps every row, in at most 4 files
    storage.write_view_kv(v, f"{workdir}/kv_key", shards=4, by="key")
    kk = storage.read_view_kv(spark, f"{workdir}/kv_key")
    assert sorted(views.from_key_value(kk).collect()) == want
    assert len(kk.inputFiles()) <= 4


def test_incremental_job_equals_full_rebuild(spark, workdir):
    from hourglass.plans import jobs
    lines = sample_lines(spark)
    M.write_lines(lines, f"{workdir}/in", 2)
    q = ingest.start_ingest(M.text_source(spark, f"{workdir}/in"), f"{workdir}/new",
                            f"{workdir}/ck_i", trigger={"availableNow": True})
    q.awaitTermination()
    # first run: absorb everything so far and build the view
    jobs.run_batch(spark, f"{workdir}/new", f"{workdir}/master", f"{workdir}/view",
                   f"{workdir}/ck")
    # a second delivery (the same lines again: bag semantics, counts double)
    spark.read.text(f"{workdir}/in").write.mode("append").text(f"{workdir}/more")
    spark.read.text(f"{workdir}/more").write.mode("append").text(f"{workdir}/in")
    q = ingest.start_ingest(M.text_source(spark, f"{workdir}/in"), f"{workdir}/new",
                            f"{workdir}/ck_i", trigger={"availableNow": True})
    q.awaitTermination()
    touched = jobs.run_incremental(spark, f"{workdir}/new", f"{workdir}/master",
                                   f"{workdir}/view", f"{workdir}/ck", run_id="r2")
    assert touched
    full = views.batch_view(master.read_master(spark, f"{workdir}/master", 4))
    got = storage.read_current_view(spark, f"{workdir}/view")
    assert master.read_master(spark, f"{workdir}/master").count() == 64
    # the refresh added only the second delivery, so the refreshed view equals a
    # rebuild from the whole master
    assert sorted(got.collect()) == sorted(full.collect())


def month_total(spark, view):
    return storage.read_current_view(spark, view).where("granularity = 'm'") \
        .agg(F.sum("total_pageviews")).first()[0]


def deliver(spark, workdir, n, name):
    """Ingest n page views of one more delivery."""
    docs = [json.dumps({"messagetype": "pageview", "pedigree": str(1704067200 + i), "personid": "1",
                        "pageid": f"http://{name}.org/"}) for i in range(n)]
    spark.createDataFrame([(d,) for d in docs], "value string").coalesce(1).write.mode("append").text(f"{workdir}/in")
    ingest.start_ingest(M.text_source(spark, f"{workdir}/in"), f"{workdir}/new", f"{workdir}/ck_i",
                        trigger={"availableNow": True}).awaitTermination()


def test_batch_runs_count_every_delivery_once(spark, workdir):
    """Data that arrives during a run is left to the next; finished run ids change
    nothing; a given-up run's facts are counted by the next run."""
    from hourglass.plans import jobs
    at = (f"{workdir}/new", f"{workdir}/master", f"{workdir}/view", f"{workdir}/ck")
    deliver(spark, workdir, 1, "a")
    jobs.run_batch(spark, *at)
    deliver(spark, workdir, 1, "b")      # arrives after the only absorb of that run
    jobs.run_incremental(spark, *at, run_id="r1")
    assert month_total(spark, at[2]) == 2 == master.read_master(spark, at[1]).count()
    deliver(spark, workdir, 1, "c")
    jobs.run_incremental(spark, *at, run_id="r2")
    assert jobs.run_incremental(spark, *at, run_id="r1") == [] and month_total(spark, at[2]) == 3
    deliver(spark, workdir, 2, "d")
    master.absorb(spark, at[0], at[1], f"{workdir}/ck/absorb", "lost")   # then its driver dies
    assert month_total(spark, at[2]) == 3
    assert jobs.run_incremental(spark, *at, run_id="r3") and month_total(spark, at[2]) == 5


def test_compaction_composes_with_absorb(spark, workdir):
    from hourglass.plans import jobs
    at = (f"{workdir}/new", f"{workdir}/master", f"{workdir}/view", f"{workdir}/ck")
    for k in range(4):
        deliver(spark, workdir, 3, f"h{k}")
        jobs.run_incremental(spark, *at, run_id=f"r{k}", compact_every=2)
    assert master.packed_runs(spark, at[1]) == {1: ["r0", "r1"]}
    assert master.read_master(spark, at[1]).count() == 12 and month_total(spark, at[2]) == 12
    assert master.compact_master(spark, at[1]) == ["r2", "r3"] and master.compact_master(spark, at[1]) == []
    assert master.read_master(spark, at[1], S.PAGE_VIEW).count() == 12
    packed = spark.read.schema(S.FACTS).parquet(f"{at[1]}/packed/generation=2").inputFiles()
    assert len(packed) == 1
    jobs.run_batch(spark, *at, run_id="full")
    assert month_total(spark, at[2]) == 12


def test_readers_keep_a_whole_view_during_a_rebuild(spark, workdir):
    facts = decode.to_facts(decode.parse_messages(sample_lines(spark)))
    root = f"{workdir}/view"
    storage.rebuild_view(spark, root, facts, ["a"])
    before = storage.read_current_view(spark, root)
    # a rebuild that dies after writing leaves no trace for readers
    storage.write_view(views.batch_view(facts.limit(3), with_last_hour=True), f"{root}/generation=2")
    assert sorted(storage.read_current_view(spark, root).collect()) == sorted(views.batch_view(facts).collect())
    storage.rebuild_view(spark, root, facts.unionAll(facts), ["a", "b"])
    n = views.batch_view(facts).agg(F.sum("total_pageviews")).first()[0]
    assert before.agg(F.sum("total_pageviews")).first()[0] == n      # its files are still there
    assert storage.read_current_view(spark, root).agg(F.sum("total_pageviews")).first()[0] == 2 * n
    storage.rebuild_view(spark, root, facts, ["a", "b", "c"])
    assert not storage.path_exists(spark, f"{root}/generation=1")


def test_refresh_touches_only_new_periods(spark, workdir):
    facts = decode.to_facts(decode.parse_messages(sample_lines(spark, n=60)))
    late = facts.withColumn("true_as_of_secs", F.col("true_as_of_secs") + 40 * 86400)
    root = f"{workdir}/view"
    storage.rebuild_view(spark, root, facts, ["a"])
    touched = storage.refresh_current_view(spark, root, late, ["b"])
    assert {g for g, _ in touched} == {"h", "d", "w", "m"}
    now = storage.current_view(spark, root)
    assert sorted(now["runs"]) == ["a", "b"] and set(now["partitions"].values()) == {1, 2}
    assert {p for p, g in now["partitions"].items() if g == 2} == {f"granularity={g}/period={p}" for g, p in touched}
    got = storage.read_current_view(spark, root)
    assert sorted(got.collect()) == sorted(views.batch_view(facts.unionAll(late)).collect())


def test_period_pruning_in_serving(spark, workdir):
    from hourglass.operators import serving
    from hourglass.plans import inspect
    facts = decode.to_facts(decode.parse_messages(sample_lines(spark)))
    storage.write_view(views.batch_view(facts, with_last_hour=True), f"{workdir}/view")
    v = storage.read_view(spark, f"{workdir}/view", keep_layout=True)
    rt = spark.createDataFrame([], "url string, hour_bucket long, secs long")
    q = serving.count_pageviews(v, rt, ["http://p0.org/a"], 473352, 473360)
    pf = " ".join(inspect.partition_filters(q))
    assert "period" in pf and "granularity" in pf, pf
    # 30 views, 10 minutes apart from hour 473352, every third one on p0
    assert {r.url: r.pageviews for r in q.collect()}["http://p0.org/a"] == 10
    full = serving.count_pageviews(storage.read_view(spark, f"{workdir}/view"), rt,
                                   ["http://p0.org/a"], 473352, 473360)
    assert full.collect() == q.collect()


def test_view_period_truncates_like_buckets(spark):
    from hourglass.functions import view_period
    df = spark.createDataFrame([("h", 671), ("h", 672), ("h", -1), ("d", 27), ("d", 28),
                                ("w", 3), ("w", 4), ("m", 9)], "g string, b long")
    got = [r[0] for r in df.select(view_period("g", "b")).collect()]
    assert got == [0, 1, 0, 0, 1, 0, 1, 9]


def test_bucketed_views_join_on_url_without_shuffle(spark, workdir):
    from hourglass.plans import inspect
    facts = decode.to_facts(decode.parse_messages(sample_lines(spark)))
    v = views.batch_view(facts)
    storage.write_view_sharded(v, "hg_join_a", f"{workdir}/a", shards=4)
    storage.write_view_sharded(v.where("granularity = 'h'"), "hg_join_b", f"{workdir}/b", shards=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("hg_join_a").alias("a").join(spark.table("hg_join_b").alias("b"), "url")
        assert inspect.count_nodes(j, "Exchange") == 0
        assert j.count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_jobs_before_any_data_are_no_ops(spark, workdir):
    from hourglass.plans import jobs
    assert master.absorb(spark, f"{workdir}/none", f"{workdir}/master", f"{workdir}/ck", "r") == 0
    assert jobs.run_batch(spark, f"{workdir}/none", f"{workdir}/master", f"{workdir}/view",
                          f"{workdir}/ckb") is None
    assert jobs.run_incremental(spark, f"{workdir}/none", f"{workdir}/master", f"{workdir}/view",
                                f"{workdir}/ckb", run_id="r1") == []


def test_run_ids_are_never_issued_twice(spark, workdir):
    """All live folders are compacted and dropped; the next run gets a new id and its facts count."""
    from hourglass.plans import jobs
    at = (f"{workdir}/new", f"{workdir}/master", f"{workdir}/view", f"{workdir}/ck")
    deliver(spark, workdir, 5, "a")
    jobs.run_batch(spark, *at)
    master.compact_master(spark, at[1])
    assert master.drop_compacted(spark, at[1]) == 1 and storage.list_names(spark, f"{at[1]}/live") == []
    deliver(spark, workdir, 3, "b")
    jobs.run_batch(spark, *at)
    assert month_total(spark, at[2]) == 8 and master.runs(spark, at[1]) == ["run-00000001", "run-00000002"]
    with pytest.raises(ValueError, match="compacted"):
        master.absorb(spark, at[0], at[1], f"{workdir}/ck/absorb", "run-00000001")


def test_a_repeated_micro_batch_is_not_absorbed_twice(spark, workdir):
    """The driver dies after a batch's mark and before the checkpoint's commit; another
    run, even after a compaction, repeats the batch."""
    from hourglass.session import delete_folder
    at = (f"{workdir}/new", f"{workdir}/master", f"{workdir}/ck")
    deliver(spark, workdir, 4, "a")
    master.absorb(spark, *at, "r0")
    master.compact_master(spark, at[1])
    master.drop_compacted(spark, at[1])
    for name in ("0", ".0.crc"):
        delete_folder(spark, f"{workdir}/ck/commits/{name}")
    assert master.absorb(spark, *at, "r1") == 1
    assert master.read_master(spark, at[1]).count() == 4
    # dying before the mark instead: the batch is written anew
    deliver(spark, workdir, 2, "b")
    master.absorb(spark, *at, "r2")
    mark = [n for n in storage.list_names(spark, f"{at[1]}/_absorbed") if n.endswith("@r2.json")]
    delete_folder(spark, f"{at[1]}/_absorbed/{mark[0]}")
    for name in ("1", ".1.crc"):
        delete_folder(spark, f"{workdir}/ck/commits/{name}")
    master.absorb(spark, *at, "r3")
    assert master.read_master(spark, at[1]).count() == 6
    assert master.absorbed_counts(spark, at[1]) == {"r3": {"facts": 2, "rejected": 0}}


def test_uncounted_runs_are_counted_after_their_compaction(spark, workdir):
    from hourglass.plans import jobs
    at = (f"{workdir}/new", f"{workdir}/master", f"{workdir}/view", f"{workdir}/ck")
    deliver(spark, workdir, 1, "a")
    jobs.run_incremental(spark, *at, run_id="r0")
    deliver(spark, workdir, 2, "b")
    master.absorb(spark, at[0], at[1], f"{workdir}/ck/absorb", "r1")      # killed here
    master.compact_master(spark, at[1])
    deliver(spark, workdir, 4, "c")
    jobs.run_incremental(spark, *at, run_id="r1")          # counts what r1 absorbed; newer data waits
    assert month_total(spark, at[2]) == 3
    jobs.run_incremental(spark, *at, run_id="r2")
    assert month_total(spark, at[2]) == 7


def test_consumed_new_data_is_dropped(spark, workdir):
    from hourglass.plans import jobs
    at = (f"{workdir}/new", f"{workdir}/master", f"{workdir}/view", f"{workdir}/ck")
    M.write_lines(sample_lines(spark), f"{workdir}/in", 2)
    deliver(spark, workdir, 3, "a")
    jobs.run_incremental(spark, *at, run_id="r0", drop_consumed=True)
    assert storage.read_new_facts(spark, at[0]).count() == 0
    assert storage.read_quarantine(spark, at[0]).count() == 1       # kept for its readers
    deliver(spark, workdir, 2, "b")
    assert storage.read_new_facts(spark, at[0]).count() == 2
    jobs.run_incremental(spark, *at, run_id="r1", drop_consumed=True)
    assert master.read_master(spark, at[1]).count() == 37 and month_total(spark, at[2]) == 35


def test_writers_follow_the_bytes_of_a_micro_batch(spark, workdir):
    """Ten times the input is about ten times the files, of one kind as well."""
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.files.maxPartitionBytes": "32k",
             "spark.sql.files.openCostInBytes": "1k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        files = []
        for n in (2_000, 20_000):
            root = f"{workdir}/{n}"
            one = decode.to_facts(decode.parse_messages(sample_lines(spark, n=1))).where("dataunit_id = 4")
            none = F.lit(None).cast("string")
            views_ = spark.range(n, numPartitions=n // 500).join(F.broadcast(one)).withColumn(
                "page_view", F.col("page_view").withField("nonce", F.xxhash64("id"))).drop("id")
            views_.withColumns({"raw": none, "reason": none}).select(*S.NEW_DATA.fieldNames()).write.partitionBy(*S.PARTITION_COLUMNS).parquet(f"{root}/new")
            master.absorb(spark, f"{root}/new", f"{root}/m", f"{root}/ck", "r")
            stored = master.read_master(spark, f"{root}/m")
            assert stored.count() == n
            files.append(len(stored.inputFiles()))
        assert files[1] >= 5 * files[0], files
    finally:
        for k in small:
            spark.conf.unset(k)


def test_bad_facts_never_reach_the_master(spark, workdir):
    facts = decode.to_facts(decode.parse_messages(sample_lines(spark)))
    none = F.lit(None).cast("string")
    odd = F.col("true_as_of_secs") % 1200 == 0
    f = facts.withColumns({"raw": none, "reason": none,
                           "value_id": F.when((F.col("dataunit_id") == 4) & odd, 5).otherwise(F.col("value_id"))})
    f = f.unionAll(f.where("dataunit_id = 3").withColumn("dataunit_id", F.lit(None).cast("int")))
    f.write.partitionBy(*S.PARTITION_COLUMNS).parquet(f"{workdir}/new")
    master.absorb(spark, f"{workdir}/new", f"{workdir}/m", f"{workdir}/ck", "r")
    assert master.absorbed_counts(spark, f"{workdir}/m") == {"r": {"facts": 33, "rejected": 16}}
    for _ in range(2):      # live, then compacted
        assert master.read_master(spark, f"{workdir}/m").count() == 17
        assert FS.invalid_partitions(master.read_master(spark, f"{workdir}/m")).count() == 0
        bad = {(r.dataunit_id, r.value_id, r.problem): r.n for r in master.read_rejected(
            spark, f"{workdir}/m").groupBy("dataunit_id", "value_id", "problem").agg(F.count("*").alias("n")).collect()}
        assert bad == {(4, 5, "illegal_partition"): 15, (None, 0, "branch_mismatch"): 1}
        master.compact_master(spark, f"{workdir}/m")


def test_deliveries_are_built_once(spark, workdir):
    """the parts of the queries that run jobs are read from one kept copy of the lines."""
    from hourglass.plans import catalog

    rows = [(f'{{"n":{i}}}', i) for i in range(95)] + [("no id", None), (None, 3), ('"quoted", ', 41)]
    lines = spark.createDataFrame(rows, "value string, id long")
    parts = catalog.deliveries(spark, workdir, lines)
    assert len(parts) == catalog.PARTS
    for k, part in enumerate(parts):
        assert sorted(r[0] or "" for r in part.collect()) == sorted(
            r[0] or "" for r in catalog.part_of(lines, k).collect())
        assert part.inputFiles() and all(f"{workdir}/lines/" in f.replace("file:///", "/") for f in part.inputFiles())
    empty = catalog.deliveries(spark, f"{workdir}/none", lines.where("id < 0"))
    assert [p.count() for p in empty] == [0] * catalog.PARTS
