"""Incremental key/value shards and the file index of the view store."""

import pytest
from pyspark.sql import functions as F

from hourglass.operators import file_index, serving, shards, storage, views
from hourglass.plans import inspect, jobs


def view_of(spark, first, last, hour=473352, n=1):
    return (spark.range(first, last).select(
        F.format_string("http://p%05d.org/a", "id").alias("url"), F.lit("h").alias("granularity"),
        F.lit(hour).cast("long").alias("bucket"), F.lit(n).cast("long").alias("total_pageviews")))


def decoded(spark, root):
    return sorted(views.from_key_value(shards.read_shards(spark, root)).collect())


@pytest.mark.parametrize("by", ["url", "key"])
def test_a_refresh_rewrites_only_touched_shards(spark, workdir, by):
    root = f"{workdir}/kv"
    shards.rebuild_shards(spark, root, view_of(spark, 0, 400), 32, by, ["a"])
    before = {r.f: r.t for r in files(spark, root)}
    delta = view_of(spark, 3, 5, n=7).unionByName(view_of(spark, 900, 901))
    touched = shards.refresh_shards(spark, root, delta, ["b"])
    assert 1 <= len(touched) <= 3
    column = F.col("url") if by == "url" else F.expr("encode(concat(url, '/h-473352'), 'UTF-8')")
    assert touched == sorted({r[0] for r in delta.select(shards.shard_of(column, 32)).collect()})
    now = shards.current_shards(spark, root)
    assert {int(s) for s, g in now["shards"].items() if g == 2} == set(touched)
    after = {r.f: r.t for r in files(spark, root)}
    kept = {f: t for f, t in after.items() if "generation=1/" in f}
    assert all(before[f] == t for f, t in kept.items())
    want = view_of(spark, 0, 400).unionByName(delta).groupBy("url", "granularity", "bucket") \
        .agg(F.sum("total_pageviews").alias("total_pageviews"))
    assert decoded(spark, root) == sorted(want.collect())


def files(spark, root):
    return spark.read.option("recursiveFileLookup", True).schema("key binary").parquet(
        *[f"{root}/generation={g}/shard={s}" for s, g in shards.current_shards(spark, root)["shards"].items()]) \
        .select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_modification_time").alias("t")) \
        .distinct().collect()


def test_counted_runs_and_old_generations(spark, workdir):
    root = f"{workdir}/kv"
    with pytest.raises(ValueError):
        shards.refresh_shards(spark, root, view_of(spark, 0, 1), ["a"])
    assert shards.read_shards(spark, root).count() == 0
    shards.rebuild_shards(spark, root, view_of(spark, 0, 50), 4, runs=["a"])
    assert shards.refresh_shards(spark, root, view_of(spark, 0, 50), ["b"]) == [0, 1, 2, 3]
    assert shards.refresh_shards(spark, root, view_of(spark, 0, 50), ["b"]) == []
    with pytest.raises(ValueError):
        shards.refresh_shards(spark, root, view_of(spark, 0, 50), ["b", "c"])
    assert shards.refresh_shards(spark, root, view_of(spark, 0, 0), ["c"]) == []
    assert {r.total_pageviews for r in decoded(spark, root)} == {2}
    # Versions 2 and 3 are kept; both refer to generation 2 only.
    assert [n for n in storage.list_names(spark, root) if n.startswith("generation=")] == ["generation=2"]


def test_a_lookup_reads_the_shard_of_its_url(spark, workdir):
    root = f"{workdir}/kv"
    shards.rebuild_shards(spark, root, view_of(spark, 0, 500), 16)
    url = "http://p00042.org/a"
    found = shards.read_shards(spark, root, [url])
    number = spark.range(1).select(shards.shard_of(F.lit(url), 16)).first()[0]
    assert {f.split("/")[-2] for f in found.inputFiles()} == {f"shard={number}"}
    assert [r.total_pageviews for r in views.from_key_value(found).where(F.col("url") == url).collect()] == [1]
    assert shards.read_shards(spark, root, []).count() == 0
    shards.rebuild_shards(spark, root, view_of(spark, 0, 500), 16, by="key")
    assert shards.read_shards(spark, root, [url]).count() == 500


def test_writing_shards_shuffles_once(spark):
    rows = shards._sharded(view_of(spark, 0, 50), 4, "url")
    out = rows.repartitionByRange("shard", "key").groupBy("shard", "key").agg(F.count("*")) \
        .sortWithinPartitions("shard", "key")
    assert inspect.count_nodes(out, "Exchange") == 1


def facts_of(spark, urls, hours, copies=1):
    """Page-view facts of ``urls`` pages in each of ``hours`` hours from 473352 on."""
    from hourglass.operators import decode
    line = F.format_string(
        '{"messagetype":"pageview","pedigree":"%d","personid":"1","pageid":"http://p%05d.org/a"}',
        F.lit(473352 * 3600) + F.expr(f"(id div {urls}) % {hours}") * 3600, F.col("id") % urls)
    return decode.to_facts(decode.parse_messages(spark.range(urls * hours * copies).select(line.alias("value"))))


def test_a_lookup_opens_as_many_files_whatever_the_view(spark, workdir):
    url, pieces = "http://p00042.org/a", serving.cover(473352, 473360)
    opened = {}
    for size in (4, 16):
        root = f"{workdir}/view{size}"
        storage.rebuild_view(spark, root, facts_of(spark, 100 * size, 3), ["a"], files_per_granularity=size)
        whole = storage.read_current_view(spark, root, keep_layout=True)
        some = storage.read_view_of(spark, root, [url], pieces)
        opened[size] = len(some.inputFiles())
        assert opened[size] < len(whole.inputFiles()) / 4
        urls = serving.url_list([url], spark)
        got, want = (serving.batch_range(v, urls, 473352, 473360).collect() for v in (some, whole))
        assert got == want and got[0].batch_pageviews == 3
    assert opened[16] <= opened[4] <= 4


def test_the_index_follows_refreshes(spark, workdir):
    root, url, pieces = f"{workdir}/view", "http://p00007.org/a", [("h", 473352, 473400)]
    facts = facts_of(spark, 20, 2)
    late = facts.withColumn("true_as_of_secs", F.col("true_as_of_secs") + 40 * 86400)

    def rows_in_index():
        now = storage.current_view(spark, root)
        index = file_index.read_index(spark, root, now["version"])
        assert index.agg(F.sum("n")).first()[0] == storage.read_current_view(spark, root).count()
        named = {f"generation={r.generation}/granularity={r.granularity}/period={r.period}/{r.file}"
                 for r in index.collect()}
        assert named == {f.split("/view/")[1] for f in storage.read_current_view(spark, root).inputFiles()}

    storage.rebuild_view(spark, root, facts, ["a"])
    rows_in_index()
    storage.refresh_current_view(spark, root, late, ["b"])      # new periods: old files stay
    rows_in_index()
    storage.refresh_current_view(spark, root, facts, ["c"])     # an old period again
    rows_in_index()
    hours = storage.read_view_of(spark, root, [url], pieces).where((F.col("url") == url) & (F.col("granularity") == "h"))
    assert sorted((r.bucket, r.total_pageviews) for r in hours.collect()) == [(473352, 2), (473353, 2)]
    assert storage.read_view_of(spark, root, ["http://zzz.org/"], pieces).count() == 0
    assert storage.read_view_of(spark, root, [url], []).count() == 0
    assert storage.read_view_of(spark, root, [url], [("h", 1, 2)]).count() == 0
    assert len([n for n in storage.list_names(spark, root) if n.startswith("_files-")]) == 2
    # A view written before there was an index, and a very wide lookup, read the folders.
    for n in storage.list_names(spark, root):
        if n.startswith("_files-"):
            storage.delete_folder(spark, f"{root}/{n}")
    assert storage.read_view_of(spark, root, [url], pieces).count() == storage.read_current_view(spark, root).count()
    storage.refresh_current_view(spark, root, late, ["d"])
    rows_in_index()


def test_jobs_count_by_the_index(spark, workdir, monkeypatch):
    root = f"{workdir}/view"
    storage.rebuild_view(spark, root, facts_of(spark, 30, 3), ["a"], files_per_granularity=6)
    spark.createDataFrame([], "value string").write.text(f"{workdir}/in")
    named = jobs.count_pageviews(spark, root, f"{workdir}/rt", ["http://p00003.org/a?x=1"], 473352, 473400)
    detail = jobs.get_pageviews(spark, root, f"{workdir}/rt", ["http://p00003.org/a"], "01.01.2024|00", "02.01.2024|00")
    assert [(r.url, r.pageviews, r.hour_done) for r in named.collect()] == [("http://p00003.org/a", 3, 473354)]
    assert [r.hour_bucket for r in detail.orderBy("hour_bucket").collect()] == [473352, 473353, 473354]
    monkeypatch.setattr(file_index, "MOST_FILES", 0)
    again = jobs.count_pageviews(spark, root, f"{workdir}/rt", ["http://p00003.org/a"], 473352, 473400)
    assert again.collect() == named.collect()


def above_the_scan(df):
    """Names of the nodes from the only file scan up to the first join."""
    tree = [(len(line) - len(line.lstrip(" :+-")), line) for line in inspect.physical_section(df).splitlines()]
    k = next(i for i, (_, line) in enumerate(tree) if "Scan parquet" in line)
    depth, path = tree[k][0], []
    for d, line in reversed(tree[:k]):
        if d < depth:
            depth = d
            path.append(line.strip(" :+-"))
            if "Join" in line:
                return path
    raise AssertionError("no join above the scan")


def test_a_long_list_is_shuffled_to_the_buckets_of_the_view(spark, workdir):
    view = views.batch_view(facts_of(spark, 300, 3), with_last_hour=True)
    storage.write_view_sharded(view, "hg_bucketed_view", f"{workdir}/table", shards=6)
    storage.write_view(view, f"{workdir}/plain")
    urls = serving.url_list(spark.range(0, 600, 2).select(F.format_string("http://p%05d.org/a", "id").alias("url")))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rt = spark.createDataFrame([], "url string, hour_bucket long, secs long")
        stored = storage.read_view(spark, f"{workdir}/plain", keep_layout=True)
        bucketed, plain = (serving.count_pageviews(v, rt, urls, 473352, 473360, broadcast_rows=10, buckets=n)
                           for v, n in ((spark.table("hg_bucketed_view"), 6), (stored, None)))
        assert not any("Exchange" in n for n in above_the_scan(bucketed))
        assert any("Exchange" in n for n in above_the_scan(plain))
        assert sorted(bucketed.collect(), key=str) == sorted(plain.collect(), key=str)
        assert bucketed.where("pageviews = 3").count() == 150 and bucketed.count() == 300
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql("DROP TABLE hg_bucketed_view")
