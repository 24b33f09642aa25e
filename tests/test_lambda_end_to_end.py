"""The whole architecture through the job entry points: one queue feeds the
ingest and the speed layer; the batch layer absorbs and builds the view; the
realtime table is folded and expired; serving merges both. With every write
counted, batch + realtime must equal the true pageview count of any range,
before and after the batch run."""

from pyspark.sql import functions as F

from hourglass.operators import decode, serving
from hourglass.plans import jobs
from hourglass.sources import messages as M
from hourglass.sources import testdata as td
from hourglass.streaming import ingest, speed
from tests.conftest import SF_SMALL


def truth(spark, lines, urls, a, b):
    parsed = decode.parse_messages(lines, strict_urls=True)
    rows = decode.realtime_rows(parsed)["pageviews"]
    got = (rows.where(F.col("hour_bucket").between(a, b)).groupBy("url")
           .agg(F.count(F.lit(1)).alias("n")).collect())
    d = {r.url: r.n for r in got}
    return {u: d.get(u, 0) for u in urls}


def test_lambda_pipeline(spark, workdir):
    lines = td.message_lines(spark, SF_SMALL, kinds=("pageview", "page", "person", "equiv"))
    staged = f"{workdir}/staged"
    lines.repartitionByRange(4, "id").sortWithinPartitions("id").select("value") \
        .write.mode("overwrite").text(staged)
    files = sorted(spark.read.text(staged).inputFiles())
    queue = f"{workdir}/queue"
    for f in files[:2]:
        spark.read.text(f).write.mode("append").text(queue)

    def run_streams():
        q = ingest.start_ingest(M.text_source(spark, queue), f"{workdir}/new", f"{workdir}/ck_i",
                                trigger={"availableNow": True})
        q.awaitTermination()
        speed.await_all(speed.start_speed(M.text_source(spark, queue), f"{workdir}/rt",
                                          f"{workdir}/ck_s", trigger={"availableNow": True}))

    run_streams()
    jobs.run_batch(spark, f"{workdir}/new", f"{workdir}/master", f"{workdir}/view",
                   f"{workdir}/ck_b")
    jobs.expire_realtime(spark, f"{workdir}/view", f"{workdir}/rt", f"{workdir}/snap1")
    # more traffic arrives; only the speed layer has seen it so far
    for f in files[2:]:
        spark.read.text(f).write.mode("append").text(queue)
    run_streams()

    urls = [r.url for r in serving.url_list(td.table(spark, SF_SMALL, "pages").select("url"))
            .collect()]
    delivered = spark.read.text(queue)
    for a, b in [(473352, 474095), (473600, 473760), (473900, 474100)]:
        want = truth(spark, delivered, urls, a, b)
        got = jobs.count_pageviews(spark, f"{workdir}/view", f"{workdir}/rt",
                                   spark.createDataFrame([(u,) for u in urls], "url string"),
                                   a, b, snapshot_path=f"{workdir}/snap1", mode="every_event")
        g = {r.url: r.pageviews for r in got.collect()}
        assert g == want, (a, b)
    # the next batch run absorbs everything; realtime hours it covers expire
    jobs.run_incremental(spark, f"{workdir}/new", f"{workdir}/master", f"{workdir}/view",
                         f"{workdir}/ck_b", run_id="r2")
    jobs.expire_realtime(spark, f"{workdir}/view", f"{workdir}/rt", f"{workdir}/snap2",
                         previous_snapshot=f"{workdir}/snap1")
    a, b = 473352, 474095
    got = jobs.count_pageviews(spark, f"{workdir}/view", f"{workdir}/rt",
                               spark.createDataFrame([(u,) for u in urls], "url string"),
                               a, b, snapshot_path=f"{workdir}/snap2", mode="every_event")
    assert {r.url: r.pageviews for r in got.collect()} == truth(spark, delivered, urls, a, b)
    assert {r.realtime_pageviews for r in got.collect()} == {0}
