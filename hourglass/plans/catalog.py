"""Registered queries (Spark) and their DuckDB oracles.

Each query takes ``(spark, sf_dir)``, shapes the test tables into the input
the job expects (``hourglass.sources.testdata``), runs the library's own
operators on *all* of it and returns a DataFrame. ``ORACLES`` holds, per
query, SQL computing the same result directly from the base tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass import schemas as S
from hourglass.functions import deserialize_long, key_bucket, key_granularity, key_url, normalize_url
from hourglass.operators import decode, master, realtime, serving, shards, storage, views
from hourglass.plans import jobs
from hourglass.plans import sqlgen as G
from hourglass.session import work_dir
from hourglass.sources import facts as FS
from hourglass.sources import messages as M
from hourglass.sources import testdata as td
from hourglass.streaming import ingest, speed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


# --- shared inputs ---------------------------------------------------------------------

def parsed_stream(spark: SparkSession, sf_dir: str, kinds=("pageview", "page", "person",
                                                             "equiv", "broken"),
                  coarse: bool = False, strict_urls: bool = False) -> DataFrame:
    lines = td.message_lines(spark, sf_dir, kinds=kinds, coarse=coarse)
    return decode.parse_messages(lines, strict_urls=strict_urls)


def pageview_facts(spark: SparkSession, sf_dir: str, coarse: bool = False) -> DataFrame:
    return decode.to_facts(parsed_stream(spark, sf_dir, kinds=("pageview",), coarse=coarse))


def all_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.to_facts(parsed_stream(spark, sf_dir))


PV_SQL = G.pageview_rows_sql()
PV_COARSE_SQL = G.pageview_rows_sql(coarse=True)
NORM_PV = f"SELECT {G.normalize_url_sql('raw_url')} AS url, secs, personid FROM ({PV_SQL})"
HOURLY_SQL = f"SELECT url, secs // 3600 AS h, count(*) AS n FROM ({NORM_PV}) GROUP BY 1, 2"
VIEW_SQL = G.granularity_rollup_sql(f"({HOURLY_SQL})")


# --- P1 ------------------------------------------------------------------------------

@register("normalize_url", f"""
    SELECT page_id, url AS raw_url, {G.normalize_url_sql('url')} AS url FROM pages
    UNION ALL
    SELECT page_id, url || '?article=1', {G.normalize_url_sql("url || '?article=1'")} FROM pages
""")
def q_normalize_url(spark, sf_dir):
    """Every page URL, raw and with a query string appended, normalized."""
    p = td.table(spark, sf_dir, "pages").select("page_id", "url")
    both = p.select("page_id", F.col("url").alias("raw_url")).unionByName(
        p.select("page_id", F.concat(F.col("url"), F.lit("?article=1")).alias("raw_url")))
    return both.select("page_id", "raw_url", normalize_url("raw_url").alias("url"))


# --- A1 / A2 / G6 --------------------------------------------------------------------

@register("pageviews_by_hour", f"""
    SELECT url, CAST(h AS BIGINT) AS hour_bucket, CAST(n AS BIGINT) AS pageviews
    FROM ({HOURLY_SQL})
""")
def q_pageviews_by_hour(spark, sf_dir):
    """Pageview messages decoded to facts, URLs normalized, counted per (url, hour)."""
    return views.hourly_counts(pageview_facts(spark, sf_dir))


@register("pageviews_by_granularity", VIEW_SQL)
def q_pageviews_by_granularity(spark, sf_dir):
    """The batch view: hourly counts rolled up to h/d/w/m buckets (P4, A2, G6); the flagship."""
    return views.batch_view(pageview_facts(spark, sf_dir))


# --- P5 / P6 / P7 / P13 --------------------------------------------------------------

@register("batch_view_kv", f"""
    SELECT url || '/' || granularity || '-' || CAST(bucket AS VARCHAR) AS key,
           printf('%016X', total_pageviews) AS value_hex
    FROM ({VIEW_SQL})
""")
def q_batch_view_kv(spark, sf_dir):
    """The batch view in key/value form: key text and the 8-byte value as hex."""
    kv = views.to_key_value(views.batch_view(pageview_facts(spark, sf_dir)))
    return kv.select(F.decode("key", "UTF-8").alias("key"), F.hex("value").alias("value_hex"))


@register("batch_view_kv_decode", VIEW_SQL)
def q_batch_view_kv_decode(spark, sf_dir):
    """Key/value view decoded back to the typed view."""
    kv = views.to_key_value(views.batch_view(pageview_facts(spark, sf_dir)))
    return views.from_key_value(kv)


# --- S3 / S4 / F1 / P8 / P10 ---------------------------------------------------------

DECODED_SQL = f"""
    SELECT 'pageview' AS messagetype, secs, personid, NULL AS personid1, NULL AS personid2,
           raw_url AS url, NULL AS pageview, NULL AS gendertype, NULL AS fullname,
           NULL AS city, NULL AS state, NULL AS country
    FROM ({PV_SQL})
    UNION ALL
    SELECT 'pageview', secs, personid, NULL, NULL, raw_url, NULL, NULL, NULL, NULL, NULL, NULL
    FROM ({G.bad_url_rows_sql()})
    UNION ALL
    SELECT 'page', secs, NULL, NULL, NULL, url, pageview, NULL, NULL, NULL, NULL, NULL
    FROM ({G.page_rows_sql()})
    UNION ALL
    SELECT 'person', secs, personid, NULL, NULL, NULL, NULL, gendertype, fullname,
           city, state, country
    FROM ({G.person_rows_sql()})
    UNION ALL
    SELECT 'equiv', secs, NULL, personid1, personid2, NULL, NULL, NULL, NULL, NULL, NULL, NULL
    FROM ({G.equiv_rows_sql()})
"""


@register("decode_messages", DECODED_SQL)
def q_decode_messages(spark, sf_dir):
    """All valid messages of the mixed stream (envelopes with trailing commas
    included), routed by type (S3, S4, F1, P8, P10)."""
    p = parsed_stream(spark, sf_dir).where(F.col("reason").isNull())
    return p.select(
        "messagetype", "secs", "personid", "personid1", "personid2",
        F.coalesce("pageid", "url").alias("url"),
        "pageview", "gendertype", "fullname", "city", "state", "country",
    )


# --- S5..S9 --------------------------------------------------------------------------

def _pid_sql(expr: str, prefix: str) -> str:
    return (f"CASE WHEN starts_with({expr}, 'cookie') THEN {expr} END AS {prefix}cookie, "
            f"CASE WHEN starts_with({expr}, 'cookie') THEN NULL "
            f"ELSE TRY_CAST({expr} AS BIGINT) END AS {prefix}user_id")


@register("decode_pageview_facts", f"""
    SELECT secs AS true_as_of_secs, {_pid_sql('personid', 'person_')}, raw_url AS url
    FROM (SELECT * FROM ({PV_SQL}) UNION ALL SELECT * FROM ({G.bad_url_rows_sql()}))
""")
def q_decode_pageview_facts(spark, sf_dir):
    """Page-view facts of the mixed stream: timestamp, person id union and raw URL."""
    f = all_facts(spark, sf_dir).where(F.col("dataunit_id") == 4)
    return f.select(
        "true_as_of_secs",
        F.col("page_view.person.cookie").alias("person_cookie"),
        F.col("page_view.person.user_id").alias("person_user_id"),
        F.col("page_view.page.url").alias("url"),
    )


@register("decode_page_facts", f"""
    SELECT secs AS true_as_of_secs, url, CAST(pageview AS INTEGER) AS page_views
    FROM ({G.page_rows_sql()})
""")
def q_decode_page_facts(spark, sf_dir):
    """Page-property facts of the mixed stream."""
    f = all_facts(spark, sf_dir).where(F.col("dataunit_id") == 2)
    return f.select(
        "true_as_of_secs",
        F.col("page_property.id.url").alias("url"),
        F.col("page_property.property.page_views").alias("page_views"),
    )


@register("decode_person_facts", f"""
    WITH p AS ({G.person_rows_sql()})
    SELECT secs AS true_as_of_secs, 1 AS value_id, {_pid_sql('personid', '')},
           fullname AS full_name, NULL AS gender, NULL AS city, NULL AS state, NULL AS country
    FROM p
    UNION ALL
    SELECT secs, 2, {_pid_sql('personid', '')}, NULL,
           CASE WHEN gendertype = 'MALE' THEN 'MALE' ELSE 'FEMALE' END, NULL, NULL, NULL
    FROM p
    UNION ALL
    SELECT secs, 3, {_pid_sql('personid', '')}, NULL, NULL, city, state, country
    FROM p
""")
def q_decode_person_facts(spark, sf_dir):
    """Person-property facts: three per person message, one per value id."""
    f = all_facts(spark, sf_dir).where(F.col("dataunit_id") == 1)
    pp = "person_property"
    return f.select(
        "true_as_of_secs", "value_id",
        F.col(f"{pp}.id.cookie").alias("cookie"),
        F.col(f"{pp}.id.user_id").alias("user_id"),
        F.col(f"{pp}.property.full_name").alias("full_name"),
        F.col(f"{pp}.property.gender").alias("gender"),
        F.col(f"{pp}.property.location.city").alias("city"),
        F.col(f"{pp}.property.location.state").alias("state"),
        F.col(f"{pp}.property.location.country").alias("country"),
    )


@register("decode_equiv_facts", f"""
    SELECT secs AS true_as_of_secs, {_pid_sql('personid1', 'id1_')}, {_pid_sql('personid2', 'id2_')}
    FROM ({G.equiv_rows_sql()})
""")
def q_decode_equiv_facts(spark, sf_dir):
    """Equiv facts: both person id unions."""
    f = all_facts(spark, sf_dir).where(F.col("dataunit_id") == 3)
    return f.select(
        "true_as_of_secs",
        F.col("equiv.id1.cookie").alias("id1_cookie"),
        F.col("equiv.id1.user_id").alias("id1_user_id"),
        F.col("equiv.id2.cookie").alias("id2_cookie"),
        F.col("equiv.id2.user_id").alias("id2_user_id"),
    )


# --- S13 / S14 / S15 / P14 -----------------------------------------------------------

@register("facts_by_partition", f"""
    SELECT dataunit_id, value_id, CAST(sum(n) AS BIGINT) AS facts FROM (
      SELECT 4 AS dataunit_id, 0 AS value_id, count(*) AS n FROM ({PV_SQL})
      UNION ALL SELECT 4, 0, count(*) FROM ({G.bad_url_rows_sql()})
      UNION ALL SELECT 2, 1, count(*) FROM ({G.page_rows_sql()})
      UNION ALL SELECT 1, 1, count(*) FROM ({G.person_rows_sql()})
      UNION ALL SELECT 1, 2, count(*) FROM ({G.person_rows_sql()})
      UNION ALL SELECT 1, 3, count(*) FROM ({G.person_rows_sql()})
      UNION ALL SELECT 3, 0, count(*) FROM ({G.equiv_rows_sql()})
    ) GROUP BY 1, 2
""")
def q_facts_by_partition(spark, sf_dir):
    """Decoded facts per (dataunit_id, value_id) partition."""
    return FS.partition_counts(all_facts(spark, sf_dir))


# --- S16 / Q15 -----------------------------------------------------------------------

def _reason_case() -> str:
    kinds = td.BROKEN_KINDS
    whens = " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(kinds[:-1]))
    return f"CASE event_id % 8 {whens} END"


@register("quarantine_counts", f"""
    SELECT {_reason_case()} AS reason, count(*) AS messages
    FROM events WHERE event_type = 'error' AND event_id % 8 < 7 GROUP BY 1
""")
def q_quarantine_counts(spark, sf_dir):
    """Broken messages of the mixed stream per quarantine reason."""
    p = parsed_stream(spark, sf_dir)
    return decode.to_quarantine(p).groupBy("reason").agg(F.count(F.lit(1)).alias("messages"))


# --- serving: G1..G5, A3..A6, F4..F7 -------------------------------------------------

# Fixed query parameters of the serving checks: a 161-hour range, and the hour
# before which facts count as absorbed by the batch layer.
RANGE_START, RANGE_END = 473600, 473760
BATCH_SPLIT_HOUR = 473688

NORM_RT = (f"SELECT {G.normalize_url_sql('raw_url')} AS url, secs, secs // 3600 AS h "
           f"FROM ({PV_COARSE_SQL})")
URLS_SQL = f"SELECT DISTINCT {G.normalize_url_sql('url')} AS url FROM pages"


def _batch_side_sql(split: bool, start: int | None = None, end: int | None = None) -> str:
    where = f"WHERE h < {BATCH_SPLIT_HOUR}" if split else ""
    a = RANGE_START if start is None else start
    b = RANGE_END if end is None else end
    return f"""
    SELECT u.url, CAST(coalesce(sum(v.n), 0) AS BIGINT) AS batch_pageviews,
           CAST(max(v.h) AS BIGINT) AS hour_done
    FROM ({URLS_SQL}) u
    LEFT JOIN (SELECT * FROM ({HOURLY_SQL}) {where}) v
      ON v.url = u.url AND v.h BETWEEN {a} AND {b}
    GROUP BY u.url"""


def page_urls(spark, sf_dir) -> DataFrame:
    return td.table(spark, sf_dir, "pages").select("url")


def realtime_rows(spark, sf_dir, coarse: bool = True,
                  kinds=("pageview", "page", "person", "equiv", "broken")) -> dict[str, DataFrame]:
    p = parsed_stream(spark, sf_dir, kinds=kinds, coarse=coarse, strict_urls=True)
    return decode.realtime_rows(p)


def realtime_pageview_rows(spark, sf_dir) -> DataFrame:
    """Speed-layer rows of the coarse pageview stream (with the broken lines,
    which the speed path quarantines)."""
    return realtime_rows(spark, sf_dir, kinds=("pageview", "broken"))["pageviews"]


def split_view(spark, sf_dir) -> DataFrame:
    """Batch view of the facts absorbed so far (hours before the split)."""
    f = pageview_facts(spark, sf_dir)
    f = f.where(F.col("true_as_of_secs") < BATCH_SPLIT_HOUR * 3600)
    return views.batch_view(f)


@register("batch_range_count", _batch_side_sql(split=False))
def q_batch_range_count(spark, sf_dir):
    """Batch-side range count with hour_done for every page URL."""
    v = views.batch_view(pageview_facts(spark, sf_dir))
    u = serving.url_list(page_urls(spark, sf_dir))
    return serving.batch_range(v, u, RANGE_START, RANGE_END)


@register("realtime_distinct_seconds", f"""
    SELECT url, CAST(h AS BIGINT) AS hour_bucket, count(DISTINCT secs) AS pageviews
    FROM ({NORM_RT}) GROUP BY 1, 2
""")
def q_realtime_distinct_seconds(spark, sf_dir):
    """Speed-path rows of the coarse pageview stream: distinct seconds per (url, hour)."""
    rows = realtime_pageview_rows(spark, sf_dir)
    return realtime.distinct_second_counts(rows)


@register("rt_pageviews", f"""
    SELECT url, CAST(h AS BIGINT) AS hour_bucket, secs, count(*) AS versions
    FROM ({NORM_RT}) GROUP BY 1, 2, 3
""")
def q_rt_pageviews(spark, sf_dir):
    """The realtime pageview table (one row per url, hour, second; last write
    wins) with the number of writes each row absorbed. Which person a row
    keeps is compared between the streaming and batch forms in the tests."""
    t = realtime.pageview_table(realtime_pageview_rows(spark, sf_dir))
    return t.select("url", "hour_bucket", "secs", F.col("events").alias("versions"))


COUNT_SQL = f"""
    WITH b AS ({_batch_side_sql(split=True)}),
    bounds AS (
      SELECT url, greatest({RANGE_START}, coalesce(hour_done + 1, {RANGE_START})) AS lo FROM b),
    r AS (
      SELECT bounds.url, count(DISTINCT rt.secs) AS realtime_pageviews
      FROM bounds JOIN ({NORM_RT}) rt
        ON rt.url = bounds.url AND rt.h BETWEEN bounds.lo AND {RANGE_END}
      GROUP BY bounds.url)
    SELECT b.url, b.batch_pageviews, b.hour_done,
           CAST(coalesce(r.realtime_pageviews, 0) AS BIGINT) AS realtime_pageviews,
           CAST(b.batch_pageviews + coalesce(r.realtime_pageviews, 0) AS BIGINT) AS pageviews
    FROM b LEFT JOIN r ON r.url = b.url
"""


@register("count_pageviews", COUNT_SQL)
def q_count_pageviews(spark, sf_dir):
    """countpageviews for every page URL: batch view of the facts before the
    split hour plus the realtime rows after each URL's hour_done (G1/G5, A6)."""
    rt = realtime_pageview_rows(spark, sf_dir)
    return serving.count_pageviews(split_view(spark, sf_dir), rt, page_urls(spark, sf_dir),
                                   RANGE_START, RANGE_END)


@register("get_pageviews", f"""
    WITH b AS ({_batch_side_sql(split=True)}),
    bounds AS (
      SELECT url, greatest({RANGE_START}, coalesce(hour_done + 1, {RANGE_START})) AS lo FROM b)
    SELECT 'batch' AS source, v.url, CAST(v.h AS BIGINT) AS hour_bucket,
           CAST(NULL AS BIGINT) AS secs, CAST(v.n AS BIGINT) AS pageviews
    FROM ({HOURLY_SQL}) v JOIN ({URLS_SQL}) u ON u.url = v.url
    WHERE v.h < {BATCH_SPLIT_HOUR} AND v.h BETWEEN {RANGE_START} AND {RANGE_END}
    UNION ALL
    SELECT DISTINCT 'realtime', rt.url, CAST(rt.h AS BIGINT), rt.secs, CAST(1 AS BIGINT)
    FROM bounds JOIN ({NORM_RT}) rt ON rt.url = bounds.url AND rt.h BETWEEN bounds.lo AND {RANGE_END}
""")
def q_get_pageviews(spark, sf_dir):
    """getpageviews detail rows for every page URL: batch hour rows and realtime second rows."""
    rt = realtime_pageview_rows(spark, sf_dir)
    return serving.get_pageviews(split_view(spark, sf_dir), rt, page_urls(spark, sf_dir),
                                 RANGE_START, RANGE_END)


# --- T2..T4 in batch form ------------------------------------------------------------

@register("rt_pages", f"""
    SELECT url, arg_max(pedigree, secs) AS pedigree, arg_max(pageview, secs) AS pageview
    FROM (SELECT {G.normalize_url_sql('url')} AS url, CAST(secs AS VARCHAR) AS pedigree,
                 pageview, secs FROM ({G.page_rows_sql()}))
    GROUP BY url
""")
def q_rt_pages(spark, sf_dir):
    """Realtime pages table: latest version per normalized URL."""
    return realtime.latest_per_key(realtime_rows(spark, sf_dir, kinds=("page", "broken"))["pages"], "pages")


@register("rt_persons", f"""
    SELECT personid, arg_max(CAST(secs AS VARCHAR), secs) AS pedigree,
           arg_max(gendertype, secs) AS gendertype, arg_max(fullname, secs) AS fullname,
           arg_max(city, secs) AS city, arg_max(state, secs) AS state,
           arg_max(country, secs) AS country
    FROM ({G.person_rows_sql()}) GROUP BY personid
""")
def q_rt_persons(spark, sf_dir):
    """Realtime persons table: latest version per person id, raw gender kept."""
    return realtime.latest_per_key(realtime_rows(spark, sf_dir, kinds=("person", "broken"))["persons"], "persons")


@register("rt_equivs", f"""
    SELECT personid1, personid2, arg_max(CAST(secs AS VARCHAR), secs) AS pedigree
    FROM ({G.equiv_rows_sql()}) GROUP BY 1, 2
""")
def q_rt_equivs(spark, sf_dir):
    """Realtime equivs table: latest pedigree per (personid1, personid2) (T4)."""
    return realtime.latest_per_key(realtime_rows(spark, sf_dir, kinds=("equiv", "broken"))["equivs"], "equivs")


# --- storage and streaming (write to fresh folders under spark.checkpoint.dir) --------

FACTS_PARTITION_SQL = ORACLES["facts_by_partition"]
QUARANTINE_SQL = ORACLES["quarantine_counts"]


def _write_input(spark, sf_dir, root, kinds, files=4, coarse=False, mode="overwrite"):
    lines = td.message_lines(spark, sf_dir, kinds=kinds, coarse=coarse)
    df = lines.repartitionByRange(files, "id").sortWithinPartitions("id").select("value")
    df.write.mode(mode).text(f"{root}/in")


@register("stream_ingest", f"""
    SELECT dataunit_id, value_id, CAST(NULL AS VARCHAR) AS reason, facts AS rows_written
    FROM ({FACTS_PARTITION_SQL})
    UNION ALL
    SELECT 0, 0, reason, messages FROM ({QUARANTINE_SQL})
""")
def q_stream_ingest(spark, sf_dir):
    """Queue lines in 4 files -> ingest stream (1 file per micro-batch) ->
    new-data sink; rows written per partition and quarantine reason."""
    root = work_dir(spark, "stream_ingest")
    _write_input(spark, sf_dir, root, kinds=("pageview", "page", "person", "equiv", "broken"))
    q = ingest.start_ingest(M.text_source(spark, f"{root}/in", max_files_per_trigger=1),
                            f"{root}/new", f"{root}/ck", trigger={"availableNow": True})
    q.awaitTermination()
    new = storage.read_new_data(spark, f"{root}/new")
    return new.groupBy("dataunit_id", "value_id", "reason").agg(
        F.count(F.lit(1)).alias("rows_written"))


@register("master_after_batch", FACTS_PARTITION_SQL)
def q_master_after_batch(spark, sf_dir):
    """Two ingest + absorb rounds (pageviews/pages, then persons/equivs/broken
    lines) -> master dataset; facts per partition = sum of both inputs."""
    root = work_dir(spark, "master_after_batch")
    for i, kinds in enumerate([("pageview", "page"), ("person", "equiv", "broken")]):
        _write_input(spark, sf_dir, f"{root}/round{i}", kinds=kinds)
        # the second round's files join the same queue folder
        src_dir = f"{root}/queue"
        spark.read.text(f"{root}/round{i}/in").write.mode("append").text(src_dir)
        q = ingest.start_ingest(M.text_source(spark, src_dir), f"{root}/new", f"{root}/ck_ingest",
                                trigger={"availableNow": True})
        q.awaitTermination()
        master.absorb(spark, f"{root}/new", f"{root}/master", f"{root}/ck_absorb", f"round{i}")
    return FS.partition_counts(master.read_master(spark, f"{root}/master"))


@register("stream_pageviews", ORACLES["realtime_distinct_seconds"])
def q_stream_pageviews(spark, sf_dir):
    """Coarse pageview lines delivered in event order, 2 files, then a restart
    from the checkpoint with 2 more files -> speed-layer pageview table ->
    distinct seconds per (url, hour)."""
    root = work_dir(spark, "stream_pageviews")
    lines = td.message_lines(spark, sf_dir, kinds=("pageview",), coarse=True)
    # event ids increase with event time: files in id order arrive in time order
    staged = f"{root}/staged"
    lines.repartitionByRange(4, "id").sortWithinPartitions("id").select("value") \
        .write.mode("overwrite").text(staged)
    files = sorted(spark.read.text(staged).inputFiles())
    queue = f"{root}/queue"
    for part in (files[:2], files[2:]):
        for f in part:  # one write per file: modification times keep the order
            spark.read.text(f).write.mode("append").text(queue)
        qs = speed.start_speed(M.text_source(spark, queue, max_files_per_trigger=1),
                               f"{root}/rt", f"{root}/ck", trigger={"availableNow": True}, tables=("pageviews",))
        speed.await_all(qs)
    pv = speed.read_realtime(spark, f"{root}/rt", "pageviews")
    return realtime.distinct_second_counts(pv)


@register("view_stored", VIEW_SQL)
def q_view_stored(spark, sf_dir):
    """Batch view (with last_hour) written partitioned by (granularity, period)
    with URL-range files, read back."""
    root = work_dir(spark, "view_stored")
    storage.write_view(views.batch_view(pageview_facts(spark, sf_dir), with_last_hour=True),
                       f"{root}/view")
    return storage.read_view(spark, f"{root}/view")


@register("view_sharded", VIEW_SQL)
def q_view_sharded(spark, sf_dir):
    """Batch view as a 4-bucket table on url (S17), read back through the catalog."""
    root = work_dir(spark, "view_sharded")
    name = "hg_view_" + root.rsplit("-", 1)[-1]
    storage.write_view_sharded(views.batch_view(pageview_facts(spark, sf_dir)), name,
                               f"{root}/table", shards=4)
    found = spark.table(name).select("url", "granularity", "bucket", "total_pageviews")
    spark.sql(f"DROP TABLE {name}")     # an external table: its files stay and are read
    return found


@register("view_kv_sharded", VIEW_SQL)
def q_view_kv_sharded(spark, sf_dir):
    """Key/value view in 4 url-sharded files, read back and decoded."""
    root = work_dir(spark, "view_kv")
    storage.write_view_kv(views.batch_view(pageview_facts(spark, sf_dir)), f"{root}/kv", shards=4)
    return views.from_key_value(storage.read_view_kv(spark, f"{root}/kv"))


@register("incremental_view", VIEW_SQL)
def q_incremental_view(spark, sf_dir):
    """View of the facts before the split hour, then refreshed additively with
    the view of the facts after it: equal to the full view."""
    root = work_dir(spark, "incremental_view")
    f = pageview_facts(spark, sf_dir)
    cut = F.col("true_as_of_secs") < BATCH_SPLIT_HOUR * 3600
    storage.write_view(views.batch_view(f.where(cut), with_last_hour=True), f"{root}/v1")
    storage.refresh_view(spark, f"{root}/v1", f.where(~cut), f"{root}/v2")
    return storage.read_view(spark, f"{root}/v2")


@register("normalized_urls", f"""
    SELECT 4 AS dataunit_id, url, count(*) AS facts
    FROM (SELECT {G.normalize_url_sql('raw_url')} AS url FROM ({PV_SQL})
          UNION ALL SELECT raw_url FROM ({G.bad_url_rows_sql()}))
    GROUP BY 1, 2
    UNION ALL
    SELECT 2, {G.normalize_url_sql('url')}, count(*) FROM pages GROUP BY 1, 2
""")
def q_normalized_urls(spark, sf_dir):
    """All facts -> partitioned master -> normalized copy (R8) -> facts per
    (kind, page URL) for the two kinds that carry a URL."""
    root = work_dir(spark, "normalized_urls")
    FS.write_facts(all_facts(spark, sf_dir), f"{root}/master")
    storage.normalize_master(spark, f"{root}/master", f"{root}/normalized")
    n = FS.read_kinds(spark, f"{root}/normalized", 2, 4)
    url = F.coalesce(F.col("page_view.page.url"), F.col("page_property.id.url"))
    return n.groupBy("dataunit_id", url.alias("url")).agg(F.count(F.lit(1)).alias("facts"))


@register("compacted_master", FACTS_PARTITION_SQL)
def q_compacted_master(spark, sf_dir):
    """Facts written in many small files, compacted with REBALANCE into a new
    generation; counts per partition are unchanged."""
    root = work_dir(spark, "compacted_master")
    FS.write_facts(all_facts(spark, sf_dir).repartition(16), f"{root}/master")
    storage.compact(spark, f"{root}/master", f"{root}/master-gen2")
    return FS.partition_counts(FS.read_facts(spark, f"{root}/master-gen2"))


@register("rt_equiv_adjacency", f"""
    SELECT personid1, count(*) AS equivs, min(personid2) AS first_personid2,
           max(personid2) AS last_personid2
    FROM (SELECT DISTINCT personid1, personid2 FROM ({G.equiv_rows_sql()})) GROUP BY 1
""")
def q_rt_equiv_adjacency(spark, sf_dir):
    """Realtime equivs (latest per pair) summarized per person: degree and
    the first/last equivalent id."""
    rows = realtime_rows(spark, sf_dir, kinds=("equiv", "broken"))["equivs"]
    return realtime.equiv_adjacency(realtime.latest_per_key(rows, "equivs"))


# --- option paths of the original semantics ------------------------------------------

@register("count_pageviews_every_event", COUNT_SQL.replace(
    "count(DISTINCT rt.secs) AS realtime_pageviews", "count(*) AS realtime_pageviews"))
def q_count_pageviews_every_event(spark, sf_dir):
    """``count_pageviews`` counting every realtime write (batch-consistent mode)."""
    rows = realtime_pageview_rows(spark, sf_dir)
    table = realtime.pageview_table(rows)     # one row per second with its write count
    return serving.count_pageviews(split_view(spark, sf_dir), table, page_urls(spark, sf_dir),
                                   RANGE_START, RANGE_END, mode="every_event")


@register("count_pageviews_legacy_bound", COUNT_SQL.replace(
    f"greatest({RANGE_START}, coalesce(hour_done + 1, {RANGE_START})) AS lo",
    "coalesce(hour_done, 0) + 1 AS lo"))
def q_count_pageviews_legacy_bound(spark, sf_dir):
    """``count_pageviews`` with the original lower bound: hour_done + 1, with
    hour_done = 0 when a URL has no batch data in range."""
    rt = realtime_pageview_rows(spark, sf_dir)
    return serving.count_pageviews(split_view(spark, sf_dir), rt, page_urls(spark, sf_dir),
                                   RANGE_START, RANGE_END, legacy_lower_bound=True)


@register("person_facts_last_property", f"""
    SELECT secs AS true_as_of_secs, {_pid_sql('personid', '')}, fullname AS full_name
    FROM ({G.person_rows_sql()})
""")
def q_person_facts_last_property(spark, sf_dir):
    """Person messages decoded keeping only the last property set (the full
    name), as a union set three times does."""
    p = parsed_stream(spark, sf_dir, kinds=("person", "broken"))
    f = decode.to_facts(p, last_property_only=True).where(F.col("dataunit_id") == 1)
    return f.select(
        "true_as_of_secs",
        F.col("person_property.id.cookie").alias("cookie"),
        F.col("person_property.id.user_id").alias("user_id"),
        F.col("person_property.property.full_name").alias("full_name"),
    )


def spoiled_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every decoded fact; page facts of odd views lose their number, page views at
    seconds divisible by 3 their nonce, equivs at seconds divisible by 5 move to
    kind 1, and full-name facts lose their timestamp and get a value id that does
    not exist."""
    f = all_facts(spark, sf_dir)
    d, secs = F.col("dataunit_id"), F.col("true_as_of_secs")
    odd = (d == 2) & (F.col("page_property.property.page_views") == 2)
    name = (d == 1) & (F.col("value_id") == 1)
    return f.select(
        F.when(~name, secs).alias("true_as_of_secs"),
        F.when((d == 3) & (secs % 5 == 0), 1).otherwise(d).alias("dataunit_id"),
        F.when(name, 9).otherwise(F.col("value_id")).alias("value_id"),
        "person_property",
        F.when(odd, F.col("page_property").withField("property.page_views", F.lit(None).cast("int")))
        .otherwise(F.col("page_property")).alias("page_property"),
        "equiv",
        F.when((d == 4) & (secs % 3 == 0), F.col("page_view").withField("nonce", F.lit(None).cast("bigint")))
        .otherwise(F.col("page_view")).alias("page_view"))


@register("fact_validation", f"""
    WITH planted AS (
      SELECT 2 AS dataunit_id, count(*) AS facts, count(*) FILTER (WHERE page_id % 2 = 1) AS invalid FROM pages
      UNION ALL
      SELECT 4, count(*), count(*) FILTER (WHERE secs % 3 = 0)
      FROM (SELECT secs FROM ({PV_SQL}) UNION ALL SELECT secs FROM ({G.bad_url_rows_sql()}))
      UNION ALL
      SELECT CASE WHEN secs % 5 = 0 THEN 1 ELSE 3 END, count(*), count(*) FILTER (WHERE secs % 5 = 0)
      FROM ({G.equiv_rows_sql()}) GROUP BY 1
      UNION ALL
      SELECT 1, 3 * count(*), count(*) FROM ({G.person_rows_sql()}))
    SELECT dataunit_id, CAST(sum(facts) AS BIGINT) AS facts, CAST(sum(invalid) AS BIGINT) AS invalid,
           CAST(CASE WHEN dataunit_id = 1 AND bool_or(dataunit_id = 1 AND moved > 0) THEN 2
                     WHEN dataunit_id = 1 THEN 1 ELSE 0 END AS BIGINT) AS bad_partitions
    FROM planted, (SELECT count(*) AS moved FROM ({G.equiv_rows_sql()}) WHERE secs % 5 = 0) GROUP BY 1
""")
def q_fact_validation(spark, sf_dir):
    """Required-field (S16) and partition-target (S15) validation of every decoded
    fact, some of them spoiled first (``spoiled_facts``)."""
    f = spoiled_facts(spark, sf_dir)
    bad = FS.invalid_facts(f).groupBy("dataunit_id").agg(F.count(F.lit(1)).alias("invalid"))
    badp = FS.invalid_partitions(f).groupBy("dataunit_id").agg(
        F.count(F.lit(1)).alias("bad_partitions"))
    per_kind = f.groupBy("dataunit_id").agg(F.count(F.lit(1)).alias("facts"))
    z = F.lit(0).cast("bigint")
    return (per_kind.join(bad, "dataunit_id", "left").join(badp, "dataunit_id", "left")
            .select("dataunit_id", "facts",
                    F.coalesce("invalid", z).alias("invalid"),
                    F.coalesce("bad_partitions", z).alias("bad_partitions")))


@register("realtime_compacted", f"""
    SELECT url, CAST(h AS BIGINT) AS hour_bucket, count(DISTINCT secs) AS pageviews
    FROM ({NORM_RT}) WHERE h >= {BATCH_SPLIT_HOUR} GROUP BY 1, 2
""")
def q_realtime_compacted(spark, sf_dir):
    """Speed layer over the coarse pageview stream, then the realtime table is
    folded into a snapshot that expires the URL hours a batch view of the
    facts before the split hour counts; distinct
    seconds per (url, hour) read through the snapshot."""
    root = work_dir(spark, "realtime_compacted")
    lines = td.message_lines(spark, sf_dir, kinds=("pageview", "broken"), coarse=True)
    lines.repartitionByRange(4, "id").sortWithinPartitions("id").select("value") \
        .write.mode("overwrite").text(f"{root}/queue")
    qs = speed.start_speed(M.text_source(spark, f"{root}/queue", max_files_per_trigger=1),
                           f"{root}/rt", f"{root}/ck", trigger={"availableNow": True}, tables=("pageviews",))
    speed.await_all(qs)
    absorbed = split_view(spark, sf_dir).where("granularity = 'h'").select(
        "url", F.col("bucket").alias("hour_bucket"))
    speed.compact_realtime(spark, f"{root}/rt", "pageviews", f"{root}/snap", absorbed=absorbed)
    pv = speed.read_realtime(spark, f"{root}/rt", "pageviews", snapshot_path=f"{root}/snap")
    return realtime.distinct_second_counts(pv)


@register("incremental_view_in_place", VIEW_SQL)
def q_incremental_view_in_place(spark, sf_dir):
    """View store of the facts before the split hour, then refreshed with the
    facts after it: only the (granularity, period) partitions those facts
    touch are rewritten; the result equals the full view."""
    root = work_dir(spark, "incremental_in_place")
    f = pageview_facts(spark, sf_dir)
    cut = F.col("true_as_of_secs") < BATCH_SPLIT_HOUR * 3600
    storage.rebuild_view(spark, f"{root}/view", f.where(cut), ["a"])
    storage.refresh_current_view(spark, f"{root}/view", f.where(~cut), ["b"])
    return storage.read_current_view(spark, f"{root}/view")


@register("view_kv_incremental", VIEW_SQL)
def q_view_kv_incremental(spark, sf_dir):
    """Key/value shards of the facts before the split hour, then two refreshes with the rest,
    the second repeated: only the shards that a delta's URLs hash to are rewritten (S17, R6);
    the result equals the full view."""
    root = work_dir(spark, "view_kv_incremental") + "/kv"
    f = pageview_facts(spark, sf_dir)
    hour = F.col("true_as_of_secs") / 3600
    late = hour >= BATCH_SPLIT_HOUR + 24
    shards.rebuild_shards(spark, root, views.batch_view(f.where(hour < BATCH_SPLIT_HOUR)), 64, runs=["a"])
    shards.refresh_shards(spark, root, views.batch_view(f.where((hour >= BATCH_SPLIT_HOUR) & ~late)), ["b"])
    for _ in range(2):
        shards.refresh_shards(spark, root, views.batch_view(f.where(late)), ["c"])
    return views.from_key_value(shards.read_shards(spark, root))


TOP_URL_SQL = f"""
    SELECT url FROM ({NORM_PV}) GROUP BY url ORDER BY count(*) DESC, url LIMIT 1"""


@register("count_pageviews_one_url", f"""
    WITH c AS ({COUNT_SQL})
    SELECT c.* FROM c WHERE c.url = ({TOP_URL_SQL})
""")
def q_count_pageviews_one_url(spark, sf_dir):
    """countpageviews for one URL (G1), given as a literal the way a user
    asks: the most viewed page (a top-1 report computed by Spark). The lookup
    takes the literal path: ``url = ...`` filters both views before any join
    (on stored views it reaches the Parquet scans, see tests/test_serving.py)."""
    top = (views.pageview_fields(pageview_facts(spark, sf_dir)).groupBy("url")
           .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "url").limit(1)
           .first().url)
    rt = realtime_pageview_rows(spark, sf_dir)
    return serving.count_pageviews(split_view(spark, sf_dir), rt, [top],
                                   RANGE_START, RANGE_END)


@register("count_pageviews_by_index", f"""
    WITH c AS ({COUNT_SQL})
    SELECT c.* FROM c WHERE c.url = ({TOP_URL_SQL})
""")
def q_count_pageviews_by_index(spark, sf_dir):
    """countpageviews for the most viewed page over a view store built and refreshed from
    all facts before the split: the store's file index names the files to open (F7, G1)."""
    root = work_dir(spark, "count_by_index") + "/view"
    f = pageview_facts(spark, sf_dir)
    hour = F.col("true_as_of_secs") / 3600
    storage.rebuild_view(spark, root, f.where(hour < BATCH_SPLIT_HOUR - 24), ["a"])
    storage.refresh_current_view(
        spark, root, f.where((hour >= BATCH_SPLIT_HOUR - 24) & (hour < BATCH_SPLIT_HOUR)), ["b"])
    top = (views.pageview_fields(f).groupBy("url").agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), "url").limit(1).first().url)
    view = storage.read_view_of(spark, root, [top], serving.cover(RANGE_START, RANGE_END))
    return serving.count_pageviews(view, realtime_pageview_rows(spark, sf_dir), [top], RANGE_START, RANGE_END)


# All of January 2024 in hours (the whole time span of the events table).
MONTH_START, MONTH_END = 473352, 474095


def stored_view(spark, sf_dir, facts: DataFrame, name: str) -> DataFrame:
    path = work_dir(spark, name) + "/view"
    storage.write_view(views.batch_view(facts, with_last_hour=True), path)
    return storage.read_view(spark, path, keep_layout=True)


@register("count_pageviews_stored", COUNT_SQL)
def q_count_pageviews_stored(spark, sf_dir):
    """``count_pageviews`` over a stored view: the range is read through
    its coarse-bucket cover and period partitions, hour_done from last_hour."""
    f = pageview_facts(spark, sf_dir).where(F.col("true_as_of_secs") < BATCH_SPLIT_HOUR * 3600)
    v = stored_view(spark, sf_dir, f, "count_pageviews_stored")
    rt = realtime_pageview_rows(spark, sf_dir)
    return serving.count_pageviews(v, rt, page_urls(spark, sf_dir), RANGE_START, RANGE_END)


@register("batch_range_long", _batch_side_sql(split=False, start=MONTH_START, end=MONTH_END))
def q_batch_range_long(spark, sf_dir):
    """Batch-side range count over the whole month for every page URL, from
    a stored view: months, weeks and days cover the range, hours only at
    its edges."""
    v = stored_view(spark, sf_dir, pageview_facts(spark, sf_dir), "batch_range_long")
    u = serving.url_list(page_urls(spark, sf_dir))
    return serving.batch_range(v, u, MONTH_START, MONTH_END)


@register("get_pageviews_stored", ORACLES["get_pageviews"])
def q_get_pageviews_stored(spark, sf_dir):
    """getpageviews over a stored view read with its layout: hour rows pruned
    to the periods of the range, hour_done from last_hour (G2)."""
    f = pageview_facts(spark, sf_dir).where(F.col("true_as_of_secs") < BATCH_SPLIT_HOUR * 3600)
    v = stored_view(spark, sf_dir, f, "get_pageviews_stored")
    rt = realtime_pageview_rows(spark, sf_dir)
    return serving.get_pageviews(v, rt, page_urls(spark, sf_dir), RANGE_START, RANGE_END)


@register("get_pageviews_every_event", f"""
    WITH b AS ({_batch_side_sql(split=True)}),
    bounds AS (
      SELECT url, greatest({RANGE_START}, coalesce(hour_done + 1, {RANGE_START})) AS lo FROM b)
    SELECT 'batch' AS source, v.url, CAST(v.h AS BIGINT) AS hour_bucket,
           CAST(NULL AS BIGINT) AS secs, CAST(v.n AS BIGINT) AS pageviews
    FROM ({HOURLY_SQL}) v JOIN ({URLS_SQL}) u ON u.url = v.url
    WHERE v.h < {BATCH_SPLIT_HOUR} AND v.h BETWEEN {RANGE_START} AND {RANGE_END}
    UNION ALL
    SELECT 'realtime', rt.url, CAST(rt.h AS BIGINT), rt.secs, count(*)
    FROM bounds JOIN ({NORM_RT}) rt ON rt.url = bounds.url AND rt.h BETWEEN bounds.lo AND {RANGE_END}
    GROUP BY 1, 2, 3, 4
""")
def q_get_pageviews_every_event(spark, sf_dir):
    """getpageviews counting every realtime write: each realtime second row
    carries its number of writes (batch-consistent mode, G2)."""
    rt = realtime.pageview_table(realtime_pageview_rows(spark, sf_dir))
    return serving.get_pageviews(split_view(spark, sf_dir), rt, page_urls(spark, sf_dir),
                                 RANGE_START, RANGE_END, mode="every_event")


# --- the jobs, run as jobs -----------------------------------------------------------------

#: Deliveries of the queries that run streams: lines go to the queue in four parts by
#: blocks of ten ids, so later parts hold earlier events.
PARTS = 4
PART_SQL = f"(event_id // {td.ENVELOPE_BLOCK}) % {PARTS}"


def part_of(lines: DataFrame, k: int) -> DataFrame:
    return lines.where(F.pmod(F.floor(F.col("id") / td.ENVELOPE_BLOCK), F.lit(PARTS)) == k).select("value")


def deliveries(spark, root: str, lines: DataFrame) -> list[DataFrame]:
    """The lines of each part, kept under ``root``: a query that delivers all parts reads the
    tables once, not once for each. Dealt by id, the files of a part are of one size and hold
    messages of all kinds."""
    kept, part = f"{root}/lines", F.pmod(F.floor(F.col("id") / td.ENVELOPE_BLOCK), F.lit(PARTS))
    lines.repartition("id").select("value", part.alias("part")).write.partitionBy("part").parquet(kept)
    found = spark.read.schema("value string, part int").parquet(kept)
    return [found.where(F.col("part") == k).select("value") for k in range(PARTS)]


def ingest_part(spark, root: str, lines: DataFrame) -> None:
    """Append lines to the queue and ingest everything that is there."""
    lines.write.mode("append").text(f"{root}/queue")
    ingest.start_ingest(M.text_source(spark, f"{root}/queue"), f"{root}/new", f"{root}/ck_ingest",
                        trigger={"availableNow": True}).awaitTermination()


def speed_parts(spark, root: str, lines: DataFrame, parts, tables=speed.TABLES) -> None:
    """Deliver parts of the lines one after another: one micro-batch each."""
    for k in parts:
        part_of(lines, k).write.mode("append").text(f"{root}/queue")
        speed.await_all(speed.start_speed(
            M.text_source(spark, f"{root}/queue"), f"{root}/rt", f"{root}/ck", tables=tables,
            trigger={"availableNow": True}))


@register("batch_job_view", VIEW_SQL)
def q_batch_job_view(spark, sf_dir):
    """J1 through the job: half the lines are ingested, a batch run builds the
    view, the rest arrives, and a second full run replaces the view."""
    root = work_dir(spark, "batch_job_view")
    parts = deliveries(spark, root, td.message_lines(spark, sf_dir, kinds=("pageview",)))
    for half in ((0, 1), (2, 3)):
        for k in half:
            ingest_part(spark, root, parts[k])
        jobs.run_batch(spark, f"{root}/new", f"{root}/master", f"{root}/view", f"{root}/ck")
    return jobs.inspect_view(spark, f"{root}/view")


@register("incremental_job_view", VIEW_SQL)
def q_incremental_job_view(spark, sf_dir):
    """J1 in increments: a batch run, a run given up after absorbing, two more
    increments with a compaction between, and finished run ids asked for
    again, which must change nothing; read through the inspection job (J5)."""
    root = work_dir(spark, "incremental_job_view")
    parts = deliveries(spark, root, td.message_lines(spark, sf_dir, kinds=("pageview",)))
    at = (f"{root}/new", f"{root}/master", f"{root}/view", f"{root}/ck")
    ingest_part(spark, root, parts[0])
    jobs.run_batch(spark, *at, run_id="r0")
    ingest_part(spark, root, parts[1])
    master.absorb(spark, f"{root}/new", f"{root}/master", f"{root}/ck/absorb", "given-up")
    ingest_part(spark, root, parts[2])
    jobs.run_incremental(spark, *at, run_id="r1")
    ingest_part(spark, root, parts[3])
    jobs.run_incremental(spark, *at, run_id="r2", compact_every=1)
    for old in ("r1", "given-up", "r2"):
        jobs.run_incremental(spark, *at, run_id=old)
    jobs.run_batch(spark, *at, run_id="r0")
    return jobs.inspect_view(spark, f"{root}/view", key_value=True).select(
        *[c.alias(n) for n, c in zip(S.BATCH_VIEW.fieldNames(), (
            key_url("key"), key_granularity("key"), key_bucket("key"), deserialize_long("value")), strict=True)])


@register("compact_then_absorb", FACTS_PARTITION_SQL)
def q_compact_then_absorb(spark, sf_dir):
    """Four rounds of ingest and absorb with a compaction after the first and
    the third; facts per partition of the master are the sum of all."""
    root = work_dir(spark, "compact_then_absorb")
    parts = deliveries(spark, root, td.message_lines(spark, sf_dir))
    for k in range(PARTS):
        ingest_part(spark, root, parts[k])
        master.absorb(spark, f"{root}/new", f"{root}/master", f"{root}/ck", f"r{k}")
        if k in (0, 2):
            master.compact_master(spark, f"{root}/master")
    return FS.partition_counts(master.read_master(spark, f"{root}/master"))


@register("master_after_retention", FACTS_PARTITION_SQL)
def q_master_after_retention(spark, sf_dir):
    """Four batch runs, each compacting the one before and dropping the new data
    it consumed (R3, R5); run ids come from the marks. Facts per partition of the
    master are the sum of all deliveries, though neither their new-data files nor
    the compacted live folders are there any more."""
    root = work_dir(spark, "master_after_retention")
    parts = deliveries(spark, root, td.message_lines(spark, sf_dir))
    for k in range(PARTS):
        ingest_part(spark, root, parts[k])
        jobs.run_batch(spark, f"{root}/new", f"{root}/master", f"{root}/view", f"{root}/ck",
                       compact_every=1, drop_consumed=True)
    master.compact_master(spark, f"{root}/master")
    master.drop_compacted(spark, f"{root}/master")
    return FS.partition_counts(master.read_master(spark, f"{root}/master"))


@register("master_rejects", f"""
    WITH planted AS (
      SELECT 2 AS dataunit_id, 1 AS value_id, CASE WHEN page_id % 2 = 1 THEN 'bad_page_property' END AS problem FROM pages
      UNION ALL
      SELECT 4, 0, CASE WHEN secs % 3 = 0 THEN 'bad_page_view' END
      FROM (SELECT secs FROM ({PV_SQL}) UNION ALL SELECT secs FROM ({G.bad_url_rows_sql()}))
      UNION ALL
      SELECT CASE WHEN secs % 5 = 0 THEN 1 ELSE 3 END, 0, CASE WHEN secs % 5 = 0 THEN 'branch_mismatch' END
      FROM ({G.equiv_rows_sql()})
      UNION ALL
      SELECT 1, v, CASE WHEN v = 9 THEN 'missing_pedigree' END FROM ({G.person_rows_sql()}), (VALUES (9), (2), (3)) t(v))
    SELECT dataunit_id, value_id, problem, count(*) AS facts FROM planted GROUP BY 1, 2, 3
""")
def q_master_rejects(spark, sf_dir):
    """Spoiled facts are absorbed, compacted and read back: sound ones are in the
    master under their kind, the others apart with their problem and the partition
    they claimed (S15, S16)."""
    root = work_dir(spark, "master_rejects")
    none = F.lit(None).cast("string")
    spoiled_facts(spark, sf_dir).withColumns({"raw": none, "reason": none}) \
        .write.partitionBy(*S.PARTITION_COLUMNS).parquet(f"{root}/new")
    master.absorb(spark, f"{root}/new", f"{root}/master", f"{root}/ck", "r1")
    master.compact_master(spark, f"{root}/master")
    kept = master.read_master(spark, f"{root}/master").withColumn("problem", none)
    rejected = master.read_rejected(spark, f"{root}/master")
    cols = [*S.PARTITION_COLUMNS, "problem"]
    return kept.select(*cols).unionByName(rejected.select(*cols)).groupBy(*cols).agg(
        F.count(F.lit(1)).alias("facts"))


NORM_RT_ID = (f"SELECT event_id, {G.normalize_url_sql('raw_url')} AS url, secs, secs // 3600 AS h, personid "
              f"FROM ({PV_COARSE_SQL})")


@register("realtime_expired_safe", f"""
    SELECT url, CAST(h AS BIGINT) AS hour_bucket, count(DISTINCT secs) AS pageviews
    FROM ({NORM_RT_ID}) rt
    WHERE {PART_SQL} > 0 AND NOT (h < {BATCH_SPLIT_HOUR} AND (url, h) IN (
      SELECT url, h FROM ({NORM_RT_ID}) WHERE starts_with(personid, 'cookie')))
    GROUP BY 1, 2
""")
def q_realtime_expired_safe(spark, sf_dir):
    """Realtime expiry. The first part of the pageviews is absorbed whole, so
    the first snapshot is empty; the rest arrives, and the second compaction
    drops the URL hours that a batch view of cookie visits before the split
    hour counts. Hours and URLs that the batch view lacks stay."""
    root = work_dir(spark, "realtime_expired_safe")
    lines = td.message_lines(spark, sf_dir, kinds=("pageview",), coarse=True)
    facts = pageview_facts(spark, sf_dir)
    hours = lambda f: views.batch_view(f).where("granularity = 'h'").select(
        "url", F.col("bucket").alias("hour_bucket"))
    speed_parts(spark, root, lines, [0])
    speed.compact_realtime(spark, f"{root}/rt", "pageviews", f"{root}/snap0", absorbed=hours(facts))
    speed_parts(spark, root, lines, [1, 2, 3])
    part = facts.where(F.col("page_view.person.cookie").isNotNull()
                       & (F.col("true_as_of_secs") < BATCH_SPLIT_HOUR * 3600))
    speed.compact_realtime(spark, f"{root}/rt", "pageviews", f"{root}/snap1", f"{root}/snap0", hours(part))
    pv = speed.read_realtime(spark, f"{root}/rt", "pageviews", snapshot_path=f"{root}/snap1")
    return realtime.distinct_second_counts(pv)


@register("realtime_bitmap_counts", ORACLES["realtime_distinct_seconds"])
def q_realtime_bitmap_counts(spark, sf_dir):
    """Distinct seconds per (url, hour) from the speed layer's hour bitmaps (A5): two
    micro-batches folded into a snapshot, two more merged with it by OR."""
    root = work_dir(spark, "realtime_bitmap_counts")
    lines = td.message_lines(spark, sf_dir, kinds=("pageview", "broken"), coarse=True)
    speed_parts(spark, root, lines, [0, 1])
    speed.compact_realtime(spark, f"{root}/rt", speed.HOURS, f"{root}/snap")
    speed_parts(spark, root, lines, [2, 3])
    return speed.read_hours(spark, f"{root}/rt", f"{root}/snap").select(
        "url", "hour_bucket", F.col("distinct_seconds").alias("pageviews"))


@register("quarantine_after_expiry", f"""
    SELECT coalesce({_reason_case()}, 'bad_url') AS reason, count(*) AS messages
    FROM events WHERE event_type = 'error' GROUP BY 1
""")
def q_quarantine_after_expiry(spark, sf_dir):
    """What the speed layer could not use, after the expiry job ran twice and removed
    the first batches: the quarantine is folded like the other tables."""
    root = work_dir(spark, "quarantine_after_expiry")
    lines = td.message_lines(spark, sf_dir, kinds=("page", "broken"))
    storage.rebuild_view(spark, f"{root}/view", pageview_facts(spark, sf_dir), ["a"])
    speed_parts(spark, root, lines, [0, 1])
    jobs.expire_realtime(spark, f"{root}/view", f"{root}/rt", f"{root}/snap0")
    speed_parts(spark, root, lines, [2])
    jobs.expire_realtime(spark, f"{root}/view", f"{root}/rt", f"{root}/snap1", f"{root}/snap0")
    speed_parts(spark, root, lines, [3])
    return speed.read_quarantine(spark, f"{root}/rt", f"{root}/snap1/{speed.QUARANTINE}").groupBy("reason").agg(
        F.sum("messages").cast("bigint").alias("messages"))


@register("expire_job_counts", COUNT_SQL.replace(NORM_RT, NORM_RT_ID))
def q_expire_job_counts(spark, sf_dir):
    """J4 over stored views after the expiry job ran twice (the second run
    removes folded batches): expiry changes no count. The realtime side is counted
    by hour bitmaps."""
    root = work_dir(spark, "expire_job_counts")
    f = pageview_facts(spark, sf_dir).where(F.col("true_as_of_secs") < BATCH_SPLIT_HOUR * 3600)
    storage.rebuild_view(spark, f"{root}/view", f, ["a"])
    lines = td.message_lines(spark, sf_dir, kinds=("pageview", "broken"), coarse=True)
    speed_parts(spark, root, lines, [0, 1])
    jobs.expire_realtime(spark, f"{root}/view", f"{root}/rt", f"{root}/snap0")
    speed_parts(spark, root, lines, [2])
    jobs.expire_realtime(spark, f"{root}/view", f"{root}/rt", f"{root}/snap1", f"{root}/snap0")
    speed_parts(spark, root, lines, [3])
    return jobs.count_pageviews(spark, f"{root}/view", f"{root}/rt", page_urls(spark, sf_dir),
                                RANGE_START, RANGE_END, snapshot_path=f"{root}/snap1")


# --- streaming T1..T4 ----------------------------------------------------------------------

@register("speed_pageviews", f"""
    SELECT url, CAST(h AS BIGINT) AS hour_bucket, secs,
           arg_max(personid, ({PART_SQL}, personid)) AS personid, count(*) AS events
    FROM ({NORM_RT_ID}) GROUP BY 1, 2, 3
""")
def q_speed_pageviews(spark, sf_dir):
    """The speed layer's pageview table over four micro-batches, with many
    views in one second: the person of the last micro-batch stays (T1)."""
    root = work_dir(spark, "speed_pageviews")
    speed_parts(spark, root, td.message_lines(spark, sf_dir, kinds=("pageview", "broken"), coarse=True), range(PARTS))
    return speed.read_realtime(spark, f"{root}/rt", "pageviews")


@register("speed_pages", ORACLES["rt_pages"])
def q_speed_pages(spark, sf_dir):
    """The speed layer's page table over four micro-batches."""
    root = work_dir(spark, "speed_pages")
    speed_parts(spark, root, td.message_lines(spark, sf_dir, kinds=("page", "broken")), range(PARTS))
    return speed.read_realtime(spark, f"{root}/rt", "pages")


@register("speed_persons", ORACLES["rt_persons"])
def q_speed_persons(spark, sf_dir):
    """The speed layer's person table over four micro-batches."""
    root = work_dir(spark, "speed_persons")
    speed_parts(spark, root, td.message_lines(spark, sf_dir, kinds=("person", "broken")), range(PARTS))
    return speed.read_realtime(spark, f"{root}/rt", "persons")


EQUIV_PAIRS_SQL = """
    SELECT event_id, CAST(user_id AS VARCHAR) AS personid1, 'cookie_' || CAST(event_id % 7 AS VARCHAR) AS personid2,
           CAST(epoch_us(ts) // 1000000 AS BIGINT) AS secs
    FROM events WHERE event_type IN ('signup', 'purchase')"""


@register("speed_equivs", f"""
    SELECT personid1, personid2, CAST(max(secs) AS VARCHAR) AS pedigree FROM ({EQUIV_PAIRS_SQL}) GROUP BY 1, 2
""")
def q_speed_equivs(spark, sf_dir):
    """The speed layer's equiv table over four micro-batches, persons with
    several equivs (T4)."""
    root = work_dir(spark, "speed_equivs")
    speed_parts(spark, root, td.message_lines(spark, sf_dir, kinds=("equiv_pair",)), range(PARTS))
    return speed.read_realtime(spark, f"{root}/rt", "equivs")


@register("speed_equiv_adjacency", f"""
    SELECT personid1, count(DISTINCT personid2) AS equivs, min(personid2) AS first_personid2,
           max(personid2) AS last_personid2
    FROM ({EQUIV_PAIRS_SQL}) GROUP BY 1
""")
def q_speed_equiv_adjacency(spark, sf_dir):
    """Adjacency of persons with several equivs (T4)."""
    rows = realtime_rows(spark, sf_dir, kinds=("equiv_pair",))["equivs"]
    return realtime.equiv_adjacency(realtime.latest_per_key(rows, "equivs"))


@register("speed_adjacency_segments", f"""
    WITH pairs AS (SELECT DISTINCT personid1, personid2 FROM ({EQUIV_PAIRS_SQL}))
    SELECT personid1, count(*) AS equivs, string_agg(personid2, ',' ORDER BY personid2) AS neighbours
    FROM pairs GROUP BY 1
""")
def q_speed_adjacency_segments(spark, sf_dir):
    """Every equivalent of every person from segments of two, through the speed layer (T4)."""
    root = work_dir(spark, "speed_adjacency_segments")
    speed_parts(spark, root, td.message_lines(spark, sf_dir, kinds=("equiv_pair",)), range(PARTS))
    segments = realtime.adjacency_segments(speed.read_realtime(spark, f"{root}/rt", "equivs"), size=2)
    return segments.groupBy("personid1").agg(
        F.sum(F.size("neighbours")).cast("bigint").alias("equivs"),
        F.array_join(F.sort_array(F.flatten(F.collect_list("neighbours.personid2"))), ",").alias("neighbours"))


@register("speed_quarantine", f"""
    SELECT coalesce({_reason_case()}, 'bad_url') AS reason, count(*) AS messages
    FROM events WHERE event_type = 'error' GROUP BY 1
""")
def q_speed_quarantine(spark, sf_dir):
    """What the speed layer could not use, bad URLs included, over four micro-batches."""
    root = work_dir(spark, "speed_quarantine")
    speed_parts(spark, root, td.message_lines(spark, sf_dir, kinds=("page", "broken")), range(PARTS))
    return speed.read_quarantine(spark, f"{root}/rt").groupBy("reason").agg(
        F.sum("messages").cast("bigint").alias("messages"))


# --- serving: long lists, dates, empty ranges ---------------------------------------------

@register("count_pageviews_long_list", COUNT_SQL)
def q_count_pageviews_long_list(spark, sf_dir):
    """countpageviews of a list beyond the broadcast bound, with each URL in
    several forms, duplicates and NULLs: one row per distinct URL (W7)."""
    u = page_urls(spark, sf_dir)
    forms = u.unionAll(u.select(F.concat("url", F.lit("?again=1")).alias("url"))).unionAll(u).unionAll(
        u.select(F.lit(None).cast("string").alias("url")))
    return serving.count_pageviews(split_view(spark, sf_dir), realtime_pageview_rows(spark, sf_dir), forms,
                                   RANGE_START, RANGE_END, broadcast_rows=10)


@register("count_pageviews_bucketed", COUNT_SQL)
def q_count_pageviews_bucketed(spark, sf_dir):
    """countpageviews of a list beyond the broadcast bound over a view in 8 buckets: the list
    goes to the buckets, the view is not shuffled (G5, S17)."""
    root = work_dir(spark, "count_bucketed")
    name = "hg_count_" + root.rsplit("-", 1)[-1]
    f = pageview_facts(spark, sf_dir).where(F.col("true_as_of_secs") < BATCH_SPLIT_HOUR * 3600)
    storage.write_view_sharded(views.batch_view(f, with_last_hour=True), name, f"{root}/table", shards=8)
    found = serving.count_pageviews(spark.table(name), realtime_pageview_rows(spark, sf_dir),
                                    page_urls(spark, sf_dir), RANGE_START, RANGE_END, broadcast_rows=10,
                                    buckets=8)
    spark.sql(f"DROP TABLE {name}")     # an external table: its files stay and are read
    return found


@register("count_pageviews_dates", COUNT_SQL.replace(str(RANGE_START), "473592").replace(str(RANGE_END), "473688"))
def q_count_pageviews_dates(spark, sf_dir):
    """countpageviews with ``dd.MM.yyyy|HH`` dates on a 12-hour clock, where
    hour 12 reads as 0 (P11)."""
    return serving.count_pageviews(split_view(spark, sf_dir), realtime_pageview_rows(spark, sf_dir),
                                   page_urls(spark, sf_dir), "11.01.2024|12", "15.01.2024|12", legacy_12h=True)


@register("count_pageviews_empty_range", f"""
    SELECT url, CAST(0 AS BIGINT) AS batch_pageviews, CAST(NULL AS BIGINT) AS hour_done,
           CAST(0 AS BIGINT) AS realtime_pageviews, CAST(0 AS BIGINT) AS pageviews FROM ({URLS_SQL})
""")
def q_count_pageviews_empty_range(spark, sf_dir):
    """A range that ends before it starts counts nothing."""
    return serving.count_pageviews(split_view(spark, sf_dir), realtime_pageview_rows(spark, sf_dir),
                                   page_urls(spark, sf_dir), RANGE_END, RANGE_START)


@register("nonce_per_delivery", f"""
    SELECT CAST(2 * count(*) AS BIGINT) AS facts, CAST(2 * count(*) AS BIGINT) AS nonces FROM ({PV_SQL})
""")
def q_nonce_per_delivery(spark, sf_dir):
    """Every line delivered twice at different queue offsets: as many nonces
    as page-view facts (P12)."""
    lines = td.message_lines(spark, sf_dir, kinds=("pageview",))
    twice = lines.select("value", F.lit("t").alias("topic"), F.lit(0).alias("partition"),
                         F.explode(F.array(2 * F.col("id"), 2 * F.col("id") + 1)).alias("offset"))
    facts = decode.to_facts(decode.parse_messages(twice))
    return facts.agg(F.count(F.lit(1)).alias("facts"), F.count_distinct("page_view.nonce").alias("nonces"))


@register("view_kv_full_key", VIEW_SQL)
def q_view_kv_full_key(spark, sf_dir):
    """Key/value view in shards by the whole key, read back and decoded."""
    root = work_dir(spark, "view_kv_full_key")
    storage.write_view_kv(views.batch_view(pageview_facts(spark, sf_dir)), f"{root}/kv", shards=4, by="key")
    return views.from_key_value(storage.read_view_kv(spark, f"{root}/kv"))


@register("url_edge_cases", r"""
    WITH p AS (SELECT page_id, url, split_part(split_part(split_part(url, '#', 1), '?', 1), '://', 1) AS proto,
                      split_part(split_part(split_part(url, '#', 1), '?', 1), '://', 2) AS rest FROM pages),
    q AS (SELECT *, split_part(rest, '/', 1) AS host, substr(rest, length(split_part(rest, '/', 1)) + 1) AS path FROM p)
    SELECT page_id, 'tab' AS form, proto || '://' || rest AS url FROM q
    UNION ALL SELECT page_id, 'prefix', proto || '://' || rest FROM q
    UNION ALL SELECT page_id, 'upper', proto || '://' || rest FROM q
    UNION ALL SELECT page_id, 'port', proto || '://' || rest FROM q
    UNION ALL SELECT page_id, 'big port', proto || '://' || host || ':2147483648' || path FROM q
    UNION ALL SELECT page_id, 'user', proto || '://' || rest FROM q
    UNION ALL SELECT page_id, 'two users', proto || '://' || path FROM q
    UNION ALL SELECT page_id, 'scheme', 'gopher://' || rest FROM q
""")
def q_url_edge_cases(spark, sf_dir):
    """Page URLs with white space, a ``url:`` prefix, an upper-case protocol,
    ports, user info and an unknown protocol, normalized (P1)."""
    p = td.table(spark, sf_dir, "pages")
    clean = F.regexp_extract("url", "^([^?#]*)", 1)
    proto, rest = F.regexp_extract(clean, "^([^:]*)", 1), F.regexp_replace(clean, "^[^:]*://", "")
    host, path = F.regexp_extract(rest, "^([^/]*)", 1), F.regexp_replace(rest, "^[^/]*", "")
    at = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    forms = {"tab": at("\t ", F.col("url"), " \r\n"), "prefix": at(" URL:", F.col("url")),
             "upper": at(F.upper(proto), "://", rest), "port": at(proto, "://", host, ":2147483647", path),
             "big port": at(proto, "://", host, ":2147483648", path), "user": at(proto, "://u:p@", rest, "?a#b"),
             "two users": at(proto, "://u@v@", rest), "scheme": at("gopher://", rest)}
    rows = p.select("page_id", F.inline(F.array(*[F.struct(F.lit(k).alias("form"), c.alias("raw")) for k, c in forms.items()])))
    return rows.select("page_id", "form", normalize_url("raw").alias("url"))


@register("pedigree_range", f"""
    SELECT 'bad_pedigree' AS reason, 2 * count(*) AS messages FROM ({G.page_rows_sql()})
""")
def q_pedigree_range(spark, sf_dir):
    """Page messages with a timestamp in milliseconds, or beyond any clock, are
    quarantined; their twins at the ends of the 32-bit range are facts (P10)."""
    p = td.table(spark, sf_dir, "pages")
    stamps = F.array(F.concat(F.lit(str(td.BASE_SECS)), F.lpad((F.col("page_id") % 1000).cast("string"), 3, "0")),
                     F.lit("9223372036854775807"), F.lit("2147483647"), F.lit("-2147483648"))
    lines = p.select("url", F.explode(stamps).alias("pedigree")).select(F.to_json(F.struct(
        F.lit("page").alias("messagetype"), "pedigree", "url", F.lit("1").alias("pageview"))).alias("value"))
    return decode.to_quarantine(decode.parse_messages(lines)).groupBy("reason").agg(F.count(F.lit(1)).alias("messages"))
