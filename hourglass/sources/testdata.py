"""Stand-in inputs built from the driver's test tables.

These functions only *shape* rows of the test tables into the inputs the
jobs expect (JSON queue messages, fact rows); they do none of the jobs' work.
Every row of the source tables is used: each view/click event becomes a
pageview message on one of *all* pages, every page a page message, every
customer a person message, every event user an equiv message, and every error
event a deliberately broken message.

Shaping rules (the DuckDB oracles in ``hourglass.plans.catalog`` state the
same rules in SQL):
  pageview  event e of type view/click visits page ``(e.event_id div 2) mod
            count(pages)``; odd event ids append ``?article=1`` so two raw
            variants of a page share one normalized URL; person ``cookie_<user>``
            when ``event_id mod 3 = 0`` else ``<user>``; pedigree = epoch secs of
            ``ts`` (``coarse=True``: rounded down to 10 minutes).
  page      url, pageview = 1 + page_id mod 2, pedigree = 1704067200 + page_id.
  person    customer x nation x region; id ``cookie_<custkey>`` when even;
            gender MALE for odd keys, 'other' every 7th key, else FEMALE; city =
            segment, state = nation, country = region; keys divisible by 5 get
            a second, later version (name || '-v2').
  equiv     per event user: user id ~ ``cookie_<user>``, earliest second.
  equiv_pair  per signup and purchase event: user id ~ ``cookie_<event_id mod 7>``.
  broken    error events, kind by ``event_id mod 8`` (see ``BROKEN_KINDS``).
Valid lines are wrapped in ``messages`` envelopes with a trailing comma for
every other block of ten ids, like the producer that motivated the clean-up;
broken lines stay single.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.functions import epoch_secs, idiv

# Fixed values of the stand-in data.
BASE_SECS = 1704067200          # 2024-01-01 00:00:00 UTC
LATER_SECS = 1704167200         # pedigree base of second person versions
ENVELOPE_BLOCK = 10             # ids per envelope
COARSE_SECS = 600               # coarse pageviews: 10-minute resolution
BROKEN_KINDS = [
    "not_json",                 # event_id mod 8 = 0
    "missing_messagetype",      # 1
    "unknown_messagetype",      # 2
    "bad_pedigree",             # 3
    "bad_personid",             # 4
    "bad_pageview",             # 5
    "missing_gendertype",       # 6
    "bad_url",                  # 7: valid for the batch path, quarantined by the speed path
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def pageview_rows(spark: SparkSession, sf_dir: str, coarse: bool = False) -> DataFrame:
    """(event_id, raw_url, secs, personid) of every view/click event."""
    events = table(spark, sf_dir, "events").where(F.col("event_type").isin("view", "click"))
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    n_pages = pages.count()
    j = events.join(pages, F.pmod(idiv(F.col("event_id"), 2), F.lit(n_pages)) == F.col("page_id"))
    secs = epoch_secs(F.col("ts"))
    if coarse:
        secs = idiv(secs, COARSE_SECS) * COARSE_SECS
    return j.select(
        "event_id",
        F.concat(F.col("url"),
                 F.when(F.col("event_id") % 2 == 1, F.lit("?article=1")).otherwise(F.lit(""))
                 ).alias("raw_url"),
        secs.cast("bigint").alias("secs"),
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("cookie_"), _s(F.col("user_id"))))
        .otherwise(_s(F.col("user_id"))).alias("personid"),
    )


def pageview_messages(spark: SparkSession, sf_dir: str, coarse: bool = False) -> DataFrame:
    """(id, msg) JSON pageview messages."""
    r = pageview_rows(spark, sf_dir, coarse)
    return r.select(
        F.col("event_id").alias("id"),
        F.to_json(F.struct(
            F.lit("pageview").alias("messagetype"),
            _s(F.col("secs")).alias("pedigree"),
            F.col("personid").alias("personid"),
            F.col("raw_url").alias("pageid"),
        )).alias("msg"),
    )


def page_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    return p.select(
        F.col("page_id").alias("id"),
        F.to_json(F.struct(
            F.lit("page").alias("messagetype"),
            _s(F.lit(BASE_SECS) + F.col("page_id")).alias("pedigree"),
            F.col("url").alias("url"),
            _s(1 + F.col("page_id") % 2).alias("pageview"),
        )).alias("msg"),
    )


def person_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    k = F.col("c_custkey")
    base = j.select(
        k.alias("id"),
        F.when(k % 2 == 0, F.concat(F.lit("cookie_"), _s(k))).otherwise(_s(k)).alias("personid"),
        F.when(k % 7 == 0, F.lit("other")).when(k % 2 == 1, F.lit("MALE"))
        .otherwise(F.lit("FEMALE")).alias("gendertype"),
        F.col("c_name").alias("fullname"),
        F.col("c_mktsegment").alias("city"),
        F.col("n_name").alias("state"),
        F.col("r_name").alias("country"),
        (F.lit(BASE_SECS) + k).alias("secs"),
    )
    later = base.where(F.col("id") % 5 == 0).select(
        "id", "personid", "gendertype",
        F.concat(F.col("fullname"), F.lit("-v2")).alias("fullname"),
        "city", "state", "country",
        (F.lit(LATER_SECS) + F.col("id")).alias("secs"),
    )
    return base.unionByName(later)


def person_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = person_rows(spark, sf_dir)
    return p.select(
        "id",
        F.to_json(F.struct(
            F.lit("person").alias("messagetype"),
            _s(F.col("secs")).alias("pedigree"),
            "personid", "gendertype", "fullname", "city", "state", "country",
        )).alias("msg"),
    )


def equiv_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    u = e.groupBy("user_id").agg(F.min(epoch_secs(F.col("ts"))).alias("secs"))
    return u.select(
        F.col("user_id").alias("id"),
        F.to_json(F.struct(
            F.lit("equiv").alias("messagetype"),
            _s(F.col("secs")).alias("pedigree"),
            _s(F.col("user_id")).alias("personid1"),
            F.concat(F.lit("cookie_"), _s(F.col("user_id"))).alias("personid2"),
        )).alias("msg"),
    )


def equiv_pair_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per signup or purchase event: user id ~ ``cookie_<event_id mod 7>`` at the event's
    second, so a person has several equivs and a pair several versions."""
    e = table(spark, sf_dir, "events").where(F.col("event_type").isin("signup", "purchase"))
    return e.select(
        F.col("event_id").alias("id"),
        F.to_json(F.struct(
            F.lit("equiv").alias("messagetype"),
            _s(epoch_secs(F.col("ts"))).alias("pedigree"),
            _s(F.col("user_id")).alias("personid1"),
            F.concat(F.lit("cookie_"), _s(F.col("event_id") % 7)).alias("personid2"),
        )).alias("msg"),
    )


def broken_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One deliberately broken message per error event (kind = event_id mod 8)."""
    e = table(spark, sf_dir, "events").where(F.col("event_type") == "error")
    k = F.col("event_id") % 8
    secs = _s(epoch_secs(F.col("ts")))
    uid = _s(F.col("user_id"))
    msg = (
        F.when(k == 0, F.concat(F.lit("garbage "), uid))
        .when(k == 1, F.to_json(F.struct(secs.alias("pedigree"), uid.alias("personid"))))
        .when(k == 2, F.to_json(F.struct(F.lit("click").alias("messagetype"),
                                         secs.alias("pedigree"))))
        .when(k == 3, F.to_json(F.struct(F.lit("pageview").alias("messagetype"),
                                         F.concat(F.lit("t"), secs).alias("pedigree"),
                                         uid.alias("personid"),
                                         F.lit("http://x.example.com/a").alias("pageid"))))
        .when(k == 4, F.to_json(F.struct(F.lit("pageview").alias("messagetype"),
                                         secs.alias("pedigree"),
                                         F.concat(F.lit("user-"), uid).alias("personid"),
                                         F.lit("http://x.example.com/b").alias("pageid"))))
        .when(k == 5, F.to_json(F.struct(F.lit("page").alias("messagetype"),
                                         secs.alias("pedigree"),
                                         F.lit("http://x.example.com/c").alias("url"),
                                         F.lit("many").alias("pageview"))))
        .when(k == 6, F.to_json(F.struct(F.lit("person").alias("messagetype"),
                                         secs.alias("pedigree"),
                                         uid.alias("personid"),
                                         F.lit("N N").alias("fullname"))))
        .otherwise(F.to_json(F.struct(F.lit("pageview").alias("messagetype"),
                                      secs.alias("pedigree"),
                                      uid.alias("personid"),
                                      F.concat(F.lit("bad url "), uid).alias("pageid"))))
    )
    return e.select(F.col("event_id").alias("id"), msg.alias("msg"))


def wrap_lines(msgs: DataFrame, kind: str) -> DataFrame:
    """(value, kind, id) lines: every other block of ten ids becomes one
    ``messages`` envelope (with the trailing comma), the rest stay single."""
    block = idiv(F.col("id"), ENVELOPE_BLOCK)
    single = msgs.where(block % 2 == 0).select(
        F.col("msg").alias("value"), F.lit(kind).alias("kind"), F.col("id"))
    grouped = (
        msgs.where(block % 2 == 1)
        .groupBy(block.alias("blk"))
        .agg(F.array_sort(F.collect_list(F.struct("id", "msg"))).alias("ms"))
        .select(
            F.concat(F.lit('{"messagetype": "messages","messages":['),
                     F.array_join(F.transform("ms", lambda x: x["msg"]), ","),
                     F.lit(",]}")).alias("value"),
            F.lit(kind).alias("kind"),
            (F.col("blk") * ENVELOPE_BLOCK).alias("id"),
        )
    )
    return single.unionByName(grouped)


def message_lines(spark: SparkSession, sf_dir: str, kinds=("pageview", "page", "person",
                                                              "equiv", "broken"),
                  coarse: bool = False) -> DataFrame:
    """All stand-in queue lines: (value, kind, id)."""
    builders = {
        "pageview": lambda: pageview_messages(spark, sf_dir, coarse),
        "page": lambda: page_messages(spark, sf_dir),
        "person": lambda: person_messages(spark, sf_dir),
        "equiv": lambda: equiv_messages(spark, sf_dir),
        "equiv_pair": lambda: equiv_pair_messages(spark, sf_dir),
        "broken": lambda: broken_messages(spark, sf_dir),
    }
    out = None
    for k in kinds:
        if k == "broken":   # a non-JSON element would spoil a whole envelope
            w = builders[k]().select(F.col("msg").alias("value"), F.lit(k).alias("kind"), "id")
        else:
            w = wrap_lines(builders[k](), k)
        out = w if out is None else out.unionByName(w)
    return out
