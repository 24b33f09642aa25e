"""Serving: pageviews of URLs over an inclusive hour range, merging the
batch view with the realtime view in one DataFrame plan.

For each URL the batch view's rows covering [start, end] are summed and the
last hour with batch data (``hour_done``) is kept: hour rows for views
computed on the fly, and whole months, weeks and days plus edge hours for a
stored view read with its layout. The realtime view then covers
(hour_done, end] — or [start, end] when the batch view has nothing in range.
Totals are ``batch + realtime``. URL lists are broadcast when their size is
proven small; otherwise joins shuffle, with hot URLs salted apart.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.functions import normalize_url, opaque
from hourglass.functions.buckets import DAYS_PER_MONTH, HOUR_SECS, HOURS_PER_DAY
from hourglass.operators.joins import (
    DEFAULT_BROADCAST_ROWS, bounded_list, salted_range_join,
)

MODES = ("distinct_seconds", "every_event")


def query_hour(value: int | str, legacy_12h: bool = False) -> int:
    """An hour bucket from an int or a ``dd.MM.yyyy|HH`` string (UTC).

    ``legacy_12h=True`` reads hour 12 as 0 (a 12-hour clock field).
    """
    if isinstance(value, int):
        return value
    day, hour = value.split("|")
    h = int(hour)
    if legacy_12h and h == 12:
        h = 0
    d = _dt.datetime.strptime(day, "%d.%m.%Y").replace(tzinfo=_dt.timezone.utc)
    return (int(d.timestamp()) + h * HOUR_SECS) // HOUR_SECS


# Literal URL lists up to this size are also pushed into the scans as
# ``url IN (...)`` so Parquet min/max statistics skip row groups.
MAX_PUSHED_URLS = 1_000


def _literal_frame(spark, values: list[str]) -> DataFrame:
    """A one-column (url) DataFrame of literals, planned as Range(1) +
    Generate: no RDD, no shuffle, nothing shipped but the literals."""
    structs = [F.struct(F.lit(v).cast("string").alias("url")) for v in values]
    if not structs:
        return spark.range(1).select(F.lit(None).cast("string").alias("url")).where("false")
    return spark.range(1).select(F.inline(F.array(*structs)))


def url_list(urls: DataFrame | list[str], spark=None, normalize: bool = True) -> DataFrame:
    """Distinct (url) query list without NULLs; normalized like the views unless told not to."""
    if isinstance(urls, list):
        lits = literal_urls(urls, spark, normalize)
        if lits is not None:
            return _literal_frame(spark, lits)
        urls = spark.createDataFrame([(u,) for u in urls], "url string")
    u = F.col("url")
    return (urls.where(u.isNotNull())
            .select((opaque(normalize_url(u)) if normalize else u).alias("url")).distinct())


def literal_urls(urls: DataFrame | list[str], spark=None,
                 normalize: bool = True) -> list[str] | None:
    """Distinct normalized URLs of a short literal list (normalized by the same
    column expression, on a one-row local plan); None for DataFrame inputs
    and long lists."""
    if not isinstance(urls, list) or len(urls) > MAX_PUSHED_URLS:
        return None
    raw = [u for u in dict.fromkeys(urls) if u is not None]
    if not normalize or not raw:
        return raw
    f = _literal_frame(spark, raw).select(normalize_url("url").alias("url"))
    return list(dict.fromkeys(r.url for r in f.collect()))


def _restrict(df: DataFrame, lits: list[str] | None) -> DataFrame:
    return df if lits is None else df.where(F.col("url").isin(lits))


def hour_rows(view: DataFrame, start_hour: int, end_hour: int) -> DataFrame:
    """Hour rows of the view in [start, end]; a stored view's ``period``
    partition column (when read with it) prunes to the periods spanned."""
    h = view.where((F.col("granularity") == "h")
                   & F.col("bucket").between(F.lit(start_hour), F.lit(end_hour)))
    if "period" in view.columns:
        h = h.where(F.col("period").between(F.lit(_period("h", start_hour)),
                                            F.lit(_period("h", end_hour))))
    return h


# Bucket sizes in hours, coarsest first: epoch months (28 days), weeks, days,
# hours. Buckets of every level nest exactly inside the next coarser one.
LEVELS = [("m", HOURS_PER_DAY * DAYS_PER_MONTH), ("w", HOURS_PER_DAY * 7),
          ("d", HOURS_PER_DAY), ("h", 1)]
_PER_PERIOD = {"h": HOURS_PER_DAY * DAYS_PER_MONTH, "d": DAYS_PER_MONTH, "w": 4, "m": 1}


def _tdiv(x: int, n: int) -> int:
    return x // n if x >= 0 else -((-x) // n)


def _period(gran: str, bucket: int) -> int:
    """The stored view's period of a bucket (truncating like the view)."""
    return _tdiv(bucket, _PER_PERIOD[gran])


def cover(start_hour: int, end_hour: int, levels=LEVELS) -> list[tuple[str, int, int]]:
    """Disjoint (granularity, first bucket, last bucket) pieces covering the
    hour range [start, end] (start >= 0) with the fewest rows: whole months,
    then whole weeks and days at the edges, hours only at the very ends.

    A year is covered by about 60 rows per URL instead of 8,760.
    """
    if start_hour > end_hour:
        return []
    gran, size = levels[0]
    if size == 1:
        return [("h", start_hour, end_hour)]
    first = -(-start_hour // size) * size          # first bucket starting inside
    last = (end_hour + 1) // size * size - 1       # last hour of the last full bucket
    if first > last:
        return cover(start_hour, end_hour, levels[1:])
    return (cover(start_hour, first - 1, levels[1:])
            + [(gran, first // size, (last + 1) // size - 1)]
            + cover(last + 1, end_hour, levels[1:]))


def _covered_rows(view: DataFrame, start_hour: int, end_hour: int) -> DataFrame:
    """View rows of the cover of [start, end]: one scan, the pieces OR-ed;
    each piece also bounds ``period`` so whole partitions are skipped."""
    cond = None
    for g, lo, hi in cover(start_hour, end_hour):
        c = ((F.col("granularity") == g) & F.col("bucket").between(F.lit(lo), F.lit(hi))
             & F.col("period").between(F.lit(_period(g, lo)), F.lit(_period(g, hi))))
        cond = c if cond is None else (cond | c)
    return view.where(cond if cond is not None else F.lit(False))


def batch_range(view: DataFrame, urls: DataFrame, start_hour: int, end_hour: int,
                small: bool | None = None, literals: list[str] | None = None) -> DataFrame:
    """(url, batch_pageviews, hour_done) for every URL of ``urls``.

    A stored view read with its layout (``last_hour``, ``period``) is read
    through the coarse cover of the range (few rows per URL even for long
    ranges), and ``hour_done`` is the greatest ``last_hour`` of the pieces.
    Other views sum their hour rows. Either way the predicates reach the
    Parquet scan (with ``literals`` also the url), the rows are semi-joined
    with the URL list — broadcast when its size is proven small, else a
    shuffle join — and summed per URL; URLs without batch data get 0 and NULL.
    """
    if small is None:
        small = bounded_list(urls, DEFAULT_BROADCAST_ROWS)
    v = _restrict(view, literals)
    if {"last_hour", "period"} <= set(view.columns) and start_hour >= 0:
        rows, last = _covered_rows(v, start_hour, end_hour), F.col("last_hour")
    else:
        rows, last = hour_rows(v, start_hour, end_hour), F.col("bucket")
    side = F.broadcast(urls) if small else urls
    agg = (rows.join(side, "url", "left_semi")
           .groupBy("url")
           .agg(F.sum("total_pageviews").cast("bigint").alias("batch_pageviews"),
                F.max(last).cast("bigint").alias("hour_done")))
    return urls.join(agg, "url", "left").select(
        "url",
        F.coalesce("batch_pageviews", F.lit(0).cast("bigint")).alias("batch_pageviews"),
        "hour_done",
    )


def realtime_bounds(batch: DataFrame, start_hour: int, end_hour: int,
                    legacy_lower_bound: bool = False) -> DataFrame:
    """``batch`` (url, hour_done, ...) with the realtime hour range lo, hi per URL (Q8/Q9).

    ``legacy_lower_bound=True`` starts at ``hour_done + 1`` with ``hour_done``
    0 when there is no batch data (i.e. at hour 1, before the requested
    start), which is what the original serving code does.
    """
    hd = F.col("hour_done")
    if legacy_lower_bound:
        lo = F.coalesce(hd, F.lit(0)) + 1
    else:
        lo = F.greatest(F.lit(start_hour), F.coalesce(hd + 1, F.lit(start_hour)))
    return batch.select("*", lo.cast("bigint").alias("lo"),
                        F.lit(end_hour).cast("bigint").alias("hi"))


def _in_bounds(rt: DataFrame, bounds: DataFrame, small: bool) -> DataFrame:
    """Realtime rows (url, hour_bucket, secs, events) inside their URL's bounds, with the
    bounds' columns; rows without an hour pass for their URL.

    An equi-join on url plus a range condition; the bounds (one row per queried
    URL) are broadcast when their size is proven small, otherwise the join
    shuffles with hot URLs salted over several tasks (``joins.salted_range_join``).
    """
    if not small:
        salt = "secs" if "secs" in rt.columns else "hour_bucket"
        return salted_range_join(rt, bounds, "url", "hour_bucket", "lo", "hi", salt_of=salt)
    b = F.broadcast(bounds.withColumnRenamed("url", "_bkey"))
    return rt.join(b, (F.col("url") == F.col("_bkey"))
                   & (F.col("hour_bucket").isNull()
                      | F.col("hour_bucket").between(F.col("lo"), F.col("hi")))).drop("_bkey")


def _realtime_columns(rt: DataFrame, literals: list[str] | None) -> DataFrame:
    """Rows per second (``secs``), or per hour already counted (``distinct_seconds``)."""
    ev = F.col("events") if "events" in rt.columns else F.lit(1).cast("bigint")
    seconds = "distinct_seconds" if "distinct_seconds" in rt.columns else "secs"
    return _restrict(rt, literals).select("url", "hour_bucket", seconds, ev.alias("events"))


def merged_counts(rt: DataFrame, urls: DataFrame, bounds: DataFrame, mode: str, small: bool,
                  literals: list[str] | None) -> DataFrame:
    """(url, batch_pageviews, hour_done, realtime_pageviews) per URL of ``bounds``.

    ``distinct_seconds`` counts distinct seconds (the realtime table keeps one
    entry per URL, hour and second, or per URL and hour the number of them); ``every_event`` counts every write, which
    agrees with the batch layer. The batch side travels in ``bounds`` through
    the one join with the realtime rows, so it is evaluated once; an empty row
    per URL of the list keeps URLs without realtime rows.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    n = F.lit(None).cast("bigint")
    seen = _realtime_columns(rt, literals)
    seconds = seen.columns[2]
    rows = seen.unionByName(urls.select(
        "url", n.alias("hour_bucket"), n.alias(seconds), F.lit(0).cast("bigint").alias("events")))
    distinct = F.count_distinct(seconds) if seconds == "secs" else F.coalesce(F.sum(seconds), F.lit(0))
    agg = distinct if mode == "distinct_seconds" else F.sum(F.col("events"))
    return _in_bounds(rows, bounds, small).groupBy("url").agg(
        F.max("batch_pageviews").alias("batch_pageviews"), F.max("hour_done").alias("hour_done"),
        agg.cast("bigint").alias("realtime_pageviews"))


def count_pageviews(view: DataFrame, rt: DataFrame, urls: DataFrame | list[str],
                    start: int | str, end: int | str, mode: str = "distinct_seconds",
                    normalize: bool = True, legacy_lower_bound: bool = False,
                    legacy_12h: bool = False,
                    broadcast_rows: int | None = None, buckets: int | None = None) -> DataFrame:
    """Pageviews per URL in [start, end] hours: batch + realtime.

    Returns (url, batch_pageviews, hour_done, realtime_pageviews, pageviews),
    one row per distinct queried URL. ``start > end`` gives zeros (F5).
    URL lists are broadcast only when proven to have at most
    ``broadcast_rows`` rows (default ``joins.DEFAULT_BROADCAST_ROWS``; 0 never
    broadcasts a DataFrame list). ``buckets`` is the number of URL buckets of a
    ``view`` that is such a table: a longer list is then shuffled to these, the view is not.
    """
    spark = view.sparkSession
    a, b = query_hour(start, legacy_12h), query_hour(end, legacy_12h)
    lits = literal_urls(urls, spark, normalize)
    u = _literal_frame(spark, lits) if lits is not None else url_list(urls, spark, normalize)
    # bounds and per-URL realtime counts have one row per queried URL: one
    # size check covers every join of the plan
    limit = DEFAULT_BROADCAST_ROWS if broadcast_rows is None else broadcast_rows
    small = lits is not None or (limit > 0 and bounded_list(u, limit))
    if buckets and not small:
        u = u.repartition(buckets, "url")   # distinct by now, so no URL is a hot one
    batch = batch_range(view, u, a, b, small, lits)
    bounds = realtime_bounds(batch, a, b, legacy_lower_bound)
    if not legacy_lower_bound:   # lo >= start for every URL: prune statically too
        rt = rt.where(F.col("hour_bucket") >= F.lit(a))
    return merged_counts(rt, u, bounds, mode, small, lits).select(
        "url", "batch_pageviews", "hour_done", "realtime_pageviews",
        (F.col("batch_pageviews") + F.col("realtime_pageviews")).cast("bigint").alias("pageviews"),
    )


def get_pageviews(view: DataFrame, rt: DataFrame, urls: DataFrame | list[str],
                  start: int | str, end: int | str, mode: str = "distinct_seconds",
                  normalize: bool = True, legacy_lower_bound: bool = False,
                  legacy_12h: bool = False,
                  broadcast_rows: int | None = None) -> DataFrame:
    """Detail rows behind ``count_pageviews`` (G2):
    (source, url, hour_bucket, secs, pageviews) — batch hour rows and
    realtime per-second rows (one per distinct second, or per second with its
    event count in ``every_event`` mode)."""
    spark = view.sparkSession
    a, b = query_hour(start, legacy_12h), query_hour(end, legacy_12h)
    lits = literal_urls(urls, spark, normalize)
    u = _literal_frame(spark, lits) if lits is not None else url_list(urls, spark, normalize)
    limit = DEFAULT_BROADCAST_ROWS if broadcast_rows is None else broadcast_rows
    small = lits is not None or (limit > 0 and bounded_list(u, limit))
    ub = F.broadcast(u) if small else u
    if not legacy_lower_bound:
        rt = rt.where(F.col("hour_bucket") >= F.lit(a))
    # The hour rows serve twice, as result rows and for each URL's last hour. Both uses
    # read the same shuffled columns (no row has zero views), so the exchange is reused
    # and the view is scanned once.
    hours = (hour_rows(_restrict(view, lits), a, b).join(ub, "url", "left_semi")
             .select("url", "bucket", "total_pageviews").repartition("url"))
    last = hours.groupBy("url").agg(
        F.max(F.when(F.col("total_pageviews") > 0, F.col("bucket"))).cast("bigint").alias("hour_done"))
    bounds = realtime_bounds(u.join(last, "url", "left"), a, b, legacy_lower_bound).drop("hour_done")
    brows = hours.select(F.lit("batch").alias("source"), "url",
                         F.col("bucket").alias("hour_bucket"),
                         F.lit(None).cast("bigint").alias("secs"),
                         F.col("total_pageviews").alias("pageviews"))
    rrows = (_in_bounds(_realtime_columns(rt, lits), bounds, small).groupBy("url", "hour_bucket", "secs")
             .agg(F.sum(F.col("events")).alias("_n"))
             .select(F.lit("realtime").alias("source"), "url", "hour_bucket", "secs",
                     (F.lit(1) if mode == "distinct_seconds" else F.col("_n"))
                     .cast("bigint").alias("pageviews")))
    return brows.unionByName(rrows)
