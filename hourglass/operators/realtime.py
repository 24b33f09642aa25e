"""Realtime views in batch form (the streaming jobs share these projections).

* pageviews: one row per (url, hour_bucket, secs) — a later view in the same
  second overwrites the person (last write wins); counting rows counts
  distinct seconds.
* pages / persons: the latest version per key.
* equivs: per (personid1, personid2) the latest pedigree; the adjacency of a
  person is the set of its rows, summarized by ``equiv_adjacency`` or held
  whole in bounded rows by ``adjacency_segments``.

"Latest" is ordered by (event seconds, arrival, values): of versions with the same
second the one that arrived in the later micro-batch wins (one batch has one
arrival), and of those the greatest values, so a replay gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass.operators.joins import DEFAULT_BROADCAST_ROWS, DEFAULT_SALTS, bounded_list

RT_KEYS = {
    "pageviews": ["url", "hour_bucket", "secs"],
    "pages": ["url"],
    "persons": ["personid"],
    "equivs": ["personid1", "personid2"],
}
RT_VALUES = {
    "pageviews": ["personid"],
    "pages": ["pedigree", "pageview"],
    "persons": ["pedigree", "gendertype", "fullname", "city", "state", "country"],
    "equivs": ["pedigree"],
}


def version_order(rows: DataFrame, table: str) -> Column:
    """What versions of a key are ordered by; ``arrival`` counts if rows have it."""
    arrival = [F.col("arrival")] if "arrival" in rows.columns else []
    return F.struct(F.col("secs"), *arrival, *[F.col(v) for v in RT_VALUES[table]])


def latest_per_key(rows: DataFrame, table: str) -> DataFrame:
    """Last-write-wins upsert of keyed rows: one row per key, values of the
    version with the greatest order.

    ``max_by`` is an ordinary aggregate: partial per task, then merged after
    the shuffle, so a hot key is reduced map-side and never gathered.
    """
    keys, vals = RT_KEYS[table], RT_VALUES[table]
    order = version_order(rows, table)
    latest = F.max_by(F.struct(*[F.col(v) for v in vals]), order).alias("_v")
    out = rows.groupBy(*keys).agg(latest)
    return out.select(*keys, *[F.col("_v")[v].alias(v) for v in vals])


def pageview_table(rows: DataFrame) -> DataFrame:
    """(url, hour_bucket, secs, personid, events): the realtime pageview
    table; ``events`` counts the writes each entry absorbed."""
    keys = RT_KEYS["pageviews"]
    order = version_order(rows, "pageviews")
    out = rows.groupBy(*keys).agg(F.max_by(F.col("personid"), order).alias("personid"),
                                  F.count(F.lit(1)).alias("events"))
    return out


def equiv_adjacency(equivs: DataFrame) -> DataFrame:
    """Per person: how many equivalent ids it has and the first and last of
    them (``personid1, equivs, first_personid2, last_personid2``).

    The adjacency itself is the set of ``equivs`` rows keyed by personid1; it
    is never gathered into one array, so a person with millions of
    equivalents stays a streaming aggregate (partial count/min/max per task).
    """
    return equivs.groupBy("personid1").agg(
        F.count(F.lit(1)).alias("equivs"),
        F.min("personid2").alias("first_personid2"),
        F.max("personid2").alias("last_personid2"))


#: Equivalents of one person in a row of the adjacency, on average at most.
SEGMENT = 1024


def adjacency_segments(equivs: DataFrame, size: int = SEGMENT,
                       broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """The adjacency whole: (personid1, segment, segments, neighbours), where
    ``neighbours`` are (personid2, pedigree) sorted by id.

    A person with more than ``size`` equivalents gets ceil(n / size) segments, and
    the hash of an equivalent's id says which one it is in, so a row has about
    ``size`` of them however many the person has, and all segments of a hot
    person are built apart. Degrees of persons above ``size`` (at most rows / size
    of them) are broadcast when measured to be few, else joined by salts.
    """
    many = equivs.groupBy("personid1").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > size) \
        .select(F.col("personid1").alias("_person"), F.ceil(F.col("n") / size).cast("int").alias("segments"))
    if broadcast_rows and bounded_list(many.select(F.col("_person").alias("url")), broadcast_rows):
        told = equivs.join(F.broadcast(many), F.col("personid1") == F.col("_person"), "left")
    else:
        salt = F.pmod(F.xxhash64("personid2"), F.lit(DEFAULT_SALTS)).cast("int")
        salted = many.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(DEFAULT_SALTS - 1))))
        told = equivs.withColumn("_salt", salt).join(
            salted, (F.col("personid1") == F.col("_person")) & (F.col("_salt") == F.col("_s")), "left")
    parts = F.coalesce("segments", F.lit(1))
    told = told.select("personid1", "personid2", "pedigree", parts.alias("segments"),
                       F.pmod(F.xxhash64("personid2", F.lit(1)), parts).cast("int").alias("segment"))
    return told.groupBy("personid1", "segment", "segments").agg(
        F.sort_array(F.collect_list(F.struct("personid2", "pedigree"))).alias("neighbours")) \
        .select("personid1", "segment", "segments", "neighbours")


def explode_segments(segments: DataFrame) -> DataFrame:
    """The rows (personid1, personid2, pedigree) of an adjacency."""
    return segments.select("personid1", F.inline("neighbours"))


def distinct_second_counts(rows: DataFrame) -> DataFrame:
    """(url, hour_bucket, pageviews) counting distinct seconds per hour."""
    return rows.groupBy("url", "hour_bucket").agg(
        F.count_distinct("secs").alias("pageviews"))
