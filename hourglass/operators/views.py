"""Batch views: pageviews per URL per hour, rolled up to day/week/month.

Plan shape (checked by tests): partition-pruned scan of the page-view facts
-> narrow projection (URL normalization inlined, never materialized) ->
partial_count -> Exchange(url, hour) -> count -> Generate (x4) ->
partial_sum -> Exchange(url, granularity, bucket) -> sum. Both aggregates
combine map-side first, so a URL holding a third of all views reaches the
shuffle as one row per (task, hour), not as its raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass import schemas as S
from hourglass.functions import (
    bucketed_key,
    deserialize_long,
    granularity_buckets,
    hour_bucket,
    key_bucket,
    key_granularity,
    key_url,
    normalize_url, opaque,
    serialize_long,
)


def normalize_facts(facts: DataFrame) -> DataFrame:
    """Rewrite the page URL of page-view and page-property facts.

    Other fact kinds pass through; the partitioning columns are untouched, so
    the result can be written with the same layout.
    """
    pv = F.col("page_view")
    pp = F.col("page_property")
    return facts.withColumn(
        "page_view",
        F.when(pv.isNotNull() & pv["page"]["url"].isNotNull(),
               pv.withField("page.url", normalize_url(pv["page"]["url"]))).otherwise(pv),
    ).withColumn(
        "page_property",
        F.when(pp.isNotNull() & pp["id"]["url"].isNotNull(),
               pp.withField("id.url", normalize_url(pp["id"]["url"]))).otherwise(pp),
    )


def pageview_fields(facts: DataFrame, normalize: bool = True) -> DataFrame:
    """(url, person, secs) of page-view facts whose page is a URL.

    The ``dataunit_id`` predicate becomes a partition filter on a partitioned
    fact dataset, so only page-view files are read.
    """
    url = F.col("page_view.page.url")
    pv = facts.where((F.col("dataunit_id") == S.PAGE_VIEW) & url.isNotNull())
    return pv.select(
        (opaque(normalize_url(url)) if normalize else url).alias("url"),
        F.col("page_view.person").alias("person"),
        F.col("true_as_of_secs").alias("secs"),
    )


def hourly_counts(facts: DataFrame, normalize: bool = True) -> DataFrame:
    """(url, hour_bucket, pageviews): every page-view fact counts (A1).

    No de-duplication: replayed facts are counted again, like the source data.
    """
    pv = pageview_fields(facts, normalize)
    return pv.groupBy("url", hour_bucket(F.col("secs")).alias("hour_bucket")).agg(
        F.count(F.lit(1)).alias("pageviews"))


def rollup_granularities(hourly: DataFrame, count_col: str = "pageviews",
                         with_last_hour: bool = False) -> DataFrame:
    """(url, granularity, bucket, total_pageviews) from hourly counts.

    ``with_last_hour`` also keeps, per row, the last hour with views inside
    its bucket (``last_hour``): the stored view carries it so a serving range
    can be covered by coarse buckets and still know its exact last batch hour.
    """
    g = hourly.select("url", F.col(count_col).alias("_n"), F.col("hour_bucket").alias("_h"),
                      F.inline(granularity_buckets(F.col("hour_bucket"))))
    aggs = [F.sum("_n").cast("bigint").alias("total_pageviews")]
    if with_last_hour:
        aggs.append(F.max("_h").cast("bigint").alias("last_hour"))
    return g.groupBy("url", "granularity", "bucket").agg(*aggs)


def batch_view(facts: DataFrame, normalize: bool = True,
               with_last_hour: bool = False) -> DataFrame:
    """The full batch view of a fact dataset (schema ``BATCH_VIEW``, plus
    ``last_hour`` when asked: the form ``storage.write_view`` stores)."""
    return rollup_granularities(hourly_counts(facts, normalize), with_last_hour=with_last_hour)


def merge_views(old_view: DataFrame, delta_view: DataFrame) -> DataFrame:
    """Additive merge of two views: counts of disjoint fact sets add up
    (``last_hour``, when both carry it, is the later one).

    This is the incremental refresh: the view of the newly absorbed facts is
    added to the existing view instead of recounting the master dataset.
    """
    cols = S.BATCH_VIEW.fieldNames()
    last = "last_hour" in old_view.columns and "last_hour" in delta_view.columns
    if last:
        cols = cols + ["last_hour"]
    both = old_view.select(*cols).unionByName(delta_view.select(*cols))
    aggs = [F.sum("total_pageviews").cast("bigint").alias("total_pageviews")]
    if last:
        aggs.append(F.max("last_hour").cast("bigint").alias("last_hour"))
    return both.groupBy("url", "granularity", "bucket").agg(*aggs)


def to_key_value(view: DataFrame) -> DataFrame:
    """Binary key/value form: UTF-8 ``url/gran-bucket`` -> 8-byte big-endian."""
    return view.select(
        bucketed_key("url", "granularity", "bucket").alias("key"),
        serialize_long("total_pageviews").alias("value"),
    )


def from_key_value(kv: DataFrame) -> DataFrame:
    """Typed view back from the key/value form."""
    return kv.select(
        key_url("key").alias("url"),
        key_granularity("key").alias("granularity"),
        key_bucket("key").alias("bucket"),
        deserialize_long("value").alias("total_pageviews"),
    )
