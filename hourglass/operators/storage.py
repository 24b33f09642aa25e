"""Batch storage: new data, plain fact datasets, view sinks. The master dataset is in ``master``.

* Views (S17, R6, R7): written partitioned by (granularity, period),
  range-partitioned and sorted by URL inside, so granularity and time
  predicates prune partitions and URL and bucket predicates prune row
  groups; or as a bucketed table / key-value shards with all buckets of a
  URL together.
* View store: partitions live in numbered generations; a small versioned file
  says which generation holds each partition and which runs are counted. A
  rebuild or refresh writes only new folders and then the next version, so
  readers always have a whole view and a repeated run changes nothing. Each
  version has an index of its files (``file_index``) for lookups of literal URLs.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from hourglass import schemas as S
from hourglass.functions import bucketed_key, serialize_long, view_period
from hourglass.operators import file_index, views
from hourglass.session import delete_folder, list_names, path_exists, read_json, write_json
from hourglass.sources import facts as FS

NEW_DATA_READ = S.NEW_DATA  # partition columns are part of the declared schema


def read_new_data(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a new-data sink (facts and quarantine) that no finished run has consumed
    and ``master.drop_consumed`` removed."""
    r = spark.read.schema(NEW_DATA_READ)
    if path_exists(spark, f"{path}/_consumed.json"):
        r = r.option("ignoreMissingFiles", "true")
    return r.parquet(path)


def read_new_facts(spark: SparkSession, path: str) -> DataFrame:
    """Facts of a new-data sink (partition filter drops the quarantine)."""
    return read_new_data(spark, path).where(
        F.col("dataunit_id") != S.QUARANTINE_DATAUNIT_ID).select(*S.FACT_COLUMNS)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return read_new_data(spark, path).where(
        F.col("dataunit_id") == S.QUARANTINE_DATAUNIT_ID).select("raw", "reason")


def compact(spark: SparkSession, src_path: str, dst_path: str) -> None:
    """Rewrite a fact dataset into ``dst_path`` with few, large files.

    ``dst_path`` is a new generation; readers switch to it once written.
    """
    f = FS.read_facts(spark, src_path)
    f.hint("rebalance", *S.PARTITION_COLUMNS).write.mode("overwrite") \
        .partitionBy(*S.PARTITION_COLUMNS).parquet(dst_path)


def normalize_master(spark: SparkSession, src_path: str, dst_path: str) -> None:
    """Materialized URL normalization of a whole fact dataset (R8); the view
    build normally inlines the normalization instead."""
    FS.write_facts(views.normalize_facts(FS.read_facts(spark, src_path)), dst_path,
                   mode="overwrite")


# --- view sinks ----------------------------------------------------------------------

VIEW_LAYOUT = ["granularity", "period"]
STORED_VIEW = StructType(S.BATCH_VIEW.fields + [StructField("last_hour", LongType()),
                                                StructField("period", LongType())])


def with_period(view: DataFrame) -> DataFrame:
    return view.withColumn("period", view_period("granularity", "bucket"))


def write_view(view: DataFrame, path: str, files_per_granularity: int | None = None,
               mode: str = "overwrite", dynamic: bool = False) -> None:
    """Batch view (with ``last_hour``, see ``views.batch_view``) as Parquet
    partitioned by (granularity, period), sorted by (url, bucket) inside.

    ``period`` is the 28-day epoch month of the bucket: serving ranges prune
    to the periods they span, refreshes rewrite only the periods they touch.
    Range partitioning by (granularity, period, url) gives each task one
    contiguous slice, so files hold disjoint URL ranges (row-group pruning for
    URL lookups) and a task writes few files. Without ``files_per_granularity``
    AQE sizes the ranges. ``dynamic=True`` replaces only the partitions
    present in ``view``.
    """
    if "last_hour" not in view.columns:
        raise ValueError("the stored view needs last_hour: build it with "
                         "views.batch_view(..., with_last_hour=True)")
    v = with_period(view.select(*S.BATCH_VIEW.fieldNames(), "last_hour"))
    if files_per_granularity:
        ranged = v.repartitionByRange(files_per_granularity * len(S.GRANULARITIES),
                                      *VIEW_LAYOUT, "url")
    else:
        ranged = v.repartitionByRange(*VIEW_LAYOUT, "url")
    w = ranged.sortWithinPartitions(*VIEW_LAYOUT, "url", "bucket").write.mode(mode)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.partitionBy(*VIEW_LAYOUT).parquet(path)


def read_view(spark: SparkSession, path: str, keep_layout: bool = False) -> DataFrame:
    """The stored view (schema ``BATCH_VIEW``); ``keep_layout=True`` keeps
    ``last_hour`` and the ``period`` partition column, which serving uses to
    cover ranges with coarse buckets and to prune periods."""
    df = spark.read.schema(STORED_VIEW).parquet(path)
    cols = S.BATCH_VIEW.fieldNames() + (["last_hour", "period"] if keep_layout else [])
    return df.select(*cols)


def write_view_sharded(view: DataFrame, table: str, path: str, shards: int = 4) -> None:
    """Batch view as a bucketed table: ``shards`` hash buckets on url (R7), one
    file each, sorted by (url, granularity, bucket). Joins on url against another
    table bucketed the same way need no shuffle.

    A view with ``last_hour`` keeps it and its ``period``, so ``spark.table(table)`` can be
    served as it is: with ``serving.count_pageviews(..., buckets=shards)`` a URL list beyond
    the broadcast bound is shuffled to the view's buckets, and the view is not shuffled. Choose ``shards`` by the view's size: each is
    written, and joined, by one task."""
    v = with_period(view) if "last_hour" in view.columns else view
    (v.repartition(shards, "url").write.mode("overwrite").option("path", path)
     .bucketBy(shards, "url").sortBy("url", "granularity", "bucket")
     .saveAsTable(table))


def write_view_kv(view: DataFrame, path: str, shards: int, by: str = "url") -> None:
    """Key/value form in ``shards`` files, keys sorted inside each shard. Choose
    ``shards`` by the view's size: each is written by one task.

    ``by="url"`` puts all keys of one URL in the same shard (url-only
    sharding, R7: a URL's buckets are read from one file); ``by="key"``
    hashes the full key (R6), spreading one URL's buckets over shards.
    """
    if by not in ("url", "key"):
        raise ValueError("by must be 'url' or 'key'")
    kv = view.select(
        F.col("url").alias("_url"),
        bucketed_key("url", "granularity", "bucket").alias("key"),
        serialize_long("total_pageviews").alias("value"),
    )
    (kv.repartition(shards, "_url" if by == "url" else "key")
     .sortWithinPartitions("key").drop("_url")
     .write.mode("overwrite").parquet(path))


def read_view_kv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.BATCH_VIEW_KV).parquet(path)


def refresh_view(spark: SparkSession, view_path: str, new_facts: DataFrame,
                 out_path: str) -> None:
    """Incremental refresh as a new generation: old view + view of the new
    facts (counts are additive over disjoint fact sets)."""
    merged = views.merge_views(read_view(spark, view_path, keep_layout=True),
                               views.batch_view(new_facts, with_last_hour=True))
    write_view(merged, out_path)


# --- the view store -----------------------------------------------------------------------

def current_view(spark: SparkSession, root: str) -> dict | None:
    """The newest version of a view store: ``partitions`` (folder -> generation),
    ``runs`` counted, ``version``; None if there is none."""
    names = [n for n in list_names(spark, root) if n.startswith("_view-")]
    return read_json(spark, f"{root}/{names[-1]}") if names else None


def _partition_rows(spark: SparkSession, root: str, partitions: dict[str, int]) -> DataFrame:
    paths = [f"{root}/generation={g}/{part}" for part, g in sorted(partitions.items())]
    return spark.read.schema(STORED_VIEW).option("basePath", root).parquet(*paths)


def _read_partitions(spark: SparkSession, root: str, partitions: dict[str, int]) -> DataFrame:
    if not partitions:
        return spark.createDataFrame([], STORED_VIEW)
    return _partition_rows(spark, root, partitions).select(*STORED_VIEW.fieldNames())


def read_current_view(spark: SparkSession, root: str, keep_layout: bool = False) -> DataFrame:
    """The view a store holds now; a plain view folder is read as it is."""
    now = current_view(spark, root)
    if now is None:
        return read_view(spark, root, keep_layout)
    cols = S.BATCH_VIEW.fieldNames() + (["last_hour", "period"] if keep_layout else [])
    return _read_partitions(spark, root, now["partitions"]).select(*cols)


def read_view_of(spark: SparkSession, root: str, urls: list[str],
                 pieces: list[tuple[str, int, int]]) -> DataFrame:
    """The part of a store's view that can hold ``urls`` in ``pieces`` (granularity, first
    bucket, last bucket), read with its layout: the files that the index names. Rows of
    other URLs and buckets are still among it. A view without an index is read as it is."""
    now = current_view(spark, root)
    if now is None or not file_index.has_index(spark, root, now["version"]):
        return read_current_view(spark, root, keep_layout=True)
    files = file_index.find_files(spark, root, now["version"], urls, pieces)
    if files is None:
        return read_current_view(spark, root, keep_layout=True)
    if not files:
        return spark.createDataFrame([], STORED_VIEW)
    return spark.read.schema(STORED_VIEW).option("basePath", root).parquet(*files) \
        .select(*STORED_VIEW.fieldNames())


def _written_partitions(spark: SparkSession, path: str) -> list[str]:
    """(granularity, period) folders of a written view, by listing."""
    return [f"{g}/{p}" for g in list_names(spark, path) if g.startswith("granularity=")
            for p in list_names(spark, f"{path}/{g}") if p.startswith("period=")]


def _index(spark: SparkSession, root: str, version: int, partitions: dict[str, int],
           before: int | None = None) -> None:
    """Index the files of a new version: those it wrote are read (URL and bucket columns
    only), the others are taken over from the index of the version ``before``."""
    found = []
    if before is not None and file_index.has_index(spark, root, before):
        fresh = {p: g for p, g in partitions.items() if g == version}
        place = F.concat_ws("/", F.concat(F.lit("granularity="), "granularity"),
                            F.concat(F.lit("period="), F.col("period").cast("string")))
        found.append(file_index.read_index(spark, root, before).where(~place.isin(list(fresh))))
    else:
        fresh = partitions
    if fresh:
        found.append(file_index.files_of(_partition_rows(spark, root, fresh)))
    file_index.write_index(spark, root, version, found)


def _publish(spark: SparkSession, root: str, version: int, partitions: dict[str, int],
             runs: list[str], before: int | None = None) -> None:
    _index(spark, root, version, partitions, before)
    write_json(spark, f"{root}/_view-{version:08d}.json",
               {"version": version, "partitions": partitions, "runs": sorted(set(runs))})
    drop_unreferenced(spark, root)


def rebuild_view(spark: SparkSession, root: str, facts: DataFrame, runs: list[str],
                 files_per_granularity: int | None = None) -> None:
    """Build the view of ``facts`` as a new generation, then switch to it."""
    now = current_view(spark, root)
    version = 1 if now is None else now["version"] + 1
    path = f"{root}/generation={version}"
    write_view(views.batch_view(facts, with_last_hour=True), path, files_per_granularity)
    _publish(spark, root, version, dict.fromkeys(_written_partitions(spark, path), version), runs)


def refresh_current_view(spark: SparkSession, root: str, new_facts: DataFrame,
                         runs: list[str]) -> list[tuple[str, int]]:
    """Add the view of ``new_facts`` (absorbed by ``runs``) to a store's view;
    returns the (granularity, period) partitions rewritten.

    The delta view is aggregated and written once; its folders say which
    partitions it touches. Old rows of just those are read, merged with it and
    written once, into a new generation; the other partitions stay where they
    are. The switch is one small file: a run killed before it is repeated from
    the start, one killed after it is finished.
    """
    now = current_view(spark, root)
    version = now["version"] + 1
    staged = f"{root}/_delta-{version}"
    write_view(views.batch_view(new_facts, with_last_hour=True), staged)
    touched = _written_partitions(spark, staged)
    if touched:
        delta = read_view(spark, staged, keep_layout=True)
        old = _read_partitions(spark, root, {p: now["partitions"][p] for p in touched if p in now["partitions"]})
        write_view(views.merge_views(old, delta), f"{root}/generation={version}")
    _publish(spark, root, version, now["partitions"] | dict.fromkeys(touched, version),
             now["runs"] + runs, before=now["version"])
    delete_folder(spark, staged)
    parts = [re.fullmatch("granularity=(.*)/period=(.*)", p) for p in touched]
    return [(m[1], int(m[2])) for m in parts]


def drop_unreferenced(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Remove partitions that none of the last ``keep`` versions refers to, so a
    reader that began under the version before still finds its files."""
    names = [n for n in list_names(spark, root) if n.startswith("_view-")]
    kept = [read_json(spark, f"{root}/{n}") for n in names[-keep:]]
    used = {f"generation={g}/{p}" for v in kept for p, g in v["partitions"].items()}
    newest = kept[-1]["version"]
    for g in list_names(spark, root):
        if g.startswith("generation=") and int(g.split("=")[1]) <= newest:
            parts = [f"{g}/{p}" for p in _written_partitions(spark, f"{root}/{g}")]
            gone = [p for p in parts if p not in used]
            if len(gone) == len(parts):
                delete_folder(spark, f"{root}/{g}")
            else:
                for p in gone:
                    delete_folder(spark, f"{root}/{p}")
    for n in names[:-keep]:
        delete_folder(spark, f"{root}/{n}")
    indexed = {file_index.index_path(root, v["version"]) for v in kept}
    for n in list_names(spark, root):
        if n.startswith("_files-") and n < f"_files-{newest:08d}" and f"{root}/{n}" not in indexed:
            delete_folder(spark, f"{root}/{n}")
