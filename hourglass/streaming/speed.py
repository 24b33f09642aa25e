"""Speed layer (T1-T4, S19, J2): queue lines -> four realtime tables in ONE
streaming query, with no streaming state.

Every decoded message becomes one keyed row (no union, no per-table re-scan
of the source): ``tbl`` names its table, ``k1, k2, n1, n2`` hold the table's
key and ``v`` its values:

* pageviews  key (url, hour_bucket, secs), value personid;
* pages      key (url), values pedigree, pageview;
* persons    key (personid), values pedigree, gendertype, fullname, city,
             state, country;
* equivs     key (personid1, personid2), value pedigree.

Each micro-batch is aggregated on its own in ``foreachBatch`` (per key the
version with the greatest ``(event seconds, values)`` and the number of
writes) and written to ``<root>/batch_id=<n>/tbl=<table>`` with overwrite,
so a retried batch replaces its own output (idempotent). Messages that cannot
be used become rows of the table ``quarantine`` in the same write, keyed by
(reason, text) with their number. Versions of several batches are ordered by
``(event seconds, batch, values)``. Both merges are associative, so merging
the batch outputs when reading (``read_realtime``) or compacting
(``compact_realtime``) gives exactly what a stateful aggregation would,
without a state store that grows with keys x seconds, and late messages are
merged, never dropped.

Two more tables come with the same write: ``quarantine`` (above) and ``hours``, one row
per (url, hour) with a bitmap of the seconds that had a view. Bitmaps are exact and
merge by OR (``bitmap_or_agg``), so counts need a row per hour, not per second.

Rows lie in hash buckets of their first key (``bucket=<n>``), sorted by key, with Parquet
bloom filters on it: a lookup of literal keys opens only their buckets' files.

Only batch folders with a ``_SUCCESS`` file count. A snapshot folds batches up
to an id kept beside its rows (``_folded.json``); readers list the folders and
open only later ones. Folded folders may be removed (``remove_folded``) once snapshots of
all tables, the quarantine too, hold them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (
    BinaryType, IntegerType, LongType, StringType, StructField, StructType,
)

from hourglass.functions import hour_bucket, normalize_url
from hourglass.operators import decode
from hourglass.operators.realtime import RT_KEYS, RT_VALUES
from hourglass.session import delete_folder, list_names, path_exists, read_json, write_json

TABLES = ("pageviews", "pages", "persons", "equivs")
TABLE_OF_TYPE = {"pageview": "pageviews", "page": "pages", "person": "persons",
                 "equiv": "equivs"}
QUARANTINE, HOURS = "quarantine", "hours"
#: What a snapshot is needed of before batches may go.
FOLDED = TABLES + (HOURS, QUARANTINE)
KEYS = RT_KEYS | {HOURS: ["url", "hour_bucket"], QUARANTINE: ["reason", "raw"]}
VALUES = RT_VALUES | {HOURS: [], QUARANTINE: []}
# Columns that add up, or merge, besides the last version's values.
MERGED = {"pageviews": {"events": F.sum}, QUARANTINE: {"messages": F.sum},
          HOURS: {"seconds": F.bitmap_or_agg, "events": F.sum}}
#: Hash buckets of a store; a lookup reads one of them. Fixed when a store is begun.
BUCKETS = 8
VALUE_FIELDS = ["personid", "pedigree", "pageview", "gendertype", "fullname", "city",
                "state", "country"]
# Stored generic rows (partition columns batch_id and tbl included): read
# with this schema, never inferred.
GENERIC = StructType([
    StructField("k1", StringType()), StructField("k2", StringType()),
    StructField("n1", LongType()), StructField("n2", LongType()),
    StructField("v", StructType([StructField(c, StringType()) for c in VALUE_FIELDS])),
    StructField("secs", LongType()),
    StructField("events", LongType()), StructField("seconds", BinaryType()),
    StructField("batch_id", IntegerType()), StructField("tbl", StringType()),
    StructField("bucket", IntegerType()),
])
# typed column -> generic column, per table
TYPED = {
    "pageviews": {"url": "k1", "hour_bucket": "n1", "secs": "n2", "personid": "v.personid",
                  "events": "events"},
    "pages": {"url": "k1", "pedigree": "v.pedigree", "pageview": "v.pageview"},
    "persons": {"personid": "k1", **{c: f"v.{c}" for c in
                                     ["pedigree", "gendertype", "fullname", "city", "state",
                                      "country"]}},
    "equivs": {"personid1": "k1", "personid2": "k2", "pedigree": "v.pedigree"},
    HOURS: {"url": "k1", "hour_bucket": "n1", "seconds": "seconds", "events": "events"},
    QUARANTINE: {"reason": "k1", "raw": "k2", "messages": "events"},
}


def keyed_rows(parsed: DataFrame) -> DataFrame:
    """One generic keyed row per message (a single projection)."""
    t = F.col("messagetype")
    bad = F.col("reason").isNotNull()
    s = lambda c: F.col(c).cast("string")
    of = lambda mtype: ~bad & (t == mtype)
    tbl = F.when(bad, QUARANTINE)
    for mtype, table in TABLE_OF_TYPE.items():
        tbl = tbl.when(t == mtype, table)
    k1 = (F.when(bad, F.col("reason"))
          .when(t == "pageview", normalize_url(F.col("pageid")))
          .when(t == "page", normalize_url(F.col("url")))
          .when(t == "person", s("personid"))
          .when(t == "equiv", s("personid1")))
    k2 = F.when(bad, F.col("raw")).when(t == "equiv", s("personid2"))
    n1 = F.when(of("pageview"), hour_bucket(F.col("secs")))
    n2 = F.when(of("pageview"), F.col("secs"))
    v = F.struct(
        F.when(of("pageview"), s("personid")).alias("personid"),
        F.when(~bad & (t != "pageview"), s("pedigree")).alias("pedigree"),
        *[F.when(~bad, F.col(c)).alias(c) for c in VALUE_FIELDS[2:]],
    )
    return parsed.select(tbl.alias("tbl"), k1.alias("k1"), k2.alias("k2"),
                         n1.cast("bigint").alias("n1"), n2.cast("bigint").alias("n2"),
                         v.alias("v"), F.col("secs"))


def speed_frame(lines: DataFrame, coordinate_cols: tuple[str, ...] | None = None,
                tables: tuple[str, ...] = TABLES) -> DataFrame:
    """The keyed rows the speed query hands to each micro-batch (not started)."""
    parsed = decode.parse_messages(lines, coordinate_cols=coordinate_cols, strict_urls=True)
    rows = keyed_rows(parsed)
    if tuple(tables) != TABLES:
        rows = rows.where(F.col("tbl").isin(*tables, QUARANTINE))
    return rows


def second_bitmap(secs: Column, hour: Column) -> Column:
    """Aggregate: the bitmap of an hour's seconds.

    Buckets truncate toward zero, so hour 0 also holds the seconds before the
    epoch: those take the bits after the 3,600 of an hour. Bytes past the last
    bit set are cut off.
    """
    at = (F.abs(secs - hour * 3600) + F.when(secs < 0, 3600).otherwise(0)).cast("long")
    return F.substring(F.bitmap_construct_agg(at), F.lit(1), (F.floor(F.max(at) / 8) + 1).cast("int"))


def hour_rows(pageviews: DataFrame) -> DataFrame:
    """(url, hour_bucket, seconds, events) of rows (url, hour_bucket, secs, events)."""
    return pageviews.groupBy("url", "hour_bucket").agg(
        second_bitmap(F.col("secs"), F.col("hour_bucket")).alias("seconds"), F.sum("events").cast("bigint").alias("events"))


def micro_batch_aggregate(rows: DataFrame) -> DataFrame:
    """Per key of one micro-batch: the latest version, its second and the number
    of writes; and the hours of its pageviews. Partial per task, then one shuffle on
    the key, which both read."""
    order = F.struct(F.col("secs"), F.col("v"))
    out = rows.groupBy("tbl", "k1", "k2", "n1", "n2").agg(
        F.max(order).alias("_last"), F.count(F.lit(1)).alias("events"))
    per_key = out.select("tbl", "k1", "k2", "n1", "n2", F.col("_last.v").alias("v"),
                         F.col("_last.secs").alias("secs"), "events", F.lit(None).cast("binary").alias("seconds"))
    hours = hour_rows(per_key.where(F.col("tbl") == "pageviews").select(
        F.col("k1").alias("url"), F.col("n1").alias("hour_bucket"), F.col("n2").alias("secs"), "events"))
    none = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in GENERIC.fields}
    return per_key.unionByName(hours.select(
        F.lit(HOURS).alias("tbl"), F.col("url").alias("k1"), none["k2"], F.col("hour_bucket").alias("n1"),
        none["n2"], none["v"], none["secs"], "events", "seconds"))


def _bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(key, F.lit(""))), F.lit(BUCKETS)).cast("int")


def _write_buckets(df: DataFrame, key: str, parts: list[str], path: str) -> None:
    """Rows in buckets of ``key``: few files each (sized by AQE), sorted, with bloom filters."""
    rest = [c for c in df.columns if c in ("k2", "n1", "n2", "hour_bucket", "secs", "personid2", "raw")]
    (df.withColumn("bucket", _bucket(F.col(key))).hint("rebalance", *parts, "bucket")
     .sortWithinPartitions(*parts, "bucket", key, *rest)
     .write.mode("overwrite").option(f"parquet.bloom.filter.enabled#{key}", "true")
     .partitionBy(*parts, "bucket").parquet(path))


def _batch_writer(root: str):
    def write(df: DataFrame, batch_id: int) -> None:
        _write_buckets(micro_batch_aggregate(df), "k1", ["tbl"], f"{root}/batch_id={batch_id}")
    return write


def start_speed(lines: DataFrame, out_root: str, checkpoint_root: str,
                coordinate_cols: tuple[str, ...] | None = None, trigger: dict | None = None,
                tables: tuple[str, ...] = TABLES) -> dict[str, StreamingQuery]:
    """Start the speed-layer query; returns it as ``{"speed": query}``."""
    w = (speed_frame(lines, coordinate_cols, tables).writeStream
         .outputMode("append")
         .option("checkpointLocation", f"{checkpoint_root}/speed")
         .foreachBatch(_batch_writer(out_root)))
    if trigger:
        w = w.trigger(**trigger)
    return {"speed": w.start()}


def _typed(generic: DataFrame, table: str) -> DataFrame:
    """Typed columns of a table, and ``ord``, by which its versions are ordered."""
    cols = [F.col(src).alias(dst) for dst, src in TYPED[table].items()]
    if not VALUES[table]:
        return generic.select(*cols)
    values = F.struct(*[F.col(TYPED[table][c]).alias(c) for c in VALUES[table]])
    order = F.struct(F.col("secs").alias("secs"), F.col("batch_id").alias("batch_id"),
                     values.alias("values"))
    return generic.select(*cols, order.alias("ord"))


def _merge(df: DataFrame, table: str) -> DataFrame:
    """Merge typed versions of keys: latest values by order; write counts add up, bitmaps
    are OR-ed (and cut to the longest). Keeps ``ord`` for later merges."""
    keys, vals, merged = KEYS[table], VALUES[table], MERGED.get(table, {})
    aggs = [how(c).alias(c) if c == "seconds" else how(c).cast("bigint").alias(c) for c, how in merged.items()]
    if "seconds" in merged:
        aggs[0] = F.substring(F.bitmap_or_agg("seconds"), F.lit(1), F.max(F.octet_length("seconds"))).alias("seconds")
    if vals:
        aggs.append(F.max("ord").alias("ord"))
    out = df.groupBy(*keys).agg(*aggs)
    return out.select(*keys, *[F.col("ord.values")[v].alias(v) for v in vals], *merged, *(["ord"] if vals else []))


def committed_batches(spark: SparkSession, out_root: str, after: int = -1) -> list[int]:
    """Ids of the batch folders beyond ``after`` whose write has finished."""
    ids = sorted(int(n.split("=")[1]) for n in list_names(spark, out_root)
                 if n.startswith("batch_id="))
    return [i for i in ids if i > after and path_exists(spark, f"{out_root}/batch_id={i}/_SUCCESS")]


def _read_batches(spark: SparkSession, out_root: str, ids: list[int]) -> DataFrame:
    return (spark.read.schema(GENERIC).option("basePath", out_root)
            .parquet(*[f"{out_root}/batch_id={i}" for i in ids]))


def removed_upto(spark: SparkSession, out_root: str) -> int:
    """The last batch whose folder was removed after folding, -1 if none."""
    marks = [int(n.split("-")[1].split(".")[0]) for n in list_names(spark, out_root)
             if n.startswith("_removed-")]
    return max(marks, default=-1)


def _snapshot(spark: SparkSession, snapshot_path: str, table: str) -> tuple[DataFrame, int]:
    """Rows of a finished snapshot (with their ``bucket``) and the last batch folded into it."""
    mark = read_json(spark, f"{snapshot_path}/_folded.json")
    if mark is None:
        raise ValueError(f"no finished snapshot at {snapshot_path}")
    schema = _merge(_typed(spark.range(0).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in GENERIC.fields]), table), table).schema
    return spark.read.schema(schema.add("bucket", IntegerType())).parquet(snapshot_path), mark["batch_id"]


def _with_keys(df: DataFrame, key: str, keys: list[str] | None) -> DataFrame:
    """Rows of some first keys: their buckets (whole folders) and their values (row groups)."""
    if keys is None:
        return df
    if not keys:
        return df.where(F.lit(False))
    buckets = None
    for k in keys[:BUCKETS * 4]:    # a long list names every bucket anyway
        b = F.col("bucket") == _bucket(F.lit(k))
        buckets = b if buckets is None else buckets | b
    df = df.where(F.col(key).isin(keys))
    return df.where(buckets) if len(keys) <= BUCKETS * 4 else df


def _sources(spark: SparkSession, out_root: str, table: str, snapshot_path: str | None,
             keys: list[str] | None = None) -> tuple[DataFrame | None, int]:
    """Versions of a table's keys, and the last batch among them."""
    base, upto = None, -1
    if snapshot_path and path_exists(spark, snapshot_path):
        base, upto = _snapshot(spark, snapshot_path, table)
        base = _with_keys(base, KEYS[table][0], keys).drop("bucket")
    if removed_upto(spark, out_root) > upto:
        raise ValueError(f"batches up to {removed_upto(spark, out_root)} were folded and removed: "
                         "read with the snapshot that holds them")
    ids = committed_batches(spark, out_root, upto)
    if ids:
        rows = _read_batches(spark, out_root, ids).where(F.col("tbl") == table)
        new = _typed(_with_keys(rows, "k1", keys), table)
        base = new if base is None else base.unionByName(new)
        upto = ids[-1]
    return base, upto


def read_realtime(spark: SparkSession, out_root: str, table: str,
                  snapshot_path: str | None = None, keys: list[str] | None = None) -> DataFrame:
    """Current content of a realtime table: newest version per key.

    With ``snapshot_path`` (written by ``compact_realtime``) only the batch
    folders newer than the snapshot are read next to it, so reads stay
    proportional to the recent stream. ``keys`` restricts the first key (URL,
    person) before any merge: only their buckets are opened.
    """
    df, _ = _sources(spark, out_root, table, snapshot_path, keys)
    if df is None:
        return _empty(spark, table)
    df = _merge(df, table)
    return df.drop("ord") if VALUES[table] else df


def read_hours(spark: SparkSession, out_root: str, snapshot_path: str | None = None,
               keys: list[str] | None = None) -> DataFrame:
    """(url, hour_bucket, distinct_seconds, events): realtime counts per URL and hour."""
    return read_realtime(spark, out_root, HOURS, snapshot_path, keys).select(
        "url", "hour_bucket", F.bitmap_count("seconds").alias("distinct_seconds"), "events")


def read_quarantine(spark: SparkSession, out_root: str, snapshot_path: str | None = None) -> DataFrame:
    """(reason, raw, messages): what the speed layer could not use, all batches together."""
    return read_realtime(spark, out_root, QUARANTINE, snapshot_path)


def compact_realtime(spark: SparkSession, out_root: str, table: str, snapshot_path: str,
                     previous_snapshot: str | None = None,
                     absorbed: DataFrame | None = None) -> int:
    """Fold a realtime table (previous snapshot + finished batches) into one
    merged snapshot at ``snapshot_path``; returns the last batch id folded in
    (-1 and no snapshot while there is nothing).

    ``absorbed`` (url, hour_bucket) names the URL hours the batch view counts:
    their entries in ``pageviews`` and ``hours`` are dropped. Serving reads realtime
    rows of a URL only after its last hour in the batch view, so no result changes, and
    entries of URLs or hours the batch has never counted stay. The streaming
    query keeps running; batches finished later are read on top.
    """
    df, upto = _sources(spark, out_root, table, previous_snapshot)
    if df is None:
        return -1
    cur = _merge(df, table)
    if table in ("pageviews", HOURS) and absorbed is not None:
        cur = cur.join(absorbed.select("url", "hour_bucket"), ["url", "hour_bucket"], "left_anti")
    _write_buckets(cur, KEYS[table][0], [], snapshot_path)
    write_json(spark, f"{snapshot_path}/_folded.json", {"batch_id": upto, "table": table})
    return upto


def remove_folded(spark: SparkSession, out_root: str, snapshots: dict[str, str]) -> int:
    """Remove the batch folders that the snapshots of all tables hold; returns how many.

    The mark written first makes a later read without a snapshot an error, not
    a result with missing rows.
    """
    if set(snapshots) != set(FOLDED):
        raise ValueError(f"a snapshot of every table is needed: {', '.join(FOLDED)}")
    upto = min(_snapshot(spark, path, t)[1] for t, path in snapshots.items())
    ids = [i for i in committed_batches(spark, out_root) if i <= upto]
    if ids:
        if removed_upto(spark, out_root) < upto:
            write_json(spark, f"{out_root}/_removed-{upto}.json", {"batch_id": upto})
        for i in ids:
            delete_folder(spark, f"{out_root}/batch_id={i}")
    return len(ids)


def _empty(spark: SparkSession, table: str) -> DataFrame:
    types = {"hour_bucket": "bigint", "secs": "bigint", "events": "bigint", "messages": "bigint", "seconds": "binary"}
    cols = KEYS[table] + VALUES[table] + list(MERGED.get(table, {}))
    ddl = ", ".join(f"{c} {types.get(c, 'string')}" for c in cols)
    return spark.createDataFrame([], ddl)


def await_all(queries: dict[str, StreamingQuery]) -> None:
    for q in queries.values():
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
