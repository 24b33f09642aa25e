"""Key/value shards of the batch view with versions of their own.

A store holds the key/value form in hash shards of the URL, or of the whole key. Each shard
lies in a numbered generation; a small versioned file says which generation holds it and
which runs are counted. A refresh folds a delta into the shards that its keys hash to and
writes just these anew; the others keep their files. Inside a shard keys are sorted, in as
many files as its size asks for, so a large shard is not one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass import schemas as S
from hourglass.functions import bucketed_key, deserialize_long, serialize_long
from hourglass.session import delete_folder, list_names, read_json, write_json

SHARDED_KV = "key binary, value binary, shard int"


def shard_of(c: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(shards)).cast("int")


def current_shards(spark: SparkSession, root: str) -> dict | None:
    """The newest version of a shard store: ``shards`` (number -> generation), ``count``,
    ``by``, ``runs``, ``version``; None if there is none."""
    names = [n for n in list_names(spark, root) if n.startswith("_kv-")]
    return read_json(spark, f"{root}/{names[-1]}") if names else None


def _sharded(view: DataFrame, count: int, by: str) -> DataFrame:
    kv = view.select("url", bucketed_key("url", "granularity", "bucket").alias("key"),
                     serialize_long("total_pageviews").alias("value"))
    return kv.select("key", "value", shard_of(F.col(by), count).alias("shard"))


def _write(rows: DataFrame, path: str) -> None:
    # One shuffle: ranges of (shard, key) hold equal keys together, so the sum, the order
    # and the folders need no other.
    total = serialize_long(F.sum(deserialize_long("value")))
    (rows.repartitionByRange("shard", "key").groupBy("shard", "key").agg(total.alias("value"))
     .sortWithinPartitions("shard", "key").write.mode("overwrite").partitionBy("shard").parquet(path))


def _written(spark: SparkSession, path: str) -> list[str]:
    return [n.split("=")[1] for n in list_names(spark, path) if n.startswith("shard=")]


def _read(spark: SparkSession, root: str, held: dict[str, int]) -> DataFrame:
    paths = [f"{root}/generation={g}/shard={s}" for s, g in sorted(held.items())]
    if not paths:
        return spark.createDataFrame([], SHARDED_KV)
    return spark.read.schema(SHARDED_KV).option("basePath", root).parquet(*paths) \
        .select("key", "value", "shard")


def read_shards(spark: SparkSession, root: str, urls: list[str] | None = None) -> DataFrame:
    """(key, value) of the store; with ``urls`` just the shards they hash to (all shards if
    the store is sharded by the whole key), whose other keys are still among the rows."""
    now = current_shards(spark, root)
    if now is None:
        return spark.createDataFrame([], S.BATCH_VIEW_KV)
    held = now["shards"]
    if urls is not None and now["by"] == "url":
        asked = spark.range(1).select(F.explode(F.array(*map(F.lit, urls)).cast("array<string>")).alias("url"))
        wanted = {str(r[0]) for r in asked.select(shard_of(F.col("url"), now["count"])).distinct().collect()}
        held = {s: g for s, g in held.items() if s in wanted}
    return _read(spark, root, held).select(*S.BATCH_VIEW_KV.fieldNames())


def _publish(spark: SparkSession, root: str, version: dict) -> None:
    write_json(spark, f"{root}/_kv-{version['version']:08d}.json", version)
    _drop_unreferenced(spark, root)


def rebuild_shards(spark: SparkSession, root: str, view: DataFrame, count: int, by: str = "url",
                   runs: list[str] = ()) -> None:
    """Write ``view`` in ``count`` shards as a new generation, then switch to it.

    ``by="url"``: all keys of a URL in one shard (R7); ``by="key"``: spread by the key (R6).
    """
    if by not in ("url", "key"):
        raise ValueError("by must be 'url' or 'key'")
    now = current_shards(spark, root)
    version = 1 if now is None else now["version"] + 1
    path = f"{root}/generation={version}"
    _write(_sharded(view, count, by), path)
    _publish(spark, root, {"version": version, "count": count, "by": by, "runs": sorted(set(runs)),
                           "shards": dict.fromkeys(_written(spark, path), version)})


def refresh_shards(spark: SparkSession, root: str, delta: DataFrame, runs: list[str]) -> list[int]:
    """Add ``delta``, the view of the facts of ``runs``; returns the shards rewritten.

    The delta is hashed, summed and written once; its folders say which shards it touches.
    Runs counted already change nothing; a mix of counted and new ones is an error.
    """
    now = current_shards(spark, root)
    if now is None:
        raise ValueError(f"{root} holds no shards yet: rebuild_shards comes first")
    counted = set(now["runs"]) & set(runs)
    if counted:
        if counted == set(runs):
            return []
        raise ValueError(f"counted already: {sorted(counted)}")
    version = now["version"] + 1
    staged = f"{root}/_delta-{version}"
    _write(_sharded(delta, now["count"], now["by"]), staged)
    touched = _written(spark, staged)
    if touched:
        old = _read(spark, root, {s: now["shards"][s] for s in touched if s in now["shards"]})
        fresh = spark.read.schema(SHARDED_KV).parquet(staged).select("key", "value", "shard")
        _write(old.unionByName(fresh), f"{root}/generation={version}")
    _publish(spark, root, now | {"version": version, "runs": sorted({*now["runs"], *runs}),
                                 "shards": now["shards"] | dict.fromkeys(touched, version)})
    delete_folder(spark, staged)
    return sorted(map(int, touched))


def _drop_unreferenced(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Remove shards that none of the last ``keep`` versions refers to."""
    names = [n for n in list_names(spark, root) if n.startswith("_kv-")]
    kept = [read_json(spark, f"{root}/{n}") for n in names[-keep:]]
    used = {(g, s) for v in kept for s, g in v["shards"].items()}
    for folder in list_names(spark, root):
        if folder.startswith("generation=") and int(folder.split("=")[1]) <= kept[-1]["version"]:
            g = int(folder.split("=")[1])
            for s in _written(spark, f"{root}/{folder}"):
                if (g, s) not in used:
                    delete_folder(spark, f"{root}/{folder}/shard={s}")
            if not _written(spark, f"{root}/{folder}"):
                delete_folder(spark, f"{root}/{folder}")
    for n in names[:-keep]:
        delete_folder(spark, f"{root}/{n}")
