"""Session construction and the shared checkpoint / work folder."""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC for the date parsing of serving queries,
# AQE for runtime coalescing and skew splitting.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


# Suggested settings for a large cluster (~100 TB of facts, ~1000 executors).
# Partitions are sized by bytes, not by count: AQE coalesces shuffle output
# to the advisory size and splits skewed partitions above the threshold.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",          # upper bound; AQE coalesces
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",     # scan splits of Parquet facts
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.fileSink.log.compactInterval": "10",
    "spark.sql.sources.partitionOverwriteMode": "static",   # dynamic only per write
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "hourglass", extra: dict | None = None) -> SparkSession:
    """A session for local runs and tests. On a cluster, pass your own session."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster this is set by the operator (a DFS path). Only a ``local``
    master without it (local runs, tests) gets a fresh local folder; any other
    raises, as its executors would each write to a disk of their own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"spark.checkpoint.dir is not set: with master {master} it must "
                               "name a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="hourglass-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique subfolder of the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


# --- small files and folder lists, through Hadoop's FileSystem ---------------------------
# A path without a scheme means the default filesystem, as it does for Spark's readers.

def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders directly in ``path``; none if it is missing."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def read_json(spark: SparkSession, path: str) -> dict | None:
    """A small JSON file, None if it is missing."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def write_json(spark: SparkSession, path: str, value: dict) -> None:
    """Write a small JSON file that is not there yet: under a temporary name, then
    renamed, so it is there whole or not at all."""
    jvm = spark.sparkContext._jvm
    fs, p = _fs(spark, path)
    temporary = jvm.org.apache.hadoop.fs.Path(f"{p.getParent().toString()}/_tmp-{uuid.uuid4().hex}")
    stream = fs.create(temporary, True)
    try:
        stream.write(bytearray(json.dumps(value, sort_keys=True).encode()))
    finally:
        stream.close()
    if not fs.rename(temporary, p):
        fs.delete(temporary, False)
        raise RuntimeError(f"{path} exists already")
