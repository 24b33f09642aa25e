"""Queue message sources (S1, S2): any DataFrame with a ``value`` string column.

A Kafka source is used when its connector is on the classpath; otherwise a
directory of text files (one JSON document per line) stands in for the
queue. Both feed the same decode plan; queue coordinates, when present, make
pageview nonces unique per delivery.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.schemas import QUEUE_COORDINATES

def text_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                streaming: bool = True) -> DataFrame:
    """Lines of the text files under ``path`` as ``value`` (stream or batch)."""
    if not streaming:
        return spark.read.text(path)
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def kafka_options(bootstrap_servers: str, topic: str, starting_offsets: str = "earliest",
                  **options) -> dict[str, str]:
    """The reader options of a Kafka topic; ``options`` are added or replace them."""
    return {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic,
            "startingOffsets": starting_offsets} | {k: str(v) for k, v in options.items()}


def kafka_source(spark: SparkSession, bootstrap_servers: str, topic: str,
                 starting_offsets: str = "earliest", **options) -> DataFrame:
    """``value`` plus topic/partition/offset from a Kafka topic.

    Raises a clear error when the Kafka connector is not available; pass a
    text source (or any streaming DataFrame with ``value``) instead.
    """
    r = spark.readStream.format("kafka").options(
        **kafka_options(bootstrap_servers, topic, starting_offsets, **options))
    try:
        df = r.load()
    except Exception as e:  # connector not on the classpath
        raise RuntimeError("Kafka source unavailable; use text_source or pass a "
                           "streaming DataFrame with a 'value' column") from e
    return df.select(F.col("value").cast("string").alias("value"),
                     *[F.col(c) for c in QUEUE_COORDINATES])


def write_lines(lines: DataFrame, path: str, files: int, order_col: str | None = None) -> None:
    """Write ``value`` lines as ``files`` text files (test and bench input).

    With ``order_col`` the lines are range-partitioned on it, so file *i*
    holds the *i*-th slice in that order (event-ordered delivery).
    """
    df = lines
    if order_col:
        df = df.repartitionByRange(files, order_col).sortWithinPartitions(order_col)
    else:
        df = df.repartition(files)
    df.select("value").write.mode("overwrite").text(path)
