"""An index of a view store's files: which URLs and buckets each of them spans.

Files of a (granularity, period) hold disjoint URL ranges, so the least and the greatest URL
of each name the one file (two at a border) that a URL can lie in. A lookup of literal URLs
reads the index, then opens those files only and lists no folder of the view: what it opens
depends on the URLs and the range, not on the size of the view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.session import path_exists

FILES = ("generation int, granularity string, period long, file string, "
         "lo string, hi string, first long, last long, n long")

#: More files than this are not worth naming one by one: the folders are read instead.
MOST_FILES = 4_096


def index_path(root: str, version: int) -> str:
    return f"{root}/_files-{version:08d}"


def has_index(spark: SparkSession, root: str, version: int) -> bool:
    return path_exists(spark, f"{index_path(root, version)}/_SUCCESS")


def read_index(spark: SparkSession, root: str, version: int) -> DataFrame:
    return spark.read.schema(FILES).parquet(index_path(root, version))


def files_of(rows: DataFrame) -> DataFrame:
    """A row for each file of ``rows``, a read of partitions with their generation."""
    return rows.groupBy("generation", "granularity", "period", F.col("_metadata.file_name").alias("file")).agg(
        F.min("url").alias("lo"), F.max("url").alias("hi"), F.min("bucket").alias("first"),
        F.max("bucket").alias("last"), F.count(F.lit(1)).alias("n")) \
        .withColumn("generation", F.col("generation").cast("int"))


def write_index(spark: SparkSession, root: str, version: int, found: list[DataFrame]) -> None:
    """Write the rows of ``found`` as the index of a version; its size is a row a file."""
    out = spark.createDataFrame([], FILES)
    for part in found:
        out = out.unionByName(part)
    out.hint("rebalance").sortWithinPartitions("granularity", "lo") \
        .write.mode("overwrite").parquet(index_path(root, version))


def find_files(spark: SparkSession, root: str, version: int, urls: list[str],
               pieces: list[tuple[str, int, int]]) -> list[str] | None:
    """Paths of the files that may hold ``urls`` in ``pieces`` (granularity, first bucket,
    last bucket); None if there are more than ``MOST_FILES``."""
    if not urls or not pieces:
        return []
    inside = F.lit(False)
    for g, a, b in pieces:
        inside = inside | ((F.col("granularity") == g) & (F.col("first") <= b) & (F.col("last") >= a))
    asked = F.array(*map(F.lit, sorted(urls)))
    # The least URL asked for that is not below the file's range must not be above it.
    nearest = F.get(F.filter(asked, lambda u: u >= F.col("lo")), 0)
    found = read_index(spark, root, version).where(inside).where(nearest <= F.col("hi")) \
        .select("generation", "granularity", "period", "file").limit(MOST_FILES + 1).collect()
    if len(found) > MOST_FILES:
        return None
    return [f"{root}/generation={r.generation}/granularity={r.granularity}/period={r.period}/{r.file}"
            for r in found]
