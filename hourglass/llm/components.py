"""Connected components of a table of links, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.joins import join_measured


def _neighbours_and_least(links: DataFrame) -> DataFrame:
    """(u, v, m) for each link in both directions, m the least of u's neighbours and u."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
        links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return join_measured(both, least, ["u"], "inner", F.col("v"))


def components(links: DataFrame, folder: str, most_rounds: int = 64) -> DataFrame:
    """(node, component) for the nodes of ``links`` (a, b: long, a <> b).

    The component is its least node. Each round hangs the larger neighbours of every node,
    and then the others, under the least one, until nothing changes; a round's links are
    written under ``folder``, so lost executors cost a round at most and no plan grows.
    Repeated links and links in both directions are allowed; no links give no rows.
    """
    spark = links.sparkSession

    def settle(df: DataFrame, name: str) -> tuple[DataFrame, tuple]:
        path = f"{folder}/{name}"
        df.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct() \
            .write.mode("overwrite").parquet(path)
        out = spark.read.schema("a long, b long").parquet(path)
        mark = out.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return out, tuple(mark)

    now, mark = settle(links, "round-0")
    for k in range(1, most_rounds + 1):
        larger = _neighbours_and_least(now).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        middle, _ = settle(larger, f"round-{k}-larger")
        # Now each link runs from a node to a lesser one: the lesser neighbours are its b.
        least = middle.groupBy("a").agg(F.min("b").alias("m"))
        lesser = join_measured(middle, least, ["a"], "inner", F.col("b"))
        hung = lesser.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            least.select("a", F.col("m").alias("b")))
        now, after = settle(hung, f"round-{k}")
        if after == mark:
            roots = now.select(F.col("b").alias("node")).distinct()
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
                roots.select("node", F.col("node").alias("component")))
        mark = after
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
