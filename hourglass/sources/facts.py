"""The fact datasets: plain and vertically partitioned Parquet.

Layout ``<root>/dataunit_id=<kind>/value_id=<value>/part-*.parquet``: a
reader asking for one fact kind gets a partition filter in the scan and
never opens the other kinds' files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass import schemas as S
from hourglass.functions import dataunit_id


def read_facts(spark: SparkSession, path: str) -> DataFrame:
    """A fact dataset with the declared schema (never inferred).

    Works for plain and partitioned layouts; Parquet's additive schema
    evolution applies (unknown columns are ignored, missing ones are NULL).
    """
    return spark.read.schema(S.FACTS).parquet(path).select(*S.FACT_COLUMNS)


def read_kinds(spark: SparkSession, path: str, *dataunit_ids: int) -> DataFrame:
    """Only the chosen fact kinds (S14); pruned to their partitions."""
    return read_facts(spark, path).where(F.col("dataunit_id").isin(*dataunit_ids))


def write_facts(facts: DataFrame, path: str, mode: str = "append") -> None:
    """Write facts vertically partitioned by (dataunit_id, value_id).

    No shuffle: the input's own splits are balanced already (file splits of
    ``spark.sql.files.maxPartitionBytes``); the planned write sorts each task
    by the partition columns so a task keeps one file open at a time.
    """
    (facts.select(*S.FACT_COLUMNS)
     .write.mode(mode)
     .partitionBy(*S.PARTITION_COLUMNS)
     .parquet(path))


def partition_counts(facts: DataFrame) -> DataFrame:
    """(dataunit_id, value_id, facts) — rows per partition of a fact dataset."""
    return facts.groupBy("dataunit_id", "value_id").agg(F.count(F.lit(1)).alias("facts"))


def legal_partitions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(S.LEGAL_PARTITIONS, "dataunit_id int, value_id int")


def invalid_partitions(facts: DataFrame) -> DataFrame:
    """Partitions that are not legal targets (S15); empty for a sound dataset.

    The distinct partition pairs are aggregated first (at most a handful of
    rows), then anti-joined with the six legal pairs.
    """
    spark = facts.sparkSession
    pairs = facts.select("dataunit_id", "value_id").distinct()
    return pairs.join(F.broadcast(legal_partitions(spark)), ["dataunit_id", "value_id"],
                      "left_anti")


def fact_problem() -> Column:
    """What is wrong with a fact, null if it is sound.

    Exactly one union branch must be set and match ``dataunit_id``; the
    timestamp and every required field of the branch must be present; the
    partition must be a legal one.
    """
    pv, eq = F.col("page_view"), F.col("equiv")
    pp, pr = F.col("page_property"), F.col("person_property")
    set_branches = (pv.isNotNull().cast("int") + eq.isNotNull().cast("int")
                    + pp.isNotNull().cast("int") + pr.isNotNull().cast("int"))
    pid_ok = lambda p: p.isNotNull() & (p["cookie"].isNotNull() | p["user_id"].isNotNull())  # noqa
    prop = pr["property"]
    n_person_vals = (prop["full_name"].isNotNull().cast("int")
                     + prop["gender"].isNotNull().cast("int")
                     + prop["location"].isNotNull().cast("int"))
    branch = dataunit_id(pr, pp, eq, pv)
    kind = F.col("dataunit_id")
    # A condition on a missing field is null, not false: only true ones pass.
    fails = lambda ok: ~F.coalesce(ok, F.lit(False))
    legal = F.array(*[F.lit(f"{d},{v}") for d, v in S.LEGAL_PARTITIONS])
    return (
        F.when(F.col("true_as_of_secs").isNull(), "missing_pedigree")
        .when(set_branches != 1, "union_not_exactly_one")
        .when(~branch.eqNullSafe(kind), "branch_mismatch")
        .when((kind == S.PAGE_VIEW)
              & fails(pid_ok(pv["person"]) & pv["page"]["url"].isNotNull() & pv["nonce"].isNotNull()),
              "bad_page_view")
        .when((kind == S.EQUIV) & fails(pid_ok(eq["id1"]) & pid_ok(eq["id2"])), "bad_equiv")
        .when((kind == S.PAGE_PROPERTY)
              & fails(pp["id"]["url"].isNotNull() & pp["property"]["page_views"].isNotNull()),
              "bad_page_property")
        .when((kind == S.PERSON_PROPERTY) & fails(pid_ok(pr["id"]) & (n_person_vals == 1)),
              "bad_person_property")
        .when(fails(F.array_contains(legal, F.concat_ws(",", kind, "value_id"))), "illegal_partition")
    )


def invalid_facts(facts: DataFrame) -> DataFrame:
    """Facts violating the required-field rules (S16), with a ``problem``; partitions
    that are not legal targets are told by ``invalid_partitions``."""
    out = facts.select("*", fact_problem().alias("problem"))
    return out.where(F.col("problem") != "illegal_partition")
