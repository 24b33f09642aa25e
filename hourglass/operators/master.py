"""The master dataset: facts absorbed run by run, checked, compacted and retained.

::

    live/batch=<stream>-<n>/dataunit_id=<k>/value_id=<v>/   facts of one micro-batch
    _absorbed/<stream>-<n>@<run>.json                       its mark: counts of facts
    packed/generation=<g>/dataunit_id=<k>/value_id=<v>/     facts of many runs
    _packed-<g>.json                                        the runs a generation holds

* Absorb (R1-R4): one ``availableNow`` stream over the new-data sink. Its checkpoint fixes
  the consumed file set (the snapshot). Each micro-batch is written to a folder of its own
  with overwrite and then marked, so a repeated batch replaces what was not marked and
  leaves what was (bag semantics: duplicates are kept). ``REBALANCE`` sizes the writers by
  the batch's bytes (R2): ten times the input is ten times the files, near the advisory size.
* Checks (S15, S16) are a branch of that write: facts that break a required-field rule or
  name a partition that does not exist go to ``dataunit_id=0`` with their ``problem``, and
  the mark counts them.
* Compaction (R3) rewrites the facts of finished runs into a generation of few, large files;
  rows keep their run's id, so a run's delta can be read from either place.
* Retention (R5): ``drop_compacted`` removes the folders that generations hold, and
  ``drop_consumed`` the new-data files that finished runs have absorbed.

Run ids come from marks, which outlive the folders: an id is never issued twice.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from hourglass import schemas as S
from hourglass.session import delete_folder, list_names, path_exists, read_json, write_json
from hourglass.sources import facts as FS

RUN_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")
REJECTED_DATAUNIT_ID = 0
CLAIMED = StructType([StructField(c, IntegerType()) for c in S.PARTITION_COLUMNS])
#: Facts as stored: with the run that absorbed them and, for rejected ones, why and what they claimed to be.
STORED = StructType(S.FACTS.fields + [StructField("run_id", StringType()), StructField("problem", StringType()),
                                      StructField("claimed", CLAIMED)])


def checked(facts: DataFrame, run_id: str) -> DataFrame:
    """``facts`` as the master stores them: sound ones under their kind, others rejected."""
    problem = FS.fact_problem()
    kept = [c for c in S.FACT_COLUMNS if c not in S.PARTITION_COLUMNS]
    # Evaluated once, before the columns that ask for it.
    named = facts.select(*S.FACT_COLUMNS, problem.alias("problem"))
    ok = F.col("problem").isNull()
    return named.select(
        *kept, *[F.when(ok, F.col(c)).otherwise(F.lit(0)).alias(c) for c in S.PARTITION_COLUMNS],
        F.lit(run_id).alias("run_id"), "problem",
        F.when(~ok, F.struct(*S.PARTITION_COLUMNS)).alias("claimed"))


def _stream_name(spark: SparkSession, checkpoint: str) -> str:
    """A name of the checkpoint, so that batch numbers of another one do not meet its own."""
    path = f"{checkpoint}/_stream.json"
    if read_json(spark, path) is None:
        write_json(spark, path, {"stream": uuid.uuid4().hex[:12]})
    return read_json(spark, path)["stream"]


def absorbed_batches(spark: SparkSession, master: str) -> dict[str, str]:
    """The run of each finished micro-batch, by its folder's name."""
    names = [n.removesuffix(".json").split("@", 1) for n in list_names(spark, f"{master}/_absorbed")
             if n.endswith(".json")]
    return {batch: run for batch, run in names}


def packed_runs(spark: SparkSession, master: str) -> dict[int, list[str]]:
    """The runs each finished compaction holds, by generation."""
    marks = [n for n in list_names(spark, master) if n.startswith("_packed-")]
    found = [read_json(spark, f"{master}/{n}") for n in marks]
    return {m["generation"]: m["runs"] for m in found}


def held_runs(spark: SparkSession, master: str) -> set[str]:
    return {r for runs in packed_runs(spark, master).values() for r in runs}


def live_runs(spark: SparkSession, master: str) -> list[str]:
    """Ids of the runs whose facts no generation holds yet."""
    held = held_runs(spark, master)
    return sorted(set(absorbed_batches(spark, master).values()) - held)


def runs(spark: SparkSession, master: str) -> list[str]:
    """Ids of all runs that ever absorbed facts, by the marks."""
    return sorted(set(absorbed_batches(spark, master).values()) | held_runs(spark, master))


def absorb(spark: SparkSession, new_data_path: str, master: str, checkpoint: str, run_id: str,
           max_files_per_trigger: int | None = None) -> int:
    """Absorb every fact of ``new_data_path`` not absorbed yet under a run's id;
    returns the number of micro-batches run.

    Safe to re-run and to kill at any point. A run that a compaction holds is
    finished: absorbing more under its id is refused.
    """
    if not RUN_ID.fullmatch(run_id):
        raise ValueError(f"run id {run_id!r}: letters, digits, '.', '_' and '-' only")
    if run_id in held_runs(spark, master):
        raise ValueError(f"run {run_id} is compacted: absorb under a new id")
    if not path_exists(spark, new_data_path):   # nothing ingested yet
        return 0
    stream = _stream_name(spark, checkpoint)
    src = spark.readStream.schema(S.NEW_DATA)
    if max_files_per_trigger:
        src = src.option("maxFilesPerTrigger", str(max_files_per_trigger))
    facts = src.parquet(new_data_path).where(
        ~F.col("dataunit_id").eqNullSafe(S.QUARANTINE_DATAUNIT_ID)).select(*S.FACT_COLUMNS)

    def write(df: DataFrame, n: int) -> None:
        session = df.sparkSession
        batch = f"{stream}-{n:08d}"
        if batch in absorbed_batches(session, master):     # repeated after its mark was written
            return
        if run_id in held_runs(session, master):
            raise RuntimeError(f"run {run_id} was compacted while it absorbed")
        seen = Observation()
        rows = checked(df, run_id).observe(seen, F.count(F.lit(1)).alias("facts"),
                                           F.count("problem").alias("rejected"))
        rows.hint("rebalance", *S.PARTITION_COLUMNS).write.mode("overwrite") \
            .partitionBy(*S.PARTITION_COLUMNS).parquet(f"{master}/live/batch={batch}")
        write_json(session, f"{master}/_absorbed/{batch}@{run_id}.json", {"batch": n, "run": run_id, **seen.get})

    q = (facts.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return len(q.recentProgress)


def absorbed_counts(spark: SparkSession, master: str) -> dict[str, dict[str, int]]:
    """Facts seen and rejected by each run not compacted yet, from its batches' marks."""
    found: dict[str, dict[str, int]] = {}
    held = held_runs(spark, master)
    for batch, run in absorbed_batches(spark, master).items():
        if run not in held:
            mark = read_json(spark, f"{master}/_absorbed/{batch}@{run}.json")
            total = found.setdefault(run, {"facts": 0, "rejected": 0})
            for k in total:
                total[k] += mark[k]
    return found


def _stored(spark: SparkSession, master: str, only: list[str] | None = None) -> DataFrame:
    """All stored rows, or those of some runs: live folders and generations that have any."""
    packed = packed_runs(spark, master)
    held = {r for g in packed.values() for r in g}
    wanted = (lambda r: True) if only is None else set(only).__contains__
    live = [f"{master}/live/batch={b}" for b, r in sorted(absorbed_batches(spark, master).items())
            if r not in held and wanted(r)]
    old = [f"{master}/packed/generation={g}" for g, rs in sorted(packed.items()) if any(map(wanted, rs))]
    frames = [spark.read.schema(STORED).option("basePath", base).parquet(*paths).select(*STORED.fieldNames())
              for base, paths in ((f"{master}/live", live), (f"{master}/packed", old)) if paths]
    if not frames:
        return spark.createDataFrame([], STORED)
    df = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
    return df if only is None else df.where(F.col("run_id").isin(only))


def _facts(stored: DataFrame, dataunit_ids: tuple[int, ...]) -> DataFrame:
    if dataunit_ids:
        return stored.where(F.col("dataunit_id").isin(*dataunit_ids)).select(*S.FACT_COLUMNS)
    return stored.where(F.col("dataunit_id") != REJECTED_DATAUNIT_ID).select(*S.FACT_COLUMNS)


def read_master(spark: SparkSession, master: str, *dataunit_ids: int) -> DataFrame:
    """All facts of ``master`` (of some kinds)."""
    return _facts(_stored(spark, master), dataunit_ids)


def read_runs(spark: SparkSession, master: str, only: list[str], *dataunit_ids: int) -> DataFrame:
    """Facts that the named runs absorbed."""
    return _facts(_stored(spark, master, only), dataunit_ids)


def read_rejected(spark: SparkSession, master: str) -> DataFrame:
    """Facts that were not let in: with their ``problem``, run and claimed partition."""
    return _stored(spark, master).where(F.col("dataunit_id") == REJECTED_DATAUNIT_ID).select(
        "run_id", "problem", "claimed.*", *[c for c in S.FACT_COLUMNS if c not in S.PARTITION_COLUMNS])


def compact_master(spark: SparkSession, master: str) -> list[str]:
    """Rewrite the facts of all live runs into one generation (R3); returns the runs.

    The cost follows those runs, not the master. Call it between runs of the
    batch job; absorb goes on with its own checkpoint.
    """
    found = live_runs(spark, master)
    if found:
        g = max(packed_runs(spark, master), default=0) + 1
        _stored(spark, master, found).hint("rebalance", *S.PARTITION_COLUMNS) \
            .write.mode("overwrite").partitionBy(*S.PARTITION_COLUMNS).parquet(f"{master}/packed/generation={g}")
        write_json(spark, f"{master}/_packed-{g:06d}.json", {"generation": g, "runs": found})
    return found


def drop_compacted(spark: SparkSession, master: str) -> int:
    """Remove the live folders whose runs a generation holds; returns how many.

    The job calls it at the start of a run, so what a run compacts stays for
    readers that began before until the next one. Marks go with the folders,
    except a stream's newest, which a repeated batch must still find.
    """
    held = held_runs(spark, master)
    batches = absorbed_batches(spark, master)
    newest = {b.rsplit("-", 1)[0]: b for b in sorted(batches)}
    there = set(list_names(spark, f"{master}/live"))
    gone = 0
    for batch, run in batches.items():
        if run in held:
            if f"batch={batch}" in there:
                delete_folder(spark, f"{master}/live/batch={batch}")
                gone += 1
            if batch not in newest.values():
                delete_folder(spark, f"{master}/_absorbed/{batch}@{run}.json")
    return gone


# --- retention of new data -------------------------------------------------------------------

def fact_files(spark: SparkSession, new_data_path: str) -> list[str]:
    """Files of facts that the new-data sink's log names now (quarantined messages are apart)."""
    if not path_exists(spark, new_data_path):
        return []
    files = spark.read.schema(S.NEW_DATA).parquet(new_data_path).inputFiles()
    return [f for f in files if f"/{S.PARTITION_COLUMNS[0]}={S.QUARANTINE_DATAUNIT_ID}/" not in f]


def drop_consumed(spark: SparkSession, new_data_path: str, files: list[str]) -> int:
    """Remove ``files`` of new data (taken by ``fact_files`` before a run that has
    finished since); returns how many were there.

    The sink's log goes on naming them until its own retention
    (``start_ingest(..., retention=)``) forgets them, so a note beside it tells
    readers of new data to take what is there. The absorbing stream never opens
    a file twice.
    """
    if files and not path_exists(spark, f"{new_data_path}/_consumed.json"):
        write_json(spark, f"{new_data_path}/_consumed.json", {"consumed": True})
    there = [f for f in files if path_exists(spark, f)]
    for f in there:
        delete_folder(spark, f)
    return len(there)
