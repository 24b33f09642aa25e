"""Job entry points (J1-J5). Paths may be local or DFS; checkpoints belong
under the cluster's shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass import schemas as S
from hourglass.operators import master, serving, storage, views
from hourglass.streaming.ingest import start_ingest  # noqa: F401  (J3)
from hourglass.streaming.speed import (  # noqa: F401  (J2)
    FOLDED, HOURS, compact_realtime, read_hours, read_realtime, remove_folded, start_speed,
)

#: Runs absorbed before their files are consolidated.
COMPACT_EVERY = 8


def _next_run(spark: SparkSession, master_path: str, view_path: str) -> str:
    """A run id never issued before: beyond all that marks and the view know."""
    now = storage.current_view(spark, view_path)
    known = master.runs(spark, master_path) + (now["runs"] if now else [])
    numbers = [int(r[4:]) for r in known if r.startswith("run-") and r[4:].isdigit()]
    return f"run-{max(numbers, default=0) + 1:08d}"


def _absorb(spark: SparkSession, new_data_path: str, master_path: str, checkpoint: str, run_id: str,
            compact_every: int, drop_consumed: bool) -> None:
    # What earlier runs compacted has no reader left; runs of the past are
    # consolidated before this one begins to write.
    master.drop_compacted(spark, master_path)
    live = master.live_runs(spark, master_path)
    if len([r for r in live if r != run_id]) >= compact_every and run_id not in live:
        master.compact_master(spark, master_path)
    if run_id in master.held_runs(spark, master_path):
        return                              # absorbed whole before; newer data is the next run's
    files = master.fact_files(spark, new_data_path) if drop_consumed else []
    master.absorb(spark, new_data_path, master_path, f"{checkpoint}/absorb", run_id)
    master.drop_consumed(spark, new_data_path, files)


def run_batch(spark: SparkSession, new_data_path: str, master_path: str, view_path: str,
              checkpoint: str, files_per_granularity: int | None = None,
              run_id: str | None = None, compact_every: int = COMPACT_EVERY,
              drop_consumed: bool = False) -> DataFrame | None:
    """Absorb new data into the master dataset, then rebuild the batch
    view from the master's page-view facts. Returns the view (None while
    nothing has been ingested).

    One stream consumes new data, so what arrives meanwhile is left whole to
    the next run. Readers keep the view they have until the new one is whole.
    A ``run_id`` that is finished already does nothing. ``drop_consumed``
    removes the new-data files that the run has absorbed (R5).
    """
    now = storage.current_view(spark, view_path)
    if now is None or run_id is None or run_id not in now["runs"]:
        _absorb(spark, new_data_path, master_path, checkpoint,
                run_id or _next_run(spark, master_path, view_path), compact_every, drop_consumed)
        runs = master.runs(spark, master_path)
        if not runs:                        # no facts yet: nothing to build
            return None
        facts = master.read_master(spark, master_path, S.PAGE_VIEW)
        storage.rebuild_view(spark, view_path, facts, runs, files_per_granularity)
    return storage.read_current_view(spark, view_path)


def run_incremental(spark: SparkSession, new_data_path: str, master_path: str,
                    view_path: str, checkpoint: str, run_id: str,
                    compact_every: int = COMPACT_EVERY, drop_consumed: bool = False) -> list[tuple[str, int]]:
    """J1, incremental: absorb, then add the view of the facts that no run has
    counted yet, rewriting just the (granularity, period) partitions they
    touch. Returns the rewritten partitions.

    The view store knows which runs it counts. A killed run is repeated with
    the same ``run_id`` (what it absorbed is still uncounted); facts of a run
    that was given up are counted by the next, compacted or not; a ``run_id``
    that is counted already does nothing.
    """
    now = storage.current_view(spark, view_path)
    if now is not None and run_id in now["runs"]:
        return []
    _absorb(spark, new_data_path, master_path, checkpoint, run_id, compact_every, drop_consumed)
    runs = master.runs(spark, master_path)
    if not runs:                            # nothing absorbed yet
        return []
    if now is None:
        storage.rebuild_view(spark, view_path, master.read_master(spark, master_path, S.PAGE_VIEW), runs)
        return []
    new = [r for r in runs if r not in now["runs"]]
    if not new:
        return []
    return storage.refresh_current_view(
        spark, view_path, master.read_runs(spark, master_path, new, S.PAGE_VIEW), new)


def _view(spark: SparkSession, view_path: str, keys: list[str] | None, start, end, kw: dict,
          hours_only: bool = False) -> DataFrame:
    """The stored view with its layout; for literal URLs only the files they can lie in."""
    if keys is None:
        return storage.read_current_view(spark, view_path, keep_layout=True)
    lo, hi = (serving.query_hour(x, kw.get("legacy_12h", False)) for x in (start, end))
    pieces = [("h", lo, hi)] if hours_only else serving.cover(lo, hi)
    return storage.read_view_of(spark, view_path, keys, pieces)


def count_pageviews(spark: SparkSession, view_path: str, realtime_root: str,
                    urls, start, end, snapshot_path: str | None = None, **kw) -> DataFrame:
    """J4 countpageviews over stored views: the realtime side is read from the hour
    bitmaps, of literal URLs only from their buckets."""
    keys = serving.literal_urls(urls, spark, kw.get("normalize", True))
    rt = read_hours(spark, realtime_root, f"{snapshot_path}/{HOURS}" if snapshot_path else None, keys)
    view = _view(spark, view_path, keys, start, end, kw)
    return serving.count_pageviews(view, rt, urls, start, end, **kw)


def get_pageviews(spark: SparkSession, view_path: str, realtime_root: str,
                  urls, start, end, snapshot_path: str | None = None, **kw) -> DataFrame:
    """J4 getpageviews over stored views."""
    keys = serving.literal_urls(urls, spark, kw.get("normalize", True))
    rt = read_realtime(spark, realtime_root, "pageviews",
                       f"{snapshot_path}/pageviews" if snapshot_path else None, keys)
    view = _view(spark, view_path, keys, start, end, kw, hours_only=True)
    return serving.get_pageviews(view, rt, urls, start, end, **kw)


def expire_realtime(spark: SparkSession, view_path: str, realtime_root: str,
                    snapshot_path: str, previous_snapshot: str | None = None) -> int:
    """After a batch run: fold all realtime tables and the quarantine into
    ``<snapshot>/<table>`` and drop the pageview entries of URL hours the stored view counts. Batch
    folders that the previous snapshot holds are removed (readers of that
    snapshot do not need them). Returns the last batch folded, -1 if none."""
    before = {t: f"{previous_snapshot}/{t}" if previous_snapshot else None for t in FOLDED}
    rt = read_hours(spark, realtime_root, before[HOURS])
    lo, hi = rt.agg(F.min("hour_bucket"), F.max("hour_bucket")).first()
    absorbed = None
    if lo is not None and (storage.current_view(spark, view_path) or storage.path_exists(spark, view_path)):
        view = storage.read_current_view(spark, view_path, keep_layout=True)
        absorbed = serving.hour_rows(view, lo, hi).select("url", F.col("bucket").alias("hour_bucket"))
    upto = -1
    for t in FOLDED:
        upto = compact_realtime(spark, realtime_root, t, f"{snapshot_path}/{t}", before[t], absorbed)
    if previous_snapshot:
        remove_folded(spark, realtime_root, before)
    return upto


def inspect_view(spark: SparkSession, view_path: str, key_value: bool = False) -> DataFrame:
    """The stored batch view, typed or in key/value form."""
    v = storage.read_current_view(spark, view_path)
    return views.to_key_value(v) if key_value else v
