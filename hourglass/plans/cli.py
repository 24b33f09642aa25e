"""Command-line entry point over the jobs (for ``spark-submit``).

  batch        --new N --master M --view V --checkpoint C [--run-id R]
  incremental  --new N --master M --view V --checkpoint C --run-id R
  ingest       SOURCE --new N --checkpoint C [--once]
  speed        SOURCE --realtime RT --checkpoint C [--once]
               SOURCE: --source DIR, or --kafka SERVERS --topic T
               [--starting-offsets earliest] [--kafka-option K=V ...]
  expire       --view V --realtime RT --snapshot S [--previous P]
  countpageviews / getpageviews
               --view V --realtime RT --pageid U [--pageid U2 ...]
               --datestart dd.MM.yyyy|HH --dateend dd.MM.yyyy|HH
               [--snapshot S] [--mode distinct_seconds|every_event]
  inspect      --view V [--key-value]

Results of serving and inspection are shown with ``DataFrame.show``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from hourglass.plans import jobs
from hourglass.sources import messages as M


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="hourglass")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("batch", "incremental"):
        s = sub.add_parser(name)
        for a in ("--new", "--master", "--view", "--checkpoint"):
            s.add_argument(a, required=True)
        s.add_argument("--run-id", required=(name == "incremental"))
    for name, out in (("ingest", "--new"), ("speed", "--realtime")):
        s = sub.add_parser(name)
        place = s.add_mutually_exclusive_group(required=True)
        place.add_argument("--source", help="folder of text files, one message a line")
        place.add_argument("--kafka", help="bootstrap servers")
        s.add_argument("--topic")
        s.add_argument("--starting-offsets", default="earliest")
        s.add_argument("--kafka-option", action="append", default=[], metavar="K=V")
        s.add_argument(out, required=True)
        s.add_argument("--checkpoint", required=True)
        s.add_argument("--once", action="store_true", help="process what is there, then stop")
    s = sub.add_parser("expire")
    for a in ("--view", "--realtime", "--snapshot"):
        s.add_argument(a, required=True)
    s.add_argument("--previous")
    for name in ("countpageviews", "getpageviews"):
        s = sub.add_parser(name)
        for a in ("--view", "--realtime", "--datestart", "--dateend"):
            s.add_argument(a, required=True)
        s.add_argument("--pageid", action="append", required=True)
        s.add_argument("--snapshot")
        s.add_argument("--mode", default="distinct_seconds",
                       choices=["distinct_seconds", "every_event"])
    s = sub.add_parser("inspect")
    s.add_argument("--view", required=True)
    s.add_argument("--key-value", action="store_true")
    return p


def kafka_arguments(a: argparse.Namespace) -> tuple[tuple[str, str, str], dict[str, str]]:
    """Arguments of ``messages.kafka_source`` from the command line."""
    if not a.topic:
        raise SystemExit("--kafka needs --topic")
    return (a.kafka, a.topic, a.starting_offsets), dict(o.split("=", 1) for o in a.kafka_option)


def source(spark: SparkSession, a: argparse.Namespace):
    if a.source:
        return M.text_source(spark, a.source)
    place, options = kafka_arguments(a)
    return M.kafka_source(spark, *place, **options)


def main(argv: list[str] | None = None, spark: SparkSession | None = None):
    """Run one command; returns the result DataFrame for serving/inspection."""
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"hourglass-{a.cmd}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if a.cmd == "batch":
        jobs.run_batch(spark, a.new, a.master, a.view, a.checkpoint, run_id=a.run_id)
    elif a.cmd == "incremental":
        jobs.run_incremental(spark, a.new, a.master, a.view, a.checkpoint, a.run_id)
    elif a.cmd in ("ingest", "speed"):
        trigger = {"availableNow": True} if a.once else None
        src = source(spark, a)
        if a.cmd == "ingest":
            qs = {"ingest": jobs.start_ingest(src, a.new, a.checkpoint, trigger=trigger)}
        else:
            qs = jobs.start_speed(src, a.realtime, a.checkpoint, trigger=trigger)
        for q in qs.values():
            q.awaitTermination()
    elif a.cmd == "expire":
        jobs.expire_realtime(spark, a.view, a.realtime, a.snapshot, a.previous)
    elif a.cmd in ("countpageviews", "getpageviews"):
        fn = jobs.count_pageviews if a.cmd == "countpageviews" else jobs.get_pageviews
        df = fn(spark, a.view, a.realtime, a.pageid, a.datestart, a.dateend,
                snapshot_path=a.snapshot, mode=a.mode)
        df.show(truncate=False)
        return df
    elif a.cmd == "inspect":
        df = jobs.inspect_view(spark, a.view, key_value=a.key_value)
        df.show(truncate=False)
        return df
    return None


if __name__ == "__main__":
    main()
