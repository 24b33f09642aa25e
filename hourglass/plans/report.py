"""Write the formatted physical plans of the production paths to a markdown
file: decode, view build from the stored master, serving over stored views,
realtime read. Usage: ``python -m hourglass.plans.report <sf_dir> <out.md>``.
"""

from __future__ import annotations

import sys

from hourglass import schemas as S
from hourglass.operators import decode, serving, storage, views
from hourglass.plans import inspect
from hourglass.session import build_session, work_dir
from hourglass.sources import facts as FS
from hourglass.sources import messages as M
from hourglass.sources import testdata as td
from hourglass.streaming import speed


def main(sf_dir: str, out: str) -> None:
    spark = build_session("local[4]", 8, app_name="hourglass-plans")
    root = work_dir(spark, "plans")
    td.message_lines(spark, sf_dir).select("value").write.text(f"{root}/queue")
    lines = M.text_source(spark, f"{root}/queue", streaming=False)
    parsed = decode.parse_messages(lines)
    decode.to_new_data(parsed).write.partitionBy(*S.PARTITION_COLUMNS).parquet(f"{root}/new")
    FS.write_facts(storage.read_new_facts(spark, f"{root}/new"), f"{root}/master")
    master_pv = FS.read_kinds(spark, f"{root}/master", S.PAGE_VIEW)
    storage.write_view(views.batch_view(master_pv, with_last_hour=True), f"{root}/view")
    qs = speed.start_speed(M.text_source(spark, f"{root}/queue"), f"{root}/rt", f"{root}/ck",
                           trigger={"availableNow": True}, tables=("pageviews",))
    speed.await_all(qs)
    view = storage.read_view(spark, f"{root}/view", keep_layout=True)
    rt = speed.read_realtime(spark, f"{root}/rt", "pageviews")
    one = [view.first().url]
    many = view.select("url").distinct()
    sections = [
        ("Decode: queue lines -> facts + quarantine (one pass)", decode.to_new_data(parsed)),
        ("Batch view from the stored master", views.batch_view(master_pv)),
        ("Serving, one URL (literal list)", serving.count_pageviews(view, rt, one, 473600, 473760)),
        ("Serving, one URL over the whole month (month/week/day cover of the range)",
         serving.count_pageviews(view, rt, one, 473352, 474095)),
        ("Serving, many URLs (DataFrame list, size-checked broadcast)",
         serving.count_pageviews(view, rt, many, 473600, 473760)),
        ("Serving, many URLs beyond the broadcast bound (shuffle, salted hot URLs; "
         "Catalyst's own size-based broadcast turned off to show the large-data plan)",
         serving.count_pageviews(view, rt, many, 473600, 473760, broadcast_rows=0)),
        ("Realtime table read (latest version per key)", rt),
    ]
    with open(out, "w") as fh:
        fh.write("# Physical plans of the production paths\n\n")
        fh.write(f"Generated by `python -m hourglass.plans.report {sf_dir} {out}`.\n\n")
        for title, df in sections:
            no_auto = "turned off" in title
            if no_auto:
                spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
            fh.write(f"## {title}\n\n```\n{inspect.plan_text(df, 'formatted')}```\n\n")
            if no_auto:
                spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2])
