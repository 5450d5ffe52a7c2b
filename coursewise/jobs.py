"""Command-line jobs, one per job of the reference, for ``spark-submit``.

    python -m coursewise.jobs clean-log INPUT OUTPUT
    python -m coursewise.jobs load-log ROOT INPUT [--tz UTC]
    python -m coursewise.jobs behavior ROOT DAY [--start D --end D] OUTPUT
    python -m coursewise.jobs dwd ROOT ODS_DIR [--feeds member,QzChapter,...]
    python -m coursewise.jobs dws-quiz ROOT [DT]
    python -m coursewise.jobs dws-member ROOT [DT]
    python -m coursewise.jobs ads-quiz ROOT DT OUTPUT
    python -m coursewise.jobs copy-partition SRC DST DT [--columns dt,dn]

ROOT is the warehouse folder (tables under ROOT/dwd, ROOT/dws). An ODS folder
holds one text file (or folder) per feed, named ``<feed>.log`` as in the
reference. Results of ``behavior`` and ``ads-quiz`` are written as
tab-separated text folders under OUTPUT, one per report. The session is
whatever ``spark-submit`` configures, plus the warehouse defaults. Before the
job's name: ``--replace`` replaces the partitions a step writes instead of
appending to them, ``--input-gb`` sets the width of shuffles.
"""

from __future__ import annotations

import argparse
import os

from .operators import behavior as B
from .operators import cleaning as CL
from .operators import reports as R
from .plans import sinks as S
from .plans.warehouse import Warehouse
from .session import build_session, shuffle_width
from .sources import feeds as FD


def clean_log(spark, input_path: str, output_path: str) -> str:
    """Raw behaviour text -> cleaned ORC (fails if the output exists); rejects beside it."""
    from pyspark import StorageLevel
    from pyspark.sql import functions as F
    from .sources.driver import BEHAVIOR_COLUMNS
    # parse the raw log once for both outputs; disk-backed, so a lost
    # executor's blocks are simply recomputed from the input
    parsed = CL.parse_behavior(S.read_lines(spark, input_path)).persist(StorageLevel.DISK_ONLY)
    try:
        S.write_orc(parsed.where(F.col("reject_reason").isNull()).select(*BEHAVIOR_COLUMNS), output_path)
        S.write_orc(parsed.where(F.col("reject_reason").isNotNull()).select("line", "reject_reason"),
                    output_path.rstrip("/") + "_rejects")
    finally:
        parsed.unpersist()
    return output_path


def behavior_reports(spark, root: str, day: int, output: str, start=None, end=None) -> dict:
    """B1-B6 for one day (retention over [start, end]) as TSV result folders."""
    log = Warehouse(spark, root).behavior()
    out = {
        "app_course_study_analysis": B.video_feedback(log, day),
        "app_version_analysis": B.version_access(log, day),
        "app_channel_analysis": B.channel_new_users(log, day),
        "app_access_count_ranger_analysis": B.access_bands(log, day),
        "app_study_funnel_analysis": B.study_funnel(log, day),
        "seven_days_retained_analysis": B.retention_7d(log, start, end),
    }
    return {name: S.write_tsv(df, f"{output.rstrip('/')}/{name}_{day}") for name, df in out.items()}


def dwd(spark, root: str, ods_dir: str, feeds=None, mode: str = "append") -> dict:
    """Every feed file under ODS_DIR into its detail table."""
    wh = Warehouse(spark, root, mode)
    lines = {feed: S.read_lines(spark, os.path.join(ods_dir, f"{feed}.log")) for feed in feeds or FD.FEEDS}
    return wh.ingest_all(lines)


def ads_quiz(spark, root: str, dt, output: str) -> dict:
    """A1-A7 on the paper detail of day ``dt`` as TSV result folders."""
    detail = Warehouse(spark, root).paper_detail()
    out = {
        "paper_avg": R.paper_avg(detail, dt), "paper_min_max": R.paper_min_max(detail, dt),
        "paper_top3": R.paper_top3(detail), "paper_low3": R.paper_low3(detail, dt),
        "paper_bands": R.paper_bands(detail, dt), "paper_pass_rate": R.paper_pass_rate(detail, dt),
        "question_error_rate": R.question_error_rate(detail, dt),
    }
    return {name: S.write_tsv(df, f"{output.rstrip('/')}/{name}_{dt}") for name, df in out.items()}


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="coursewise.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    a = sub.add_parser("clean-log"); a.add_argument("input"); a.add_argument("output")  # noqa: E702
    a = sub.add_parser("load-log"); a.add_argument("root"); a.add_argument("input")  # noqa: E702
    a.add_argument("--tz", default="UTC")
    a = sub.add_parser("behavior"); a.add_argument("root"); a.add_argument("day", type=int)  # noqa: E702
    a.add_argument("output"); a.add_argument("--start", type=int); a.add_argument("--end", type=int)  # noqa: E702
    a = sub.add_parser("dwd"); a.add_argument("root"); a.add_argument("ods_dir")  # noqa: E702
    a.add_argument("--feeds", default="")
    for name in ("dws-quiz", "dws-member"):
        a = sub.add_parser(name); a.add_argument("root"); a.add_argument("dt", nargs="?")  # noqa: E702
    a = sub.add_parser("ads-quiz"); a.add_argument("root"); a.add_argument("dt")  # noqa: E702
    a.add_argument("output")
    a = sub.add_parser("copy-partition"); a.add_argument("src"); a.add_argument("dst")  # noqa: E702
    a.add_argument("dt"); a.add_argument("--columns", default="dt")  # noqa: E702
    p.add_argument("--replace", action="store_true", help="replace the partitions a step writes instead of appending")
    p.add_argument("--input-gb", type=float, help="size of the largest input, for the width of shuffles")
    args = p.parse_args(argv)

    spark = build_session(app=f"coursewise-{args.job}", shuffle_partitions=shuffle_width(args.input_gb))
    mode = "overwrite" if args.replace else "append"
    if args.job == "clean-log":
        clean_log(spark, args.input, args.output)
    elif args.job == "load-log":
        Warehouse(spark, args.root, mode).load_behavior(S.read_lines(spark, args.input), args.tz)
    elif args.job == "behavior":
        behavior_reports(spark, args.root, args.day, args.output, args.start, args.end)
    elif args.job == "dwd":
        dwd(spark, args.root, args.ods_dir, [f for f in args.feeds.split(",") if f] or None, mode)
    elif args.job == "dws-quiz":
        Warehouse(spark, args.root, mode).build_quiz(args.dt)
    elif args.job == "dws-member":
        Warehouse(spark, args.root, mode).build_member(args.dt)
    elif args.job == "ads-quiz":
        ads_quiz(spark, args.root, args.dt, args.output)
    elif args.job == "copy-partition":
        S.copy_partitions(spark, args.src, args.dst, args.dt, tuple(args.columns.split(",")))
    spark.stop()


if __name__ == "__main__":
    main()
