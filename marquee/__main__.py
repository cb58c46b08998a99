"""Job entry points: ``spark-submit`` this package's ``__main__`` or ``python -m marquee``."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

if not __package__:  # started by path: the package's parent has to be found, not its folder
    sys.path[0] = str(Path(__file__).resolve().parents[1])

from pyspark.sql import SparkSession  # noqa: E402

from marquee.plans import curate, curation_report, ping, run, run_analytics  # noqa: E402
from marquee.plans.answers import ACTOR, DIRECTOR, TOP, show_results  # noqa: E402
from marquee.plans.curation import LOSSES  # noqa: E402
from marquee.scratch import scratch_folder  # noqa: E402
from marquee.session import build_session  # noqa: E402
from marquee.sinks import show_preview  # noqa: E402
from marquee.sources import read_table, require_inputs, table_location, table_names  # noqa: E402


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="marquee")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("ping", "check", "curate", "analytics", "run"):
        job = jobs.add_parser(name)
        job.add_argument("--endpoint", help="S3A endpoint of a self-hosted object store")
        job.add_argument("--format", default="parquet", help="table format, e.g. parquet or delta")
        if name in ("check", "curate", "run"):
            job.add_argument("--raw", required=True, help="root of the raw extracts")
            job.add_argument("--movies", default="movies.csv")
            job.add_argument("--credits", default="credits.csv")
        if name in ("curate", "run"):
            job.add_argument("--staged", help="root for staged tables")
            job.add_argument("--report", action="store_true", help="print what was left out")
            job.add_argument("--single-line", action="store_true", help="end records at every line break")
            job.add_argument("--whole-files", action="store_true", help="read each file in one task")
        if name in ("curate", "analytics", "run"):
            job.add_argument("--curated", required=True, help="root of the curated tables")
        if name in ("curate", "analytics", "run"):
            job.add_argument("--overwrite-schema", action="store_true", help="let tables change their columns")
        if name in ("analytics", "run"):
            job.add_argument("--analytics", required=True, help="root of the result tables")
            job.add_argument("--actor", default=ACTOR)
            job.add_argument("--job-title", default=DIRECTOR)
            job.add_argument("--top", type=int, default=TOP)
    tables = jobs.add_parser("tables", help="print the tables of a root and the folders that hold them now")
    tables.add_argument("--root", required=True)
    tables.set_defaults(endpoint=None, format="parquet")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    ours = SparkSession.getActiveSession() is None
    spark = build_session(f"marquee {args.job}", args.format, args.endpoint)
    if not ours:
        _work(spark, args)
        return
    spark.sparkContext.setLogLevel("WARN")
    try:
        _work(spark, args)
    finally:
        spark.stop()


def _work(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "ping":
        show_preview(ping(spark))
    if args.job in ("check", "curate"):  # a whole run checks by itself
        require_inputs(spark, args.raw, [args.movies, args.credits])
    if args.job == "check":
        print("all inputs are there")
    if args.job in ("curate", "run"):
        with scratch_folder(spark, "staged", args.staged) as staged:
            reading = {
                "fmt": args.format,
                "movies": args.movies,
                "credits": args.credits,
                "multiline": not args.single_line,
                "staged_root": staged,
                "split_records": not args.whole_files,
                "overwrite_schema": args.overwrite_schema,
            }
            if args.job == "curate":
                curate(spark, args.raw, args.curated, **reading)
            else:
                questions = {"actor": args.actor, "job": args.job_title, "top": args.top}
                results = run(spark, args.raw, args.curated, args.analytics, **reading, **questions)
                show_results(results)
            if args.report:
                names = ("movies", "credits", LOSSES + "movies", LOSSES + "credits")
                report = curation_report(*(read_table(spark, staged, name) for name in names))
                show_preview(report.sort("source", "check"), 100)
    if args.job == "analytics":
        run_analytics(
            spark,
            args.curated,
            args.analytics,
            args.format,
            args.actor,
            args.job_title,
            args.top,
            show=True,
            overwrite_schema=args.overwrite_schema,
        )
    if args.job == "tables":
        for name in table_names(spark, args.root):
            print(name, table_location(spark, args.root, name), sep="\t")


if __name__ == "__main__":
    main()
