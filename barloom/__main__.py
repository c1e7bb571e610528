"""The three jobs from the command line, for a scheduler or spark-submit to call.

    python -m barloom ingest    --listing DIR --histories DIR --raw DIR --date YYYY-MM-DD
    python -m barloom load      --raw DIR --table NAME [--date YYYY-MM-DD]
    python -m barloom transform --raw DIR --out DIR --run-date YYYY-MM-DD [--date YYYY-MM-DD]
"""

from __future__ import annotations

import argparse

from barloom.operators.selection import FULL_PROFILE
from barloom.plans.ingest import ingest
from barloom.plans.load import load_snapshot
from barloom.plans.report import RunReport
from barloom.plans.transform import LAYOUTS, run_transform
from barloom.session import get_session
from barloom.sinks.tables import create_tick_table
from barloom.sources.documents import read_history, read_listing


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="barloom")
    parser.add_argument("--input-bytes", type=int, help="size of the input, sets the shuffle width")
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("ingest", help="landed JSON to a snapshot of ticks")
    job.add_argument("--listing", required=True)
    job.add_argument("--histories", required=True)
    job.add_argument("--raw", required=True)
    job.add_argument("--date", required=True)
    job.add_argument("--series", type=int, default=FULL_PROFILE[0])
    job.add_argument("--days", type=int, default=FULL_PROFILE[1])
    job.add_argument("--until-ms", type=int, help="end of the look-back; default: the end of the date")
    job.add_argument("--multiline", action="store_true")
    job.add_argument("--by-series", action="store_true")

    job = jobs.add_parser("load", help="a snapshot of ticks to the tick table")
    job.add_argument("--raw", required=True)
    job.add_argument("--table", required=True)
    job.add_argument("--date")
    job.add_argument("--on-conflict", choices=("append", "skip"), default="append")
    job.add_argument("--buckets", type=int)
    job.add_argument("--by-day", action="store_true")
    job.add_argument("--legacy", action="store_true")

    job = jobs.add_parser("transform", help="a snapshot of ticks to daily metrics")
    job.add_argument("--raw", required=True)
    job.add_argument("--out", required=True)
    job.add_argument("--run-date", required=True)
    job.add_argument("--date")
    job.add_argument("--layout", choices=LAYOUTS, default=LAYOUTS[0])
    job.add_argument("--calendar", action="store_true")
    job.add_argument("--ordered", action="store_true")
    job.add_argument("--legacy", action="store_true")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> RunReport:
    args = _arguments(argv)
    spark = get_session(f"barloom {args.job}", input_bytes=args.input_bytes)
    if args.job == "ingest":
        report = ingest(
            read_listing(spark, args.listing, args.multiline),
            read_history(spark, args.histories, args.multiline),
            args.raw, args.date, args.series, args.days, args.until_ms, args.by_series)
    elif args.job == "load":
        create_tick_table(spark, args.table, buckets=args.buckets, by_day=args.by_day)
        rows = load_snapshot(
            spark, args.raw, args.table, args.date, args.on_conflict, args.legacy)
        report = RunReport({"table": args.table}, {"ticks": rows})
    else:
        report = run_transform(
            spark, args.raw, args.out, args.run_date, args.date, args.legacy, args.layout,
            args.calendar, args.ordered)
    print(report)
    return report


if __name__ == "__main__":
    main()
