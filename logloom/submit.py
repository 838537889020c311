"""Entry points for spark-submit; ``python -m logloom.submit --help`` lists them."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import replace

from logloom.config import Settings
from logloom.operators.points import MEASUREMENTS
from logloom.operators.sketches import SKETCHES
from logloom.session import build_session
from logloom.sources.logs import LogSource, open_batch
from logloom.sources.metric_store import clean, compact_dates, expire, expire_rows
from logloom.streaming import jobs


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="logloom")
    commands = out.add_subparsers(dest="command", required=True)
    for name in ("access", "errors"):
        command = commands.add_parser(name, help=f"topic of {name} lines to metric tables")
        command.add_argument("--store", required=True)
        command.add_argument("--mode", choices=("update", "append"), default="update")
        command.add_argument("--every", default="10 seconds")
        command.add_argument("--sink", choices=("store", "remote"))
        if name == "errors":
            command.add_argument("--time-source", choices=("window_end", "processing_time"))
    for name, what in (("samples", "the first raw lines of each kind of error"),
                       ("dead-letters", "lines without a readable time")):
        command = commands.add_parser(name, help=what)
        command.add_argument("--target", required=True)
        command.add_argument("--every", default="10 seconds")
    command = commands.add_parser("alerts", help="alert states of a store's points")
    command.add_argument("--store", required=True)
    command.add_argument("--target", required=True)
    command.add_argument("--every", default="1 minute")
    for name in ("backfill-access", "backfill-errors"):
        command = commands.add_parser(name, help="metric tables of archived log files")
        command.add_argument("--logs", required=True)
        command.add_argument("--store", required=True)
        if name == "backfill-access":
            command.add_argument("--staging", required=True)
    command = commands.add_parser("expire", help="remove dates past their retention")
    command.add_argument("--store", required=True)
    command.add_argument("--now", required=True)
    command.add_argument("--keep-days", type=int, required=True)
    command.add_argument("--rows", action="append", default=[],
                         help="a further folder of rows by date, such as samples")
    command = commands.add_parser("compact", help="few files for dates with many, then clean")
    command.add_argument("--store", required=True)
    command.add_argument("--most-files", type=int, default=8)
    command.add_argument("--grace", default="1 day")
    return out


def main(words: Sequence[str] | None = None) -> None:
    args, settings = parser().parse_args(words), Settings.from_env()
    if getattr(args, "sink", None):
        settings = replace(settings, sink=args.sink)
    if getattr(args, "time_source", None):
        settings = replace(settings, error_time=args.time_source)
    if args.command == "access":
        jobs.run_access(args.store, settings, args.mode, args.every)
    elif args.command == "errors":
        jobs.run_errors(args.store, settings, args.mode, every=args.every)
    elif args.command == "alerts":
        jobs.run_alerts(args.store, args.target, settings, args.every)
    elif args.command == "expire":
        spark = build_session("expire")
        for m in (*MEASUREMENTS, SKETCHES):
            expire(spark, args.store, m, args.now, args.keep_days)
        for path in args.rows:
            expire_rows(spark, path, args.now, args.keep_days)
    elif args.command == "compact":
        spark = build_session("compact")
        for m in (*MEASUREMENTS, SKETCHES):
            compact_dates(spark, args.store, m, args.most_files)
            clean(spark, args.store, m, args.grace)
    elif args.command == "samples":
        jobs.run_samples(args.target, settings, every=args.every)
    elif args.command == "dead-letters":
        jobs.run_dead_letters(args.target, settings, args.every)
    else:
        raw = open_batch(build_session(args.command), LogSource("text", args.logs))
        if args.command == "backfill-access":
            jobs.backfill_access(raw, args.staging, args.store, settings)
        else:
            jobs.backfill_errors(raw, args.store, settings)


if __name__ == "__main__":
    main()
