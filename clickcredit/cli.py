"""Command line: ``spark-submit clickcredit/cli.py <command> ...`` or ``python -m clickcredit``.

Commands:
  report   build the report for one input file or folder (report TSV, summary, status event)
  route    log a RECEIVED event and size class for every file under a landing folder
  stream   run the file stream over a landing folder (``--once`` processes the backlog and stops)
  pending  report every received file that has no outcome yet, in one job
  compact  fold the status log's appends into few files
  latest   write the current status per file (the keyed view of the log)
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import sys

if not __package__:  # run as a script (spark-submit clickcredit/cli.py ...)
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _run_ts(text: str | None) -> dt.datetime:
    if text:
        return dt.datetime.fromisoformat(text.rstrip("Z"))
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="clickcredit")
    sub = parser.add_subparsers(dest="command", required=True)

    rep = sub.add_parser("report", help="report for one input")
    rep.add_argument("input")
    rep.add_argument("output_root")
    rep.add_argument("status_log")
    rep.add_argument("--run-ts", help="run time, ISO UTC (default: now)")
    rep.add_argument("--source-name")
    rep.add_argument("--site", default=None)
    rep.add_argument("--attribution", choices=["last", "first", "any"], default="last")
    rep.add_argument("--lax", action="store_true", help="keep empty host / empty keyword touches")
    rep.add_argument("--case-sensitive", action="store_true")

    route = sub.add_parser("route", help="log arriving files")
    route.add_argument("landing_root")
    route.add_argument("status_log")
    route.add_argument("--run-ts")
    route.add_argument("--glob")

    pending = sub.add_parser("pending", help="report all received files")
    pending.add_argument("output_root")
    pending.add_argument("status_log")
    pending.add_argument("--run-ts")
    pending.add_argument("--dated-by", choices=["run", "file"], default="run")

    stream = sub.add_parser("stream", help="one report per arriving file")
    stream.add_argument("landing")
    stream.add_argument("output")
    stream.add_argument("--checkpoint")
    stream.add_argument("--files-per-trigger", type=int, default=1)
    stream.add_argument("--status-log", help="append a COMPLETE event per processed file")
    stream.add_argument("--once", action="store_true")

    compact = sub.add_parser("compact", help="fold status-log appends")
    compact.add_argument("status_log")

    latest = sub.add_parser("latest", help="current status per file")
    latest.add_argument("status_log")
    latest.add_argument("snapshot")

    args = parser.parse_args(argv)

    from clickcredit.plans.job import route_new_files, run_pending, run_report_job
    from clickcredit.schema import DEFAULT_SITE
    from clickcredit.session import get_session
    from clickcredit.sinks.eventlog import compact_file_events, write_latest_status
    from clickcredit.streaming.file_stream import start_report_stream

    spark = get_session(app_name=f"clickcredit-{args.command}")
    if args.command == "report":
        res = run_report_job(spark, args.input, args.output_root, args.status_log,
                             run_ts=_run_ts(args.run_ts), source_name=args.source_name,
                             site=args.site or DEFAULT_SITE, attribution=args.attribution,
                             strict=not args.lax, case_sensitive=args.case_sensitive)
        print(json.dumps({"output_location": res.output_location, "record_count": res.record_count,
                          "inexact_lines": res.inexact_lines,
                          "summary": res.summary, "top_domains": res.top_domains,
                          "top_keywords": res.top_keywords}))
    elif args.command == "route":
        manifest = route_new_files(spark, args.landing_root, args.status_log,
                                   run_ts=_run_ts(args.run_ts), path_glob=args.glob)
        counts = manifest.groupBy("size_class").count().collect()
        print(json.dumps({r["size_class"]: r["count"] for r in counts}))
    elif args.command == "pending":
        events = run_pending(spark, args.output_root, args.status_log, run_ts=_run_ts(args.run_ts),
                             dated_by=args.dated_by)
        print(json.dumps({"reported": events.count()}))
    elif args.command == "compact":
        print(json.dumps({"generation": compact_file_events(spark, args.status_log)}))
    elif args.command == "latest":
        write_latest_status(spark, args.status_log, args.snapshot)
    else:
        q = start_report_stream(spark, args.landing, args.output, checkpoint_dir=args.checkpoint,
                                max_files_per_trigger=args.files_per_trigger,
                                log_path=args.status_log, available_now=args.once)
        q.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
