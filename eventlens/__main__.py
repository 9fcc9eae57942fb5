"""Command line: ``python -m eventlens <command>`` (also under spark-submit).

  ingest   load landed feed files into slot-partitioned tables
           (batch, or --stream for the incremental available-now load)
  analyze  run the nineteen analyses over the tables, write one result each
           (--partials: read only the files landed since the last run)
  compact  move old slots of the feed tables (and the batches of partials) into
           fewer, larger files
  gaps     list the 15-minute slots missing between the first and last loaded one
  migrate  rewrite slot folders written with per-file inferred types into the
           fixed-type layout
  show     print one read-out view over the written results
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

TABLES = ("events", "mentions", "gkg")


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="eventlens")
    sub = parser.add_subparsers(dest="command", required=True)

    ingest = sub.add_parser("ingest", help="load landed files")
    ingest.add_argument("--landing", required=True)
    ingest.add_argument("--tables", required=True, help="root of the feed tables")
    ingest.add_argument("--only", choices=TABLES, action="append", help="feed(s) to load")
    ingest.add_argument("--archives", action="store_true", help="landed files are .zip")
    ingest.add_argument("--stream", action="store_true", help="incremental (checkpointed) load")
    ingest.add_argument("--checkpoint", help="stream checkpoint root (default: spark.checkpoint.dir)")
    ingest.add_argument("--strict", action="store_true",
                        help="fail before writing if a landed file cannot be loaded")
    ingest.add_argument("--last-slots", type=int, help="load only the last n slots due before --now")
    ingest.add_argument("--now", default=None, help="reference time for --last-slots (UTC, default: now)")
    ingest.add_argument("--report", action="store_true",
                        help="print accepted / rejected line counts per table and slot")

    analyze = sub.add_parser("analyze", help="run all analyses")
    analyze.add_argument("--tables", required=True)
    analyze.add_argument("--out", required=True, help="root of the result tables")
    analyze.add_argument("--format", default="parquet")
    analyze.add_argument("--keep-old-on-empty", action="store_true",
                         help="do not replace a result with an empty one")
    analyze.add_argument("--no-shared-bases", action="store_true")
    analyze.add_argument("--retain-hours", type=float,
                         help="only slots not older than now minus this many hours")
    analyze.add_argument("--now", help="reference time for --retain-hours (UTC, default: now)")
    analyze.add_argument("--calendar", action="store_true",
                         help="07/09/13/17 compare with calendar neighbours, not observed ones")

    analyze.add_argument("--partials", help="root of the partial aggregates: an incremental run")
    analyze.add_argument("--parallel", type=int, default=4, help="analyses run side by side")
    analyze.add_argument("--time-limit", type=float, help="seconds after which an analysis is given up")

    compact = sub.add_parser("compact", help="fewer, larger files for old slots")
    compact.add_argument("--tables", help="root of the feed tables")
    compact.add_argument("--before", help="stamp yyyyMMddHHmmss: slots before it are moved")
    compact.add_argument("--partials", help="root of partial aggregates whose batches are joined")

    gaps = sub.add_parser("gaps", help="missing slots of one feed table")
    gaps.add_argument("--tables", required=True)
    gaps.add_argument("--table", choices=TABLES, default="events")

    migrate = sub.add_parser("migrate", help="re-type slots written with inferred types")
    migrate.add_argument("--source", required=True, help="root holding <table>/ts=<stamp>/ folders")
    migrate.add_argument("--tables", required=True, help="root of the fixed-type feed tables")
    migrate.add_argument("--only", choices=TABLES, action="append")

    show = sub.add_parser("show", help="print a view over the written results")
    show.add_argument("--out", required=True, help="root of the result tables")
    which = show.add_mutually_exclusive_group(required=True)
    which.add_argument("--view", help="view name, e.g. view_heat_top")
    which.add_argument("--result", help="page of one result table, e.g. conflict_heatmap")
    show.add_argument("--n", type=int, default=500, help="page size for --result")
    show.add_argument("--format", default="parquet")

    args = parser.parse_args(argv)

    from eventlens.session import build_session

    spark = build_session(app_name=f"eventlens-{args.command}")
    if args.command == "ingest":
        tables = args.only or list(TABLES)
        if args.stream:
            from eventlens.streaming.ingest import ingest_available

            totals = ingest_available(spark, args.landing, args.tables, tables=tables,
                                      checkpoint_root=args.checkpoint, archives=args.archives)
        else:
            from eventlens.sources.ingest import ingest_batch
            from eventlens.sources.slots import due_slots

            totals = {
                table: ingest_batch(spark, args.landing, args.tables, table, archives=args.archives, strict=args.strict,
                                    slots=due_slots(spark, args.now or utc_now(), args.last_slots)
                                    if args.last_slots else None)
                for table in tables
            }
        if args.report:
            from eventlens.sources.ingest import landed_lines
            from eventlens.sources.delimited import slot_report

            for table in tables:
                lines = landed_lines(spark, args.landing, table, args.archives)
                for row in slot_report(lines, table).orderBy("ts").toLocalIterator():
                    print(json.dumps({"table": table, **row.asDict()}))
        for table, counted in totals.items():
            print(json.dumps({"table": table, **counted}))
    elif args.command == "analyze":
        from eventlens.plans.incremental import run_incremental
        from eventlens.plans.runner import run_from_tables

        calendar = ("sentiment_trend", "escalation_events", "tone_lag_analysis", "breaking_news")
        common = {
            "fmt": args.format, "write_empty": not args.keep_old_on_empty,
            "parallel": args.parallel, "time_limit": args.time_limit,
            "params": {name: {"calendar": True} for name in calendar} if args.calendar else None,
        }
        if args.partials:
            if args.retain_hours or args.no_shared_bases:
                parser.error("--partials keeps all slots and its own bases")
            statuses = run_incremental(spark, args.tables, args.partials, args.out, **common)
        else:
            statuses = run_from_tables(
                spark, args.tables, args.out, share_bases=not args.no_shared_bases,
                retain_hours=args.retain_hours, now=args.now, **common)
        for status in statuses:
            print(json.dumps(status))
        if any(s["status"] == "failed" for s in statuses):
            return 1
    elif args.command == "compact":
        from eventlens.plans.incremental import fold_partials
        from eventlens.sources.tables import compact as compact_table

        if bool(args.tables) != bool(args.before) or not (args.tables or args.partials):
            parser.error("compact takes --tables with --before, or --partials, or all three")
        for table in TABLES if args.tables else ():
            print(json.dumps({"table": table, "parts": compact_table(spark, args.tables, table, args.before)}))
        if args.partials:
            fold_partials(spark, args.partials)
    elif args.command == "gaps":
        from eventlens.sources.slots import missing_slots
        from eventlens.sources.tables import load_table

        table = load_table(spark, args.tables, args.table)
        if table is None:
            print(f"no table {args.table} under {args.tables}", file=sys.stderr)
            return 1
        # the gap list is bounded by the time span, so printing it is fine
        for row in missing_slots(table.select("ts").distinct()).orderBy("ts").toLocalIterator():
            print(row.ts)
    elif args.command == "migrate":
        from eventlens.sources.legacy import read_legacy_table
        from eventlens.sources.tables import write_slots

        for table in args.only or list(TABLES):
            rows = read_legacy_table(spark, f"{args.source.rstrip('/')}/{table}", table)
            write_slots(rows.drop("load_timestamp").filter("ts IS NOT NULL"), args.tables, table)
    elif args.command == "show" and args.result:
        from eventlens.plans.runner import RESULT_KEYS
        from eventlens.plans.views import result_page
        from eventlens.sources.sinks import read_result

        df = read_result(spark, args.out, args.result, args.format)
        order = RESULT_KEYS.get(args.result, df.columns)
        for row in result_page(df, order, args.n).toLocalIterator():
            print(json.dumps(row.asDict(), default=str))
    elif args.command == "show":
        from eventlens.plans.readout import result_views

        views = result_views(spark, args.out, args.format)
        if args.view not in views:
            print(f"unknown view; one of: {', '.join(sorted(views))}", file=sys.stderr)
            return 1
        # every view is bounded by construction (top-n cuts, pages, fixed grids)
        for row in views[args.view].toLocalIterator():
            print(json.dumps(row.asDict(), default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
