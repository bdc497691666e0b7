"""Command line: ``python -m stationdw <command> [options]``.

Every path and endpoint can come from an option or an environment variable (option wins):

  STATIONDW_TOPIC        raw message topic (folder for the file topic, topic name for Kafka)
  STATIONDW_SOURCE       ``files`` (default) or ``kafka``
  KAFKA_BROKER           bootstrap servers when the source is Kafka
  STATIONDW_CHANGELOG    Kafka topic of the keyed summary changelog when the source is Kafka
  STATIONDW_WAREHOUSE    warehouse folder (staging, quarantine, star, summary tables)
  STATIONDW_CHECKPOINTS  folder for streaming checkpoints (default: <warehouse>/_checkpoints)
  STATIONDW_MAX_FILES    files per micro-batch for paced replay of a file topic

Commands: prepare, publish, consume, load, summary, summary-changelog, load-summary, report, query.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from stationdw.plans import catalog, jobs
from stationdw.session import build_session


def _env(name: str, default: str | None = None) -> str | None:
    return os.environ.get(name, default)


def _source_options(args) -> tuple[str, dict]:
    if args.source == "kafka":
        return "kafka", {"kafka.bootstrap.servers": args.broker, "subscribe": args.topic}
    opts = {"path": args.topic}
    if args.max_files:
        opts["maxFilesPerTrigger"] = int(args.max_files)
    return "files", opts


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="stationdw")
    p.add_argument("command", choices=["prepare", "publish", "consume", "load", "summary",
                                       "summary-changelog", "load-summary", "report", "query"])
    p.add_argument("--csv", help="input CSV for publish")
    p.add_argument("--topic", default=_env("STATIONDW_TOPIC"))
    p.add_argument("--source", default=_env("STATIONDW_SOURCE", "files"))
    p.add_argument("--changelog-topic", default=_env("STATIONDW_CHANGELOG"),
                   help="Kafka topic of the keyed summary changelog (source kafka)")
    p.add_argument("--broker", default=_env("KAFKA_BROKER", "localhost:29092"))
    p.add_argument("--warehouse", default=_env("STATIONDW_WAREHOUSE"))
    p.add_argument("--checkpoints", default=_env("STATIONDW_CHECKPOINTS"))
    p.add_argument("--max-files", default=_env("STATIONDW_MAX_FILES"))
    p.add_argument("--database", default="dw")
    p.add_argument("--continuous", action="store_true", help="keep streams running")
    p.add_argument("--pair", nargs=4, metavar=("LEFT", "RIGHT", "LEFT_LABEL", "RIGHT_LABEL"))
    p.add_argument("--season", nargs="+", metavar="STATION")
    p.add_argument("--gap", nargs=4, metavar=("FIRST", "SECOND", "FIRST_LABEL", "SECOND_LABEL"))
    p.add_argument("--sql", help="statement for query, over the tables and views of --database")
    p.add_argument("--out", help="output folder of report (header CSV per report) or query")
    p.add_argument("--rows", type=int, help="print this many rows of each report instead")
    args = p.parse_args(argv)
    if (args.source == "kafka" and args.command in ("summary-changelog", "load-summary")
            and not args.changelog_topic):
        p.error(f"{args.command} from Kafka needs --changelog-topic")
    if args.command in ("report", "query") and not args.out and args.rows is None:
        p.error(f"{args.command} needs --out (whole result) or --rows N (the first N, printed)")
    if args.command == "query" and not args.sql:
        p.error("query needs --sql")

    wh = (args.warehouse or "").rstrip("/")
    spark = build_session()
    # Every command registers the tables at their fixed locations, and the views over them, in
    # its own session, so the catalog, the jobs and SQL all see the same files.
    locations = catalog.ensure_tables(spark, args.database, wh)
    catalog.create_views(spark, args.database)
    paths = catalog.table_paths(wh, args.database)
    ck = args.checkpoints or paths["checkpoints"]
    staging = paths["climate_normal_daily_raw"]
    summary = paths["monthly_climate_normal_summary"]
    star_root = f"{wh}/{args.database}"
    once = not args.continuous
    broker = {"kafka.bootstrap.servers": args.broker} if args.source == "kafka" else None
    changelog = args.changelog_topic if broker else paths["summary_changelog"]
    if args.command == "prepare":
        print(json.dumps(locations))
    elif args.command == "publish":
        sink = "kafka" if args.source == "kafka" else "files"
        n = jobs.publish_daily_csv(spark, args.csv, args.topic, sink,
                                   {"kafka.bootstrap.servers": args.broker})
        print(f"published {n} messages to {args.topic}")
    elif args.command == "consume":
        src, opts = _source_options(args)
        jobs.consume_to_staging(spark, src, opts, staging, paths["quarantine"],
                                f"{ck}/staging", available_now=once).awaitTermination()
    elif args.command == "load":
        for row in jobs.load_warehouse(spark, staging, star_root).collect():
            print(f"{row.stage}: {row.row_count}")
    elif args.command == "summary":
        src, opts = _source_options(args)
        jobs.monthly_summary_table(spark, src, opts, summary, f"{ck}/summary",
                                   available_now=once).awaitTermination()
    elif args.command == "summary-changelog":
        src, opts = _source_options(args)
        q = jobs.summary_changelog(spark, src, opts, changelog, f"{ck}/changelog", args.source,
                                   broker)
        if once:
            q.processAllAvailable()
            q.stop()
        else:
            q.awaitTermination()
    elif args.command == "load-summary":
        jobs.load_summary_changelog(spark, changelog, summary, f"{ck}/load-summary",
                                    available_now=once, source=args.source,
                                    options=broker).awaitTermination()
    elif args.command == "report":
        from stationdw.sources.sinks import write_report_csv
        star = jobs.read_star(spark, star_root)
        reports = jobs.reports(star, tuple(args.pair), list(args.season), tuple(args.gap))
        for name, df in reports.items():
            if args.out:
                write_report_csv(df, f"{args.out.rstrip('/')}/{name}")
            else:
                df.show(args.rows, truncate=False)
    elif args.command == "query":
        from stationdw.sources.sinks import write_report_csv
        catalog.refresh_tables(spark, args.database)
        catalog.use_database(spark, args.database)
        found = spark.sql(args.sql)
        if args.out:
            write_report_csv(found, args.out)
        else:
            found.show(args.rows, truncate=False)
    if args.command in ("consume", "load", "summary", "load-summary"):
        catalog.refresh_tables(spark, args.database)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
