"""Jobs for ``spark-submit``: ``pipeline``, ``daily``, ``archive-reports``, ``compact`` and ``replay``.

    spark-submit --py-files clicktide.zip clicktide/__main__.py JOB OPTIONS

    pipeline --servers broker:9092 --archive /data/events --checkpoints /data/checkpoints
    daily    --archive /data/events --out /data/reports --date 2026-01-01
    archive-reports --archive /data/events --out /data/reports
    compact  --archive /data/events --before 2026-01-01
    replay   --archive /data/events --date 2026-01-01 --servers broker:9092

``--servers`` needs Spark's Kafka connector among the ``--packages``.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date

from pyspark.sql import SparkSession

from clicktide.plans import (
    build_report_bundle,
    run_daily_reports,
    write_archive_reports,
    write_report_bundle,
)
from clicktide.schemas import (
    ALERT_PURCHASES_UNDER,
    ALERT_TOPIC,
    ALERT_VIEWS_OVER,
    ALLOWED_LATENESS,
    EVENT_TOPIC,
    WINDOW_SIZE,
    WINDOW_SLIDE,
)
from clicktide.session import MIB, build_session, sized_for
from clicktide.sinks import (
    compact_closed_days,
    console_sink,
    kafka_sink_options,
    message_sink,
    publish_events,
    table_sink,
)
from clicktide.sinks.compaction import FILE_BYTES
from clicktide.sources import kafka_source_options, open_archive, read_archive, read_event_stream
from clicktide.streaming import PipelineConfig, run_pipeline, start_pipeline


def arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="clicktide")
    jobs = parser.add_subparsers(dest="job", required=True)

    pipeline = jobs.add_parser("pipeline", help="archive events and raise alerts")
    source = pipeline.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="brokers to read events from and send alerts to")
    source.add_argument("--events", help="folder of files with one JSON event per line")
    pipeline.add_argument("--topic", default=EVENT_TOPIC)
    pipeline.add_argument("--alert-topic", default=ALERT_TOPIC)
    pipeline.add_argument("--alert-table", help="also keep alerts in this folder")
    pipeline.add_argument("--source-option", action="append", default=[], metavar="NAME=VALUE")
    pipeline.add_argument("--archive", required=True)
    pipeline.add_argument("--archive-files", type=int, help="files per micro-batch and date")
    pipeline.add_argument("--junk", help="keep messages that cannot be parsed in this folder")
    pipeline.add_argument("--checkpoints", required=True)
    pipeline.add_argument("--size", default=WINDOW_SIZE)
    pipeline.add_argument("--slide", default=WINDOW_SLIDE)
    pipeline.add_argument("--lateness", default=ALLOWED_LATENESS)
    pipeline.add_argument("--views-over", type=int, default=ALERT_VIEWS_OVER)
    pipeline.add_argument("--purchases-under", type=int, default=ALERT_PURCHASES_UNDER)
    pipeline.add_argument("--alerts", choices=["provisional", "final"], default="provisional")
    pipeline.add_argument("--once", action="store_true", help="catch up with the source, then end")

    daily = jobs.add_parser("daily", help="write the reports of a day")
    daily.add_argument("--archive", required=True)
    daily.add_argument("--out", required=True)
    daily.add_argument("--date", required=True, help="YYYY-MM-DD")

    every_day = jobs.add_parser("archive-reports", help="write the reports of every day in one pass")
    every_day.add_argument("--archive", required=True)
    every_day.add_argument("--out", required=True)

    compact = jobs.add_parser("compact", help="rewrite a streamed archive's closed days in few files")
    compact.add_argument("--archive", required=True)
    compact.add_argument("--before", required=True, help="YYYY-MM-DD, the first day left alone")
    compact.add_argument("--file-mib", type=int, default=FILE_BYTES // MIB)
    compact.add_argument("--remove-replaced", action="store_true", help="give up the replaced files")

    replay = jobs.add_parser("replay", help="publish an archived day as messages")
    replay.add_argument("--archive", required=True)
    replay.add_argument("--date", required=True, help="YYYY-MM-DD")
    target = replay.add_mutually_exclusive_group(required=True)
    target.add_argument("--servers", help="brokers to publish to")
    target.add_argument("--out", help="folder to write the messages to, as JSON lines")
    replay.add_argument("--topic", default=EVENT_TOPIC)
    return parser.parse_args(argv)


def pipeline(spark: SparkSession, args: argparse.Namespace) -> None:
    options = dict(option.split("=", 1) for option in args.source_option)
    sinks = [console_sink()]
    if args.servers:
        messages = read_event_stream(
            spark, "kafka", **kafka_source_options(args.servers, args.topic, **options)
        )
        sinks.append(message_sink("kafka", **kafka_sink_options(args.servers, args.alert_topic)))
    else:
        messages = read_event_stream(spark, "text", args.events, **options)
    if args.alert_table:
        sinks.append(table_sink(args.alert_table))

    triggers = {}
    if args.once:
        triggers = dict.fromkeys(["archive_trigger", "alert_trigger"], {"availableNow": True})
    config = PipelineConfig(
        archive=args.archive,
        checkpoints=args.checkpoints,
        alert_sinks=sinks,
        size=args.size,
        slide=args.slide,
        lateness=args.lateness,
        views_over=args.views_over,
        purchases_under=args.purchases_under,
        archive_files=args.archive_files,
        junk=args.junk,
        alert_mode="update" if args.alerts == "provisional" else "append",
        **triggers,
    )
    if not args.once:
        run_pipeline(spark, messages, config)
        return
    for query in start_pipeline(messages, config).values():
        query.awaitTermination()


def daily(spark: SparkSession, args: argparse.Namespace) -> None:
    archive = open_archive(spark, args.archive)
    source_date = archive.resolve(args.date)
    with sized_for(spark, archive.size(source_date)):
        run = run_daily_reports(spark, archive, args.out, args.date, source_date=source_date)
    if run.source_date != run.requested_date:
        print(f"no events on {run.requested_date}, took {run.source_date}")
    print(f"{run.events:,} events, {run.users:,} users, segments {run.segments}")
    bundle = build_report_bundle(spark, args.out, args.date)
    print(f"reports in {args.out}, bundle in {write_report_bundle(bundle, args.out, args.date)}")


def replay(spark: SparkSession, args: argparse.Namespace) -> None:
    archive = open_archive(spark, args.archive)
    day = archive.resolve(args.date)
    events = archive.read(day)
    with sized_for(spark, archive.size(day)):
        if args.servers:
            publish_events(events, "kafka", **kafka_sink_options(args.servers, args.topic))
        else:
            publish_events(events, "json", path=args.out)


def archive_reports(spark: SparkSession, args: argparse.Namespace) -> None:
    for report, path in write_archive_reports(spark, read_archive(spark, args.archive), args.out).items():
        print(f"{report} in {path}")


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    before = date.fromisoformat(args.before)
    days = compact_closed_days(spark, args.archive, before, args.file_mib * MIB, args.remove_replaced)
    print(f"rewrote {len(days)} days of {args.archive}")


JOBS = {
    "pipeline": pipeline, "daily": daily, "archive-reports": archive_reports, "compact": compact,
    "replay": replay,
}


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments(argv)
    JOBS[args.job](build_session(f"clicktide-{args.job}"), args)


if __name__ == "__main__":
    main()
