"""Queries over the test tables, and the same results in DuckDB's SQL.

Reports are asked for every day of the table in one pass (``by=["event_date"]``).
The daily job and the archive reads take a date, as that is what they are for; the
archive they read is made of the table by ``prepare``. Streaming queries read the
table's events as JSON messages, the files of a few event dates per micro-batch,
run until their end, and return what they wrote.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from clicktide import operators as ops
from clicktide.functions import event_type_counts, previous_day
from clicktide.plans import build_report_bundle, run_daily_reports, write_archive_reports
from clicktide.schemas import CATALOGUE, CONVERSION, MESSAGE, USER_SEGMENT
from clicktide.session import shared_folder
from clicktide.sinks import (
    AlertChanges,
    CurrentTable,
    all_rows,
    compact_closed_days,
    latest_rows,
    publish_event_files,
    publish_events,
    table_sink,
    write_archive,
    write_archive_stream,
    write_junk_stream,
    write_report_csv,
    write_to_sinks,
)
from clicktide.sources import (
    load_events_for_date,
    open_archive,
    parse_events,
    read_archive,
    read_event_stream,
    read_report_csv,
    to_alert_messages,
    to_event_messages,
    with_ingest_metrics,
)
from clicktide.sources.events_table import read_events
from clicktide.streaming import PipelineConfig, start_pipeline

# The corpus operators may be absent as a whole; any other import error is raised.
try:
    from clicktide.llm import queries as corpus
except ModuleNotFoundError as missing:
    if missing.name != "clicktide.llm":
        raise
    corpus = None
try:
    import corpus_pipeline
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "clicktide.llm"):
        raise
    corpus_pipeline = None

SMOKE_FOLDER = "/root/testdata/sf0.001"
BY_DAY = ["event_date"]
REPORT_DAY = "2024-01-15"
DAY_AFTER_DATA = "2024-02-15"
# The test events are sparse: wide windows and a low bar, so that alerts occur.
WINDOWS = {"size": "1 day", "slide": "12 hours"}
RULE = {"views_over": 5, "purchases_under": 5}
SMOKE_RULE = {"views_over": 1, "purchases_under": 5}
TO_THE_END = {"availableNow": True}
# A micro-batch of the standing streams: so many days, in files spread by user.
DAYS_PER_GROUP = 10
FILES_PER_GROUP = 4
BATCHES_PER_SNAPSHOT = 8
DAYS_OF_CHANGES = 2
DAY_OF_WINDOW = "floor(unix_seconds(window_start) / 86400)"
LONG_LIST = 1500
DISPLAYED_ROWS = 10


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return read_events(spark, folder)


def _zoneless(rows: DataFrame) -> DataFrame:
    """UTC wall-clock times instead of instants, to compare with DuckDB's TIMESTAMP."""
    times = [name for name, kind in rows.dtypes if kind == "timestamp"]
    return rows.withColumns({name: F.col(name).cast("timestamp_ntz") for name in times})


def _write_archive(spark: SparkSession, folder: str) -> str:
    root = shared_folder(spark, "archive")
    write_archive(_events(spark, folder), root)
    return root


_ARCHIVES: dict[tuple[str, str], str] = {}


def prepare(spark: SparkSession, folder: str) -> str:
    """The table as an archive, the input of the daily job; made once per application.

    ``bench.py`` calls it first and reports its time by itself.
    """
    key = (spark.sparkContext.applicationId, folder)
    if key not in _ARCHIVES:
        _ARCHIVES[key] = _write_archive(spark, folder)
    return _ARCHIVES[key]


_archive = prepare


# Messages


def parse_clickstream(spark: SparkSession, folder: str) -> DataFrame:
    messages = to_event_messages(_events(spark, folder))
    return _zoneless(parse_events(messages.select(F.encode("value", "UTF-8").alias("value"))))


def event_messages(spark: SparkSession, folder: str) -> DataFrame:
    return to_event_messages(_events(spark, folder))


# Archive


def archive_partition_counts(spark: SparkSession, folder: str) -> DataFrame:
    archived = read_archive(spark, _write_archive(spark, folder))
    return archived.groupBy("event_date").agg(
        F.count("*").alias("events"), *event_type_counts()
    )


def archive_user_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Reports straight from the archive scan only the columns they count."""
    return ops.user_segments(read_archive(spark, _archive(spark, folder)), BY_DAY)


def archive_top_products(spark: SparkSession, folder: str) -> DataFrame:
    return ops.top_products(read_archive(spark, _archive(spark, folder)), by=BY_DAY)


def archive_conversion_rates(spark: SparkSession, folder: str) -> DataFrame:
    return ops.conversion_rates(read_archive(spark, _archive(spark, folder)), BY_DAY)


def load_day(spark: SparkSession, folder: str) -> DataFrame:
    return _zoneless(load_events_for_date(spark, _archive(spark, folder), REPORT_DAY))


def load_day_fallback(spark: SparkSession, folder: str) -> DataFrame:
    return _zoneless(load_events_for_date(spark, _archive(spark, folder), DAY_AFTER_DATA))


def day_before(spark: SparkSession, folder: str) -> DataFrame:
    days = _events(spark, folder).groupBy("event_date").agg(F.count("*").alias("events"))
    return days.withColumn("previous_day", previous_day("event_date"))


# Reports


def _segments(spark: SparkSession, folder: str) -> DataFrame:
    return ops.user_segments(_events(spark, folder), BY_DAY)


def user_segments_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "user-segments")
    write_report_csv(_segments(spark, folder), path)
    return read_report_csv(spark, path, f"event_date DATE, {USER_SEGMENT}")


def segment_summary(spark: SparkSession, folder: str) -> DataFrame:
    return ops.segment_summary(_segments(spark, folder), BY_DAY)


def segment_headline(spark: SparkSession, folder: str) -> DataFrame:
    return ops.segment_headline(_segments(spark, folder), BY_DAY)


def top_active_users(spark: SparkSession, folder: str) -> DataFrame:
    return ops.top_active_users(_segments(spark, folder), by=BY_DAY)


def top_active_users_overall(spark: SparkSession, folder: str) -> DataFrame:
    segments = ops.user_segments(_events(spark, folder))
    return ops.display_table(ops.top_active_users(segments))


def top_products(spark: SparkSession, folder: str) -> DataFrame:
    return ops.top_products(_events(spark, folder), by=BY_DAY)


def top_products_overall(spark: SparkSession, folder: str) -> DataFrame:
    return ops.top_products(_events(spark, folder))


def top_products_report(spark: SparkSession, folder: str) -> DataFrame:
    return ops.daily_top_products_report(_events(spark, folder))


def _undated_events(spark: SparkSession, folder: str) -> DataFrame:
    """Every seventh user's events have lost their time."""
    lost = F.substring("user_id", 2, 9).cast("int") % 7 == 0
    return _events(spark, folder).withColumns({
        name: F.when(~lost, F.col(name)) for name in ("timestamp", "event_date")
    })


def top_products_report_undated(spark: SparkSession, folder: str) -> DataFrame:
    """Events without a time are in no report."""
    return ops.daily_top_products_report(_undated_events(spark, folder))


def top_active_users_long(spark: SparkSession, folder: str) -> DataFrame:
    """More users a day than the optimizer limits by itself."""
    return ops.top_active_users(_segments(spark, folder), LONG_LIST, BY_DAY)


def display_rows(spark: SparkSession, folder: str) -> DataFrame:
    users = ops.user_segments(_events(spark, folder))
    return ops.display_table(ops.top_active_users(users), DISPLAYED_ROWS)


def _rates(spark: SparkSession, folder: str) -> DataFrame:
    return ops.conversion_rates(_events(spark, folder), BY_DAY)


def conversion_rates_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "conversion-rates")
    write_report_csv(_rates(spark, folder), path)
    return read_report_csv(spark, path, f"event_date DATE, {CONVERSION}")


def conversion_rates_overall(spark: SparkSession, folder: str) -> DataFrame:
    return ops.conversion_rates(_events(spark, folder))


def conversion_rates_display(spark: SparkSession, folder: str) -> DataFrame:
    return ops.conversion_rates_display(_rates(spark, folder))


def conversion_chart_series(spark: SparkSession, folder: str) -> DataFrame:
    return ops.conversion_chart_series(_rates(spark, folder), BY_DAY)


# Daily job


def daily_empty_day(spark: SparkSession, folder: str) -> DataFrame:
    """A day whose files have no rows: that day's reports, without users."""
    root, out = _write_archive(spark, folder), shared_folder(spark, "reports")
    nothing = _events(spark, folder).where(F.lit(False)).drop("event_date")
    nothing.write.parquet(f"{root}/event_date={DAY_AFTER_DATA}")
    run = run_daily_reports(spark, root, out, DAY_AFTER_DATA)
    bundle = build_report_bundle(spark, out, DAY_AFTER_DATA)
    return bundle.headline.select(
        F.lit(run.source_date).alias("source_date"), F.lit(run.events).alias("events"),
        "total_users", "buyers", "shoppers",
    )


def archive_reports(spark: SparkSession, folder: str) -> DataFrame:
    """The conversion rates that the job for all days of an archive wrote."""
    events = read_archive(spark, prepare(spark, folder))
    paths = write_archive_reports(spark, events, shared_folder(spark, "archive-reports"))
    return read_report_csv(
        spark, paths["conversion_rates.csv"], f"event_date DATE, {CONVERSION}"
    )


def replay_messages(spark: SparkSession, folder: str) -> DataFrame:
    """A day's events published as JSON files, and decoded again."""
    archive, out = open_archive(spark, prepare(spark, folder)), shared_folder(spark, "replay")
    publish_events(archive.read(archive.resolve(REPORT_DAY)), "json", path=out)
    return _zoneless(parse_events(spark.read.schema(MESSAGE).json(out)))


def _run_daily(spark: SparkSession, folder: str, day: str):
    out = shared_folder(spark, "reports")
    return out, run_daily_reports(spark, _archive(spark, folder), out, day)


def daily_reports(spark: SparkSession, folder: str) -> DataFrame:
    """Run counts of the job asked for a day after the data, so it falls back."""
    _, run = _run_daily(spark, folder, DAY_AFTER_DATA)
    row = (run.requested_date, run.source_date, run.events, run.users)
    return spark.createDataFrame(
        [row], "requested_date DATE, source_date DATE, events BIGINT, users BIGINT"
    )


def _bundle(spark: SparkSession, folder: str):
    out, _ = _run_daily(spark, folder, REPORT_DAY)
    return build_report_bundle(spark, out, REPORT_DAY)


def daily_headline(spark: SparkSession, folder: str) -> DataFrame:
    return _bundle(spark, folder).headline


def daily_conversion_table(spark: SparkSession, folder: str) -> DataFrame:
    return _bundle(spark, folder).conversion_table


def daily_top_products_lines(spark: SparkSession, folder: str) -> DataFrame:
    return _bundle(spark, folder).top_products_lines


def daily_top_users_table(spark: SparkSession, folder: str) -> DataFrame:
    return _bundle(spark, folder).top_users_table


# Windows and alerts


def _alerts(events: DataFrame, rule: dict = RULE) -> DataFrame:
    return ops.flash_sale_alerts(ops.sliding_window_counts(events, **WINDOWS), **rule)


def sliding_window_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = ops.sliding_window_counts(_events(spark, folder), **WINDOWS)
    return _zoneless(ops.with_window_bounds(counts))


def sliding_window_counts_10min(spark: SparkSession, folder: str) -> DataFrame:
    counts = ops.sliding_window_counts(_events(spark, folder))
    return _zoneless(ops.with_window_bounds(counts))


def sliding_window_counts_hourly(spark: SparkSession, folder: str) -> DataFrame:
    """Day windows that start every hour, so each event is in 24 of them."""
    counts = ops.sliding_window_counts(_events(spark, folder), "1 day", "1 hour")
    return _zoneless(ops.with_window_bounds(counts))


def flash_sale_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return _zoneless(_alerts(_events(spark, folder)))


def flash_sale_alert_messages(spark: SparkSession, folder: str) -> DataFrame:
    return to_alert_messages(_alerts(_events(spark, folder)))


# Streams


def _publish(events: DataFrame, root: str, days_per_group: int = DAYS_PER_GROUP) -> None:
    publish_event_files(events, root, days_per_group, FILES_PER_GROUP)


def _messages(spark: SparkSession, root: str) -> DataFrame:
    """A group of days per micro-batch."""
    return read_event_stream(
        spark, "parquet", root, MESSAGE, maxFilesPerTrigger=str(FILES_PER_GROUP)
    )


def _event_stream(
    spark: SparkSession, folder: str, days_per_group: int = DAYS_PER_GROUP
) -> DataFrame:
    root = shared_folder(spark, "messages")
    _publish(_events(spark, folder), root, days_per_group)
    return parse_events(_messages(spark, root))


def _archive_counts(archived: DataFrame) -> DataFrame:
    return archived.groupBy("event_date").agg(F.count("*").alias("events"), *event_type_counts())


def _streamed_archive(spark: SparkSession, events: DataFrame) -> str:
    """An archive that a stream of those events has written."""
    messages, root = shared_folder(spark, "messages"), shared_folder(spark, "stream-archive")
    _publish(events, messages)
    write_archive_stream(
        with_ingest_metrics(parse_events(_messages(spark, messages))),
        root, f"{root}-checkpoint", TO_THE_END,
    ).awaitTermination()
    return root


def stream_raw_archive(spark: SparkSession, folder: str) -> DataFrame:
    return _archive_counts(read_archive(spark, _streamed_archive(spark, _events(spark, folder))))


def stream_raw_archive_undated(spark: SparkSession, folder: str) -> DataFrame:
    """Events without a time are streamed last, and archived all the same."""
    root = _streamed_archive(spark, _undated_events(spark, folder))
    return _archive_counts(read_archive(spark, root))


def stream_archive_day(spark: SparkSession, folder: str) -> DataFrame:
    """The last day of a streamed archive, asked for a day that it lacks."""
    root = _streamed_archive(spark, _events(spark, folder))
    return _zoneless(load_events_for_date(spark, root, DAY_AFTER_DATA))


def stream_archive_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """A streamed archive whose days before the report day were rewritten as one file each."""
    root = _streamed_archive(spark, _undated_events(spark, folder))
    compact_closed_days(spark, root, date.fromisoformat(REPORT_DAY))
    rows = read_archive(spark, root).withColumn("path", F.input_file_name())
    rewritten = F.when(F.contains("path", F.lit("/_compacted/")), F.col("path"))
    return rows.groupBy("event_date").agg(
        F.count("*").alias("events"), *event_type_counts(),
        F.countDistinct(rewritten).alias("rewritten_files"),
    )


def _run_to_table(rows: DataFrame, root: str, mode: str) -> None:
    write_to_sinks(
        rows, [table_sink(root)], f"{root}-checkpoint", mode, TO_THE_END
    ).awaitTermination()


def _window_counts(events: DataFrame) -> DataFrame:
    return ops.with_window_bounds(ops.sliding_window_counts(events, **WINDOWS))


def _current_counts(spark: SparkSession, root: str, counts: DataFrame) -> DataFrame:
    keys = ["window_start", "window_end", "product_id", "category"]
    return _zoneless(latest_rows(spark, root, counts.schema, keys))


def _stream_counts(spark: SparkSession, folder: str, *days_per_group: int) -> DataFrame:
    """The current counts of every window after the last micro-batch."""
    root = shared_folder(spark, "counts")
    counts = _window_counts(_event_stream(spark, folder, *days_per_group))
    _run_to_table(counts, root, "update")
    return _current_counts(spark, root, counts)


def stream_sliding_window_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _stream_counts(spark, folder)


def stream_counts_many_batches(spark: SparkSession, folder: str) -> DataFrame:
    """A micro-batch for every event date, kept as snapshots and the batches behind them."""
    root = shared_folder(spark, "current-counts")
    counts = _window_counts(_event_stream(spark, folder, 1))
    keys = ("window_start", "window_end", "product_id", "category")
    table = CurrentTable(root, counts.schema, keys, BATCHES_PER_SNAPSHOT, DAY_OF_WINDOW)
    write_to_sinks(
        counts, [table.deliver], f"{root}-checkpoint", "update", TO_THE_END
    ).awaitTermination()
    return _zoneless(table.read(spark))


def stream_counts_hourly(spark: SparkSession, folder: str) -> DataFrame:
    """Day windows that start every hour, each delivered when it has closed."""
    root = shared_folder(spark, "hourly-counts")
    counts = ops.with_window_bounds(
        ops.sliding_window_counts(_event_stream(spark, folder), "1 day", "1 hour", final=True)
    )
    _run_to_table(counts, root, "append")
    return _zoneless(all_rows(spark, root, counts.schema).drop("batch_id"))


def replay_user_order(spark: SparkSession, folder: str) -> DataFrame:
    """Of every user the published messages: in how many files, and how often time goes back."""
    out = shared_folder(spark, "ordered-replay")
    publish_events(_events(spark, folder), "parquet", path=out)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")]
    messages = spark.read.schema(MESSAGE).parquet(out).select("key", "value", *place)
    times = messages.select("key", "file", "at", F.get_json_object("value", "$.timestamp").alias("time"))
    before = F.lag("time").over(Window.partitionBy("key", "file").orderBy("at"))
    return times.withColumn("before", before).groupBy(F.col("key").alias("user_id")).agg(
        F.count("*").alias("messages"),
        F.countDistinct("file").alias("files"),
        F.count_if(F.col("time") < F.col("before")).alias("steps_back"),
    )


def _stream_alerts(spark: SparkSession, folder: str, mode: str, *days_per_group: int) -> DataFrame:
    root = shared_folder(spark, "alerts")
    alerts = _alerts(_event_stream(spark, folder, *days_per_group))
    _run_to_table(alerts, root, mode)
    return _zoneless(all_rows(spark, root, alerts.schema).drop("batch_id"))


def stream_alerts_provisional(spark: SparkSession, folder: str) -> DataFrame:
    """Every alert as it was raised, batch by batch: one that changed is raised again."""
    return _stream_alerts(spark, folder, "update")


def stream_alerts_final(spark: SparkSession, folder: str) -> DataFrame:
    return _stream_alerts(spark, folder, "append")


def stream_alerts_final_many_batches(spark: SparkSession, folder: str) -> DataFrame:
    return _stream_alerts(spark, folder, "append", 1)


def stream_alert_changes(spark: SparkSession, folder: str) -> DataFrame:
    """When windows became alerts and when they ceased to be, batch by batch."""
    root, table = shared_folder(spark, "alert-changes"), shared_folder(spark, "current-counts")
    counts = _window_counts(_event_stream(spark, folder, DAYS_OF_CHANGES))
    keys = ("window_start", "window_end", "product_id", "category")
    current = CurrentTable(table, counts.schema, keys, BATCHES_PER_SNAPSHOT, DAY_OF_WINDOW)
    changes = AlertChanges(current, root, **RULE)
    write_to_sinks(
        counts, [changes.deliver], f"{root}-checkpoint", "update", TO_THE_END
    ).awaitTermination()
    layout = _alerts(_events(spark, folder)).schema.add("change", "string")
    return _zoneless(all_rows(spark, root, layout).drop("batch_id"))


def stream_junk(spark: SparkSession, folder: str) -> DataFrame:
    """Messages of which every fifth user's are cut, empty or wrongly typed, kept as they came."""
    published, root = shared_folder(spark, "messages"), shared_folder(spark, "junk")
    _publish(_events(spark, folder), published)
    user = F.substring("key", 2, 9).cast("int") % 20
    spoilt = (
        F.when(user == 3, F.expr("left(value, length(value) - 9)"))
        .when(user == 7, F.lit("{}"))
        .when(user == 11, F.regexp_replace("value", '"timestamp":"[^"]*"', '"timestamp":"soon"'))
        .otherwise(F.col("value"))
    )
    messages = _messages(spark, published).withColumn("value", F.encode(spoilt, "UTF-8"))
    write_junk_stream(messages, root, f"{root}-checkpoint", TO_THE_END).awaitTermination()
    rows = spark.read.schema("key STRING, value BINARY, reason STRING").parquet(root)
    return rows.select("key", F.decode("value", "UTF-8").alias("value"), "reason")


def _days_span(events: DataFrame) -> tuple:
    return tuple(events.agg(F.min("event_date"), F.max("event_date")).first())


def stream_late_events(spark: SparkSession, folder: str) -> DataFrame:
    """The first day's events come last: they are archived, and are in no window."""
    events, messages = _events(spark, folder), shared_folder(spark, "messages")
    first, _ = _days_span(events)
    is_late = F.col("event_date") == F.lit(first)
    _publish(events.where(~is_late), messages)
    _publish(events.where(is_late), messages)
    parsed = parse_events(_messages(spark, messages))
    archive, root = shared_folder(spark, "late-archive"), shared_folder(spark, "late-counts")
    write_archive_stream(parsed, archive, f"{archive}-checkpoint", TO_THE_END).awaitTermination()
    counts = _window_counts(parsed)
    _run_to_table(counts, root, "update")
    columns = ["views", "cart_adds", "purchases"]
    archived = _archive_counts(read_archive(spark, archive)).select(
        F.lit("archive").alias("kept_in"),
        F.col("event_date").cast("timestamp_ntz").alias("start"),
        F.lit(None).cast("string").alias("product_id"),
        *columns,
    )
    windows = _current_counts(spark, root, counts).select(
        F.lit("window").alias("kept_in"), F.col("window_start").alias("start"), "product_id", *columns
    )
    return archived.unionByName(windows)


def stream_restart(spark: SparkSession, folder: str) -> DataFrame:
    """Stopped after half of the days and started again on the same checkpoint."""
    events, messages = _events(spark, folder), shared_folder(spark, "messages")
    first, last = _days_span(events)
    early = F.col("event_date") <= F.lit(first + (last - first) / 2)
    root = shared_folder(spark, "restarted-counts")
    for part in (early, ~early):
        _publish(events.where(part), messages)
        counts = _window_counts(parse_events(_messages(spark, messages)))
        _run_to_table(counts, root, "update")
    return _current_counts(spark, root, counts)


def _run_pipeline(spark: SparkSession, folder: str, **sinks) -> str:
    """Both queries of the pipeline over the table's messages, until their end."""
    messages, archive = shared_folder(spark, "messages"), shared_folder(spark, "pipeline-archive")
    _publish(_events(spark, folder), messages)
    config = PipelineConfig(
        archive=archive, checkpoints=f"{archive}-checkpoints", alert_mode="append",
        archive_trigger=TO_THE_END, alert_trigger=TO_THE_END, **WINDOWS, **RULE, **sinks,
    )
    for query in start_pipeline(_messages(spark, messages), config).values():
        query.awaitTermination()
    return archive


def pipeline_archive(spark: SparkSession, folder: str) -> DataFrame:
    return _archive_counts(read_archive(spark, _run_pipeline(spark, folder, alert_sinks=[])))


def pipeline_alerts(spark: SparkSession, folder: str) -> DataFrame:
    root, layout = shared_folder(spark, "pipeline-alerts"), _alerts(_events(spark, folder)).schema
    _run_pipeline(spark, folder, alert_sinks=[table_sink(root)])
    return _zoneless(all_rows(spark, root, layout).drop("batch_id"))


def entry(spark: SparkSession) -> DataFrame:
    """Flash-sale alerts on the smallest test tables."""
    return _zoneless(_alerts(_events(spark, SMOKE_FOLDER), SMOKE_RULE))


def _corpus_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    pipeline = {"pipeline": corpus_pipeline.run} if corpus_pipeline else {}
    return pipeline | (corpus.QUERIES if corpus else {})


def _corpus_sql() -> dict[str, str]:
    sql = corpus_pipeline.ORACLE_SQL if corpus_pipeline else None
    return ({"pipeline": sql} if sql else {}) | (corpus.ORACLE_SQL if corpus else {})


def event_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "parse_clickstream": parse_clickstream,
        "event_messages": event_messages,
        "archive_partition_counts": archive_partition_counts,
        "archive_user_segments": archive_user_segments,
        "archive_top_products": archive_top_products,
        "archive_conversion_rates": archive_conversion_rates,
        "load_events_for_date": load_day,
        "load_events_fallback": load_day_fallback,
        "previous_day": day_before,
        "user_segments": _segments,
        "user_segments_csv_roundtrip": user_segments_csv,
        "segment_summary": segment_summary,
        "segment_headline": segment_headline,
        "top_active_users": top_active_users,
        "top_active_users_overall": top_active_users_overall,
        "top_products": top_products,
        "top_products_overall": top_products_overall,
        "top_products_report": top_products_report,
        "top_products_report_undated": top_products_report_undated,
        "top_active_users_long": top_active_users_long,
        "display_rows": display_rows,
        "conversion_rates": _rates,
        "conversion_rates_csv_roundtrip": conversion_rates_csv,
        "conversion_rates_overall": conversion_rates_overall,
        "conversion_rates_display": conversion_rates_display,
        "conversion_chart_series": conversion_chart_series,
        "archive_reports": archive_reports,
        "replay_messages": replay_messages,
        "daily_empty_day": daily_empty_day,
        "daily_reports": daily_reports,
        "daily_headline": daily_headline,
        "daily_conversion_table": daily_conversion_table,
        "daily_top_products_lines": daily_top_products_lines,
        "daily_top_users_table": daily_top_users_table,
        "sliding_window_counts": sliding_window_counts,
        "sliding_window_counts_10min": sliding_window_counts_10min,
        "sliding_window_counts_hourly": sliding_window_counts_hourly,
        "flash_sale_alerts": flash_sale_alerts,
        "flash_sale_alert_messages": flash_sale_alert_messages,
        "replay_user_order": replay_user_order,
        "stream_raw_archive": stream_raw_archive,
        "stream_raw_archive_undated": stream_raw_archive_undated,
        "stream_archive_day": stream_archive_day,
        "stream_archive_compacted": stream_archive_compacted,
        "stream_counts_hourly": stream_counts_hourly,
        "stream_alert_changes": stream_alert_changes,
        "stream_junk": stream_junk,
        "stream_sliding_window_counts": stream_sliding_window_counts,
        "stream_alerts_provisional": stream_alerts_provisional,
        "stream_alerts_final": stream_alerts_final,
        "stream_counts_many_batches": stream_counts_many_batches,
        "stream_alerts_final_many_batches": stream_alerts_final_many_batches,
        "stream_late_events": stream_late_events,
        "stream_restart": stream_restart,
        "pipeline_archive": pipeline_archive,
        "pipeline_alerts": pipeline_alerts,
    }


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return event_queries() | _corpus_queries()


# The same results in SQL


def _clickstream_sql() -> str:
    categories = " ".join(f"WHEN '{product}' THEN '{name}'" for product, name in CATALOGUE.items())
    return f"""
    WITH numbered AS (
        SELECT printf('U%04d', user_id) AS user_id,
               printf('P%03d', CAST(json_extract_string(props, '$.k') AS INT) % {len(CATALOGUE)} + 1)
                   AS product_id,
               CASE event_type WHEN 'click' THEN 'add_to_cart' ELSE event_type END AS event_type,
               ts AS "timestamp", CAST(ts AS DATE) AS event_date
        FROM events),
    c AS (SELECT *, CASE product_id {categories} END AS category FROM numbered)"""


_COUNTS = ", ".join(
    f"CAST(sum(CASE WHEN event_type = '{kind}' THEN 1 ELSE 0 END) AS BIGINT) AS {name}"
    for kind, name in (("view", "views"), ("add_to_cart", "cart_adds"), ("purchase", "purchases"))
)
_RATE = "CASE WHEN views > 0 THEN purchases::DOUBLE / views ELSE 0.0::DOUBLE END"
_ON_DAY = f"WHERE event_date = DATE '{REPORT_DAY}'"
_EVENT_COLUMNS = 'user_id, product_id, category, event_type, "timestamp", event_date'


def _segments_sql(day: str, where: str = "") -> str:
    return f"""
    SELECT *, CASE WHEN purchases >= 1 THEN 'BUYER' ELSE 'WINDOW_SHOPPER' END AS segment
    FROM (SELECT {day} user_id, {_COUNTS} FROM c {where} GROUP BY {day} user_id)"""


def _headline_sql(day: str, where: str = "") -> str:
    group = f"GROUP BY {day.rstrip(', ')}" if day else ""
    return f"""
    SELECT *, printf('%.1f%%', buyer_percent) AS buyer_label,
           printf('%.1f%%', shopper_percent) AS shopper_label
    FROM (SELECT *, total_users - buyers AS shoppers,
                 buyers::DOUBLE / total_users * 100 AS buyer_percent,
                 100 - buyers::DOUBLE / total_users * 100 AS shopper_percent
          FROM (SELECT {day} count(*) AS total_users,
                       count(*) FILTER (WHERE segment = 'BUYER') AS buyers
                FROM ({_segments_sql(day, where)}) {group}))"""


def _rates_sql(day: str, where: str = "") -> str:
    return f"""
    SELECT *, {_RATE} AS conversion_rate
    FROM (SELECT {day} category, {_COUNTS} FROM c {where} GROUP BY {day} category)"""


def _rates_text_sql(day: str, where: str = "") -> str:
    day_text = "CAST(event_date AS VARCHAR) AS event_date," if day else ""
    counts = ", ".join(f"CAST({n} AS VARCHAR) AS {n}" for n in ("views", "cart_adds", "purchases"))
    return f"""
    SELECT {day_text} category, {counts},
           CAST(round_even(conversion_rate * 100, 2) AS VARCHAR) || '%' AS conversion_rate
    FROM ({_rates_sql(day, where)})"""


def _top_products_sql(day: str, where: str = "") -> str:
    partition = f"PARTITION BY {day.rstrip(', ')}" if day else ""
    return f"""
    SELECT * FROM (
        SELECT {day} product_id, category, view_count,
               CAST(row_number() OVER ({partition}
                    ORDER BY view_count DESC, product_id, category) AS INT) AS "rank"
        FROM (SELECT {day} product_id, category, count(*) AS view_count
              FROM c {where} {'AND' if where else 'WHERE'} event_type = 'view'
              GROUP BY {day} product_id, category))
    WHERE "rank" <= 5"""


def _report_sql(where: str = "") -> str:
    frame = f"""
        (1, repeat('=', 64)), (2, '  Top 5 Most-Viewed Products  -  ' || report_date),
        (3, repeat('=', 64)),
        (4, printf('%-6s%-10s%-16s%10s', 'Rank', 'Product', 'Category', 'Views')),
        (5, repeat('-', 64)), (11, repeat('=', 64))"""
    return f"""
    SELECT report_date, line_no, line
    FROM (SELECT DISTINCT CAST(event_date AS VARCHAR) AS report_date FROM c {where}),
         LATERAL (VALUES {frame}) AS frame(line_no, line)
    UNION ALL
    SELECT CAST(event_date AS VARCHAR), "rank" + 5,
           printf('%-6d%-10s%-16s%10s', "rank", product_id, category,
                  format('{{:,}}', view_count))
    FROM ({_top_products_sql('event_date,', where)})"""


def _top_users_sql(day: str, where: str = "", k: int = 25) -> str:
    partition = f"PARTITION BY {day.rstrip(', ')}" if day else ""
    return f"""
    SELECT * FROM ({_segments_sql(day, where)})
    QUALIFY row_number() OVER ({partition} ORDER BY purchases DESC, views DESC, user_id) <= {k}"""


def _as_text_sql(columns: list[str], table: str) -> str:
    texts = ", ".join(f"CAST({name} AS VARCHAR) AS {name}" for name in columns)
    return f"SELECT {texts} FROM ({table})"


def _windows_sql(size: str, slide: str, copies: int, days: str = "", where: str = "") -> str:
    per = f"{days} AS days," if days else ""
    return f"""
    SELECT {per} window_start, window_start + INTERVAL {size} AS window_end, product_id,
           category, {_COUNTS}
    FROM (SELECT c.*, time_bucket(INTERVAL {slide}, "timestamp", TIMESTAMP '1970-01-01')
                      - r.i * INTERVAL {slide} AS window_start
          FROM c, range({copies}) r(i) {where})
    GROUP BY {'days,' if days else ''} window_start, product_id, category"""


def _windows_by_file_sql(days_per_group: int = DAYS_PER_GROUP) -> str:
    """What a window holds after each group of days that adds to it."""
    days = f"(event_date - DATE '1970-01-01') // {days_per_group}"
    sums = ", ".join(
        f"CAST(sum({name}) OVER upto AS BIGINT) AS {name}"
        for name in ("views", "cart_adds", "purchases")
    )
    return f"""
    SELECT days, window_start, window_end, product_id, category, {sums}
    FROM ({_windows_sql('1 DAY', '12 HOUR', 2, days)})
    WINDOW upto AS (PARTITION BY window_start, product_id, category ORDER BY days)"""


_ALERT_SQL = """product_id, category, window_start, window_end, views, purchases, cart_adds,
           'FLASH_SALE_SUGGESTED' AS alert_type,
           'High interest, low conversion - consider a discount or flash sale.' AS recommendation"""


def _alert_changes_sql() -> str:
    return f"""
    SELECT {_ALERT_SQL}, CASE WHEN now THEN 'raised' ELSE 'withdrawn' END AS change
    FROM (SELECT *, views > 5 AND purchases < 5 AS now,
                 coalesce(lag(views > 5 AND purchases < 5) OVER before, false) AS earlier
          FROM ({_windows_by_file_sql(DAYS_OF_CHANGES)})
          WINDOW before AS (PARTITION BY window_start, product_id, category ORDER BY days))
    WHERE now <> earlier"""


def _alerts_sql(windows: str = "") -> str:
    return f"""
    SELECT {_ALERT_SQL}
    FROM ({windows or _windows_sql('1 DAY', '12 HOUR', 2)}) WHERE views > 5 AND purchases < 5"""


def _closed_alerts_sql() -> str:
    return f"""
    SELECT * FROM ({_alerts_sql()})
    WHERE window_end <= (SELECT max("timestamp") FROM c) - INTERVAL 2 MINUTE"""


def oracle_sql() -> dict[str, str]:
    by_day = "event_date,"
    segments = _segments_sql(by_day)
    rates = _rates_sql(by_day)
    archive_counts = f"SELECT event_date, count(*) AS events, {_COUNTS} FROM c GROUP BY event_date"
    windows = _windows_sql("1 DAY", "12 HOUR", 2)
    iso = "'%Y-%m-%dT%H:%M:%S"
    undated_counts = f"""
        SELECT event_date, count(*) AS events, {_COUNTS}
        FROM (SELECT user_id, event_type,
                     CASE WHEN CAST(user_id[2:] AS INT) % 7 <> 0 THEN event_date END AS event_date FROM c)
        GROUP BY event_date"""
    event_texts = f"""
            SELECT user_id AS "key",
                   '{{"user_id":"' || user_id || '","product_id":"' || product_id
                   || '","category":"' || category || '","event_type":"' || event_type
                   || '","timestamp":"' || strftime("timestamp", {iso}.%f+00:00') || '"}}'
                       AS "value"
            FROM c"""
    user_columns = ["user_id", "views", "cart_adds", "purchases", "segment"]
    later = "WHERE event_date > (SELECT min(event_date) FROM c)"
    dated = "WHERE CAST(user_id[2:] AS INT) % 7 <> 0"
    bodies = {
        "parse_clickstream": f"SELECT {_EVENT_COLUMNS} FROM c",
        "event_messages": event_texts,
        "archive_partition_counts": archive_counts,
        "archive_user_segments": segments,
        "archive_top_products": _top_products_sql(by_day),
        "archive_conversion_rates": rates,
        "load_events_for_date": f"SELECT {_EVENT_COLUMNS} FROM c {_ON_DAY}",
        "load_events_fallback": f"""
            SELECT {_EVENT_COLUMNS} FROM c WHERE event_date = (SELECT max(event_date) FROM c)""",
        "previous_day": """
            SELECT event_date, count(*) AS events,
                   CAST(CAST(event_date - 1 AS DATE) AS VARCHAR) AS previous_day
            FROM c GROUP BY event_date""",
        "user_segments": segments,
        "user_segments_csv_roundtrip": segments,
        "segment_summary": f"""
            SELECT event_date, segment, count(*) AS users FROM ({segments})
            GROUP BY event_date, segment""",
        "segment_headline": _headline_sql(by_day),
        "top_active_users": _top_users_sql(by_day),
        "top_active_users_overall": _as_text_sql(user_columns, _top_users_sql("")),
        "top_products": _top_products_sql(by_day),
        "top_products_overall": _top_products_sql(""),
        "top_products_report": _report_sql(),
        "top_products_report_undated": _report_sql(dated),
        "top_active_users_long": _top_users_sql(by_day, k=LONG_LIST),
        "display_rows": _as_text_sql(user_columns, _top_users_sql("", k=DISPLAYED_ROWS)),
        "conversion_rates": rates,
        "conversion_rates_csv_roundtrip": rates,
        "conversion_rates_overall": _rates_sql(""),
        "conversion_rates_display": _rates_text_sql(by_day),
        "conversion_chart_series": f"""
            SELECT event_date, category, conversion_rate * 100 AS percent,
                   printf('%.1f%%', conversion_rate * 100) AS label FROM ({rates})""",
        "archive_reports": rates,
        "replay_messages": f"SELECT {_EVENT_COLUMNS} FROM c {_ON_DAY}",
        "daily_empty_day": f"""
            SELECT DATE '{DAY_AFTER_DATA}' AS source_date, 0::BIGINT AS events,
                   0::BIGINT AS total_users, 0::BIGINT AS buyers, 0::BIGINT AS shoppers
            FROM c HAVING count(*) > 0""",
        "daily_reports": f"""
            SELECT DATE '{DAY_AFTER_DATA}' AS requested_date, max(event_date) AS source_date,
                   count(*) AS events, count(DISTINCT user_id) AS users
            FROM c WHERE event_date = (SELECT max(event_date) FROM c)""",
        "daily_headline": _headline_sql("", _ON_DAY),
        "daily_conversion_table": _rates_text_sql("", _ON_DAY),
        "daily_top_products_lines": f'SELECT line AS "value" FROM ({_report_sql(_ON_DAY)})',
        "daily_top_users_table": _as_text_sql(user_columns, _top_users_sql("", _ON_DAY)),
        "sliding_window_counts": windows,
        "sliding_window_counts_10min": _windows_sql("10 MINUTE", "5 MINUTE", 2),
        "sliding_window_counts_hourly": _windows_sql("1 DAY", "1 HOUR", 24),
        "flash_sale_alerts": _alerts_sql(),
        "flash_sale_alert_messages": f"""
            SELECT product_id AS "key",
                   '{{"product_id":"' || product_id || '","category":"' || category
                   || '","window_start":"' || strftime(window_start, {iso}.000Z')
                   || '","window_end":"' || strftime(window_end, {iso}.000Z')
                   || '","views":' || views || ',"purchases":' || purchases
                   || ',"cart_adds":' || cart_adds || ',"alert_type":"' || alert_type
                   || '","recommendation":"' || recommendation || '"}}' AS "value"
            FROM ({_alerts_sql()})""",
        "replay_user_order": """
            SELECT user_id, count(*) AS messages, 1::BIGINT AS files, 0::BIGINT AS steps_back
            FROM c GROUP BY user_id""",
        "stream_raw_archive": archive_counts,
        "stream_raw_archive_undated": undated_counts,
        "stream_archive_day": f"""
            SELECT {_EVENT_COLUMNS} FROM c WHERE event_date = (SELECT max(event_date) FROM c)""",
        "stream_archive_compacted": f"""
            SELECT *, CASE WHEN event_date < DATE '{REPORT_DAY}' THEN 1 ELSE 0 END::BIGINT AS rewritten_files
            FROM ({undated_counts})""",
        "stream_alert_changes": _alert_changes_sql(),
        "stream_junk": f"""
            SELECT "key",
                   CASE n WHEN 3 THEN "value"[:-10] WHEN 7 THEN '{{}}'
                          ELSE regexp_replace("value", '"timestamp":"[^"]*"', '"timestamp":"soon"') END AS "value",
                   CASE n WHEN 3 THEN 'malformed' WHEN 7 THEN 'no known field' ELSE 'wrong type' END AS reason
            FROM (SELECT *, CAST("key"[2:] AS INT) % 20 AS n FROM ({event_texts})) WHERE n IN (3, 7, 11)""",
        "stream_counts_hourly": f"""
            SELECT * FROM ({_windows_sql("1 DAY", "1 HOUR", 24)})
            WHERE window_end <= (SELECT max("timestamp") FROM c) - INTERVAL 2 MINUTE""",
        "stream_sliding_window_counts": windows,
        "stream_alerts_provisional": _alerts_sql(_windows_by_file_sql()),
        "stream_alerts_final": _closed_alerts_sql(),
        "stream_counts_many_batches": windows,
        "stream_alerts_final_many_batches": _closed_alerts_sql(),
        "stream_late_events": f"""
            SELECT 'archive' AS kept_in, CAST(event_date AS TIMESTAMP) AS "start",
                   CAST(NULL AS VARCHAR) AS product_id, views, cart_adds, purchases
            FROM ({archive_counts})
            UNION ALL
            SELECT 'window', window_start, product_id, views, cart_adds, purchases
            FROM ({_windows_sql('1 DAY', '12 HOUR', 2, where=later)})""",
        "stream_restart": windows,
        "pipeline_archive": archive_counts,
        "pipeline_alerts": _closed_alerts_sql(),
    }
    prefix = _clickstream_sql()
    return {name: f"{prefix}\n{body}" for name, body in bodies.items()} | _corpus_sql()
