"""The running pipeline: archive everything, alert on what is happening."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clicktide.operators import flash_sale_alerts, sliding_window_counts
from clicktide.schemas import (
    ALERT_PURCHASES_UNDER,
    ALERT_VIEWS_OVER,
    ALLOWED_LATENESS,
    ARCHIVE_TRIGGER,
    WINDOW_SIZE,
    WINDOW_SLIDE,
)
from clicktide.sinks.alerts import BatchSink, console_sink, write_to_sinks
from clicktide.sinks.archive import write_archive_stream, write_junk_stream
from clicktide.sources.messages import parse_events, with_ingest_metrics


@dataclass(frozen=True)
class PipelineConfig:
    """Where the pipeline keeps its data, and the alert rule; ``junk``, if given, is the table of
    messages that cannot be parsed."""

    archive: str
    checkpoints: str
    alert_sinks: Sequence[BatchSink] = field(default_factory=lambda: [console_sink()])
    size: str = WINDOW_SIZE
    slide: str = WINDOW_SLIDE
    lateness: str = ALLOWED_LATENESS
    views_over: int = ALERT_VIEWS_OVER
    purchases_under: int = ALERT_PURCHASES_UNDER
    alert_mode: str = "update"
    archive_trigger: dict = field(default_factory=lambda: dict(ARCHIVE_TRIGGER))
    archive_files: int | None = None
    alert_trigger: dict | None = None
    junk: str | None = None


def detect_alerts(events: DataFrame, config: PipelineConfig) -> DataFrame:
    final = config.alert_mode == "append"
    counts = sliding_window_counts(events, config.size, config.slide, config.lateness, final)
    return flash_sale_alerts(counts, config.views_over, config.purchases_under)


def start_pipeline(messages: DataFrame, config: PipelineConfig) -> dict[str, StreamingQuery]:
    """Start the queries over one message stream, each with its own checkpoint.

    Started again on the same checkpoints, they go on where they stopped. Alert
    batches reach all sinks from a single stateful query.
    """
    events = parse_events(messages)
    junk = {}
    if config.junk:
        junk["junk"] = write_junk_stream(
            messages, config.junk, f"{config.checkpoints}/junk", config.archive_trigger
        )
    return junk | {
        "archive": write_archive_stream(
            with_ingest_metrics(events),
            config.archive,
            f"{config.checkpoints}/archive",
            config.archive_trigger,
            config.archive_files,
        ),
        "alerts": write_to_sinks(
            detect_alerts(events, config),
            config.alert_sinks,
            f"{config.checkpoints}/alerts",
            config.alert_mode,
            config.alert_trigger,
        ),
    }


def run_pipeline(spark: SparkSession, messages: DataFrame, config: PipelineConfig) -> None:
    """Run until one of the queries ends or fails; a failure is raised here."""
    spark.streams.resetTerminated()
    start_pipeline(messages, config)
    spark.streams.awaitAnyTermination()
