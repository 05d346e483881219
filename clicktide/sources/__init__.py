from clicktide.sources.archive import (
    Archive,
    archive_dates,
    day_bytes,
    load_events_for_date,
    open_archive,
    read_archive,
    resolve_event_date,
)
from clicktide.sources.messages import (
    junk_messages,
    kafka_source_options,
    parse_events,
    read_event_stream,
    to_alert_messages,
    to_event_messages,
    with_ingest_metrics,
)
from clicktide.sources.reports import read_report_csv, read_report_text, require_reports

__all__ = [
    "Archive", "archive_dates", "day_bytes", "junk_messages", "kafka_source_options", "load_events_for_date",
    "open_archive", "parse_events", "read_archive", "read_event_stream", "read_report_csv",
    "read_report_text", "require_reports", "resolve_event_date", "to_alert_messages",
    "to_event_messages", "with_ingest_metrics",
]
