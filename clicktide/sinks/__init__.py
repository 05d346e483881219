from clicktide.sinks.alerts import (
    all_rows,
    console_sink,
    kafka_sink_options,
    latest_rows,
    message_sink,
    table_sink,
    write_alerts_console,
    write_alerts_messages,
    write_to_sinks,
)
from clicktide.sinks.archive import write_archive, write_archive_stream, write_junk_stream
from clicktide.sinks.changes import AlertChanges
from clicktide.sinks.compaction import compact_closed_days, compact_day
from clicktide.sinks.current import CurrentTable
from clicktide.sinks.events import publish_event_files, publish_events
from clicktide.sinks.reports import write_report_csv, write_report_text

__all__ = [
    "AlertChanges", "CurrentTable", "all_rows", "compact_closed_days", "compact_day",
    "console_sink", "kafka_sink_options", "latest_rows", "message_sink", "publish_event_files",
    "publish_events", "table_sink", "write_alerts_console", "write_alerts_messages",
    "write_archive", "write_archive_stream", "write_junk_stream", "write_report_csv",
    "write_report_text", "write_to_sinks",
]
