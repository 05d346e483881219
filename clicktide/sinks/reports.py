"""Writing reports: CSV tables with a header, and text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clicktide.sources.reports import CSV_FORMAT

# A reader cannot split a CSV file whose text may hold line breaks.
MAX_ROWS_PER_FILE = 5_000_000


def write_report_csv(report: DataFrame, path: str) -> None:
    """Write a table as CSV, replacing an earlier run's.

    Parts keep the order of a sorted table. Nothing is gathered into one task:
    adaptive execution leaves a small report in one part and a large one in many.
    """
    writer = report.write.mode("overwrite").options(**CSV_FORMAT)
    writer.option("maxRecordsPerFile", MAX_ROWS_PER_FILE).csv(path)


def write_report_text(lines: DataFrame, path: str) -> None:
    """Write ``line`` in the order of ``line_no``, replacing an earlier run's.

    For one top-k report: its ``k`` lines and their frame make one file.
    """
    ordered = lines.repartition(1).sortWithinPartitions("line_no")
    ordered.select("line").write.mode("overwrite").text(path)
