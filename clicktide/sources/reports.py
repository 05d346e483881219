"""Reading finished reports back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clicktide.sources.archive import path_exists

# Quotes are doubled as in RFC 4180, and text keeps its spaces.
CSV_FORMAT = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_report_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV report under its declared layout; inference would turn id 007 into 7.

    Line breaks within text are kept. So is an empty text, which is written in
    quotes: the reader's mark for a null must be another than the empty text.
    """
    reader = spark.read.schema(schema).options(**CSV_FORMAT)
    return reader.options(multiLine="true", nullValue="\0").csv(path)


def read_report_text(spark: SparkSession, path: str) -> DataFrame:
    """A text report, one row ``value`` per line."""
    return spark.read.text(path)


def require_reports(spark: SparkSession, *paths: str) -> None:
    """``FileNotFoundError`` naming the reports that are not there, or not finished.

    A report is a folder; the writer leaves ``_SUCCESS`` in it when all parts are there.
    """
    missing = [path for path in paths if not path_exists(spark, f"{path}/_SUCCESS")]
    if missing:
        raise FileNotFoundError(f"run the daily reports first, missing: {', '.join(missing)}")
