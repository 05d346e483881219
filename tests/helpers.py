"""Small planted tables."""

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession

from clicktide.functions import utc_date
from clicktide.schemas import CLICKSTREAM

NOON = datetime(2026, 1, 1, 12, tzinfo=timezone.utc)


def at(minutes: float, base: datetime = NOON) -> datetime:
    return base + timedelta(minutes=minutes)


def event(kind="view", user="U1", product="P1", category="C1", time=NOON) -> tuple:
    return (user, product, category, kind, time)


def events_of(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, CLICKSTREAM).withColumn("event_date", utc_date("timestamp"))


def as_set(frame: DataFrame) -> set[tuple]:
    rows = [tuple(row) for row in frame.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def as_list(frame: DataFrame) -> list[tuple]:
    return [tuple(row) for row in frame.collect()]


def utc(moment: datetime) -> datetime:
    """Collected timestamps are naive, in the zone of this process."""
    return moment.astimezone(timezone.utc) if moment.tzinfo is None else moment
