"""Event-time expressions that do not depend on the session time zone."""

from __future__ import annotations

import math
from functools import lru_cache

from pyspark.sql import Column, SparkSession, functions as F

from clicktide.functions._columns import ColumnOrName, as_column

SECONDS_PER_DAY = 86400


def utc_date(timestamp: ColumnOrName) -> Column:
    """UTC calendar day of a timestamp; ``to_date`` would use the session's zone."""
    days = F.floor(F.unix_seconds(as_column(timestamp)) / SECONDS_PER_DAY)
    return F.date_from_unix_date(days.cast("int"))


def previous_day(day: ColumnOrName) -> Column:
    """ISO text of the day before ``day`` (a date, or its ISO text)."""
    return F.date_sub(as_column(day).cast("date"), 1).cast("string")


@lru_cache(maxsize=256)
def duration_micros(duration: str) -> int:
    """Length of a duration as Spark reads it, so every one that ``window`` takes is known.

    Asking Spark costs a statement; a text is asked once, as it means the same in any session.
    """
    length = SparkSession.active().sql(
        "SELECT timestampdiff(MICROSECOND, start, start + CAST(:duration AS INTERVAL))"
        " FROM (SELECT TIMESTAMP_NTZ'1970-01-01 00:00:00' AS start)",
        {"duration": duration},
    ).first()[0]
    if length is None:
        raise ValueError(f"not a duration: {duration}")
    return length


def window_copies(size: str, slide: str) -> float:
    """How many windows an event falls into."""
    return duration_micros(size) / duration_micros(slide)


def pane_width(size: str, slide: str) -> str:
    """Longest pane of which both the window size and the slide are multiples."""
    return f"{math.gcd(duration_micros(size), duration_micros(slide))} microseconds"
