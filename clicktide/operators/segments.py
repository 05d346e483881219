"""Buyers and window shoppers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from clicktide.functions import event_type_counts, guarded_ratio, known, percent_label
from clicktide.operators.ranking import top_rows
from clicktide.schemas import BUYER, TOP_USERS, WINDOW_SHOPPER


def user_segments(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``user_id, views, cart_adds, purchases, segment``, one row per user.

    A user with at least one purchase is a buyer. Events without a user or a type
    are left out; other types are not counted, but their user is listed.
    ``by=["event_date"]`` gives the report of every day in one pass.
    """
    counts = (
        events.where(known(*by, "user_id", "event_type"))
        .groupBy(*by, "user_id")
        .agg(*event_type_counts())
    )
    segment = F.when(F.col("purchases") >= 1, F.lit(BUYER)).otherwise(F.lit(WINDOW_SHOPPER))
    return counts.withColumn("segment", segment)


def segment_summary(segments: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``segment, users``."""
    return segments.groupBy(*by, "segment").agg(F.count("*").alias("users"))


def segment_headline(segments: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Users, buyers and shoppers with their shares; one row even without users."""
    totals = segments.groupBy(*by).agg(
        F.count("*").alias("total_users"),
        F.count_if(F.col("segment") == BUYER).alias("buyers"),
    )
    return (
        totals.withColumns({
            "shoppers": F.col("total_users") - F.col("buyers"),
            "buyer_percent": guarded_ratio("buyers", "total_users") * 100,
        })
        .withColumn("shopper_percent", 100 - F.col("buyer_percent"))
        .withColumns({
            "buyer_label": percent_label("buyer_percent"),
            "shopper_label": percent_label("shopper_percent"),
        })
    )


def top_active_users(
    segments: DataFrame, k: int = TOP_USERS, by: Sequence[str] = ()
) -> DataFrame:
    """The ``k`` users with most purchases, then views; ties by ascending id."""
    order = [F.desc("purchases"), F.desc("views"), F.asc("user_id")]
    return top_rows(segments, k, order, by)
