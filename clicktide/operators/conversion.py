"""Purchases per view, by category."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from clicktide.functions import (
    event_type_counts, guarded_ratio, known, percent_label, percent_text,
)


def conversion_rates(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``category, views, cart_adds, purchases, conversion_rate``, best rate first.

    A category without views has rate 0.0. Events without a category or a type are
    left out; other types are not counted, but their category is listed.
    """
    counts = (
        events.where(known(*by, "category", "event_type"))
        .groupBy(*by, "category")
        .agg(*event_type_counts())
    )
    return rate_categories(counts, by)


def rate_categories(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Add the rate to finished counts and sort; ties by ascending category."""
    rated = counts.withColumn("conversion_rate", guarded_ratio("purchases", "views"))
    return rated.orderBy(*by, F.desc("conversion_rate"), F.asc("category"))


def conversion_rates_display(rates: DataFrame) -> DataFrame:
    """All columns as text, the rate as a percentage of at most two decimals."""
    return display_table(rates.withColumn("conversion_rate", percent_text("conversion_rate")))


def conversion_chart_series(rates: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``category, percent, label``: bar heights and bar labels in rate order."""
    percent = F.col("conversion_rate") * 100
    return rates.select(
        *by, "category", percent.alias("percent"), percent_label(percent).alias("label")
    )


def display_table(table: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Every column as text, optionally only the first ``max_rows`` rows."""
    shown = table if max_rows is None else table.limit(max_rows)
    return shown.select(*[shown[name].cast("string").alias(name) for name in shown.columns])
