"""Event-type counts per sliding window, product and category."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clicktide.functions import event_type_counts, pane_width, summed_counts, window_copies
from clicktide.schemas import ALLOWED_LATENESS, WINDOW_SIZE, WINDOW_SLIDE

# Measured: with fewer copies the panes' second shuffle costs more than it saves.
PANES_FROM_COPIES = 4


def sliding_window_counts(
    events: DataFrame,
    size: str = WINDOW_SIZE,
    slide: str = WINDOW_SLIDE,
    lateness: str = ALLOWED_LATENESS,
    final: bool = False,
) -> DataFrame:
    """``window, product_id, category, views, cart_adds, purchases``.

    Works on a table and on a stream. An event counts in every half-open,
    epoch-aligned window around its time; events without a time are in none.
    A missing product or category forms a group of its own.

    Normally an event is copied into its windows within the task and counted there,
    so the shuffle carries partial counts only; a stream has a watermark of
    ``lateness`` on top. Where windows overlap many times, events are first reduced to
    disjoint panes, and only the pane totals are copied.

    On a stream panes need ``final``, which promises that the sink's output mode is
    ``append``: no other mode allows one stateful aggregation above another. A pane goes
    on to its windows when the watermark has passed it, so state holds an event once and
    not once per window, and an event is late when its pane has closed, even for windows
    that still are open. A checkpoint belongs to one way of counting.
    """
    products = [F.col("product_id"), F.col("category")]
    overlap = (final or not events.isStreaming) and window_copies(size, slide) >= PANES_FROM_COPIES
    if events.isStreaming:
        events = events.withWatermark("timestamp", lateness)
    if not overlap:
        return events.groupBy(F.window("timestamp", size, slide), *products).agg(
            *event_type_counts()
        )
    panes = events.groupBy(
        F.window("timestamp", pane_width(size, slide)).alias("pane"), *products
    ).agg(*event_type_counts())
    # the last instant of a pane is in the windows that hold the pane, and carries the watermark
    return (
        panes.withColumn("pane_time", F.window_time("pane"))
        .groupBy(F.window("pane_time", size, slide), *products)
        .agg(*summed_counts())
    )


def with_window_bounds(window_counts: DataFrame) -> DataFrame:
    """Replace the window struct by ``window_start`` and ``window_end``."""
    rest = [name for name in window_counts.columns if name != "window"]
    return window_counts.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *rest,
    )
