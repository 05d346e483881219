"""The three event-type counters every aggregate of this package is made of."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from clicktide.schemas import COUNTER_OF_EVENT_TYPE


def event_type_counts() -> list[Column]:
    """Aggregates ``views``, ``cart_adds``, ``purchases`` over raw events.

    Fixed conditional counts: no discovery job as for a dynamic pivot, a type that
    never occurs gives 0, and the partial counts are combined map-side, so a hot
    key costs one row per task in the shuffle.
    """
    return [
        F.count_if(F.col("event_type") == event_type).alias(counter)
        for event_type, counter in COUNTER_OF_EVENT_TYPE.items()
    ]


def summed_counts() -> list[Column]:
    """The same counters, rolled up from finer groups that already carry them."""
    return [F.sum(counter).alias(counter) for counter in COUNTER_OF_EVENT_TYPE.values()]
