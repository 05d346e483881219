"""The flash-sale rule over window counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clicktide.operators.windows import with_window_bounds
from clicktide.schemas import (
    ALERT_COLUMNS,
    ALERT_PURCHASES_UNDER,
    ALERT_RECOMMENDATION,
    ALERT_TYPE,
    ALERT_VIEWS_OVER,
)


def flash_sale_rule(
    views_over: int = ALERT_VIEWS_OVER, purchases_under: int = ALERT_PURCHASES_UNDER
) -> Column:
    """Many views and few purchases; both comparisons are strict."""
    return (F.col("views") > views_over) & (F.col("purchases") < purchases_under)


def with_alert_texts(windows: DataFrame) -> DataFrame:
    return windows.withColumns({
        "alert_type": F.lit(ALERT_TYPE),
        "recommendation": F.lit(ALERT_RECOMMENDATION),
    })


def flash_sale_alerts(
    window_counts: DataFrame,
    views_over: int = ALERT_VIEWS_OVER,
    purchases_under: int = ALERT_PURCHASES_UNDER,
) -> DataFrame:
    """Windows with many views and few purchases, by ``flash_sale_rule``.

    On a stream the output mode of the sink decides what an alert means: ``update``
    raises it while the window is still filling and never takes it back, ``append``
    raises it once, from the final counts of a closed window.
    """
    alerts = window_counts.where(flash_sale_rule(views_over, purchases_under))
    return with_alert_texts(with_window_bounds(alerts)).select(*ALERT_COLUMNS)
