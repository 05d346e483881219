from clicktide.operators.alerts import flash_sale_alerts
from clicktide.operators.conversion import (
    conversion_chart_series,
    conversion_rates,
    conversion_rates_display,
    display_table,
    rate_categories,
)
from clicktide.operators.products import (
    daily_top_products_report,
    rank_products,
    top_products,
    top_products_report,
)
from clicktide.operators.segments import (
    segment_headline,
    segment_summary,
    top_active_users,
    user_segments,
)
from clicktide.operators.windows import sliding_window_counts, with_window_bounds

__all__ = [
    "conversion_chart_series", "conversion_rates", "conversion_rates_display",
    "daily_top_products_report",
    "display_table", "flash_sale_alerts", "rank_products", "rate_categories",
    "segment_headline", "segment_summary", "sliding_window_counts",
    "top_active_users", "top_products", "top_products_report", "user_segments",
    "with_window_bounds",
]
