from clicktide.functions.counts import event_type_counts, summed_counts
from clicktide.functions.keys import known
from clicktide.functions.text import (
    guarded_ratio, pad_left, pad_right, percent_label, percent_text,
)
from clicktide.functions.time import pane_width, previous_day, utc_date, window_copies

__all__ = [
    "event_type_counts", "guarded_ratio", "known", "pad_left", "pad_right", "pane_width",
    "percent_label", "percent_text", "previous_day", "summed_counts", "utc_date",
    "window_copies",
]
