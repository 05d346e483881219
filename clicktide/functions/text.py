"""Number formats of the reports, digit for digit as Python and numpy print them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from clicktide.functions._columns import ColumnOrName, as_column


def guarded_ratio(part: ColumnOrName, whole: ColumnOrName) -> Column:
    """``part / whole``, and 0.0 where there is no whole."""
    part, whole = as_column(part), as_column(whole)
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def percent_label(percent: ColumnOrName) -> Column:
    """One decimal, ties on the exact binary value: 0.25 is ``0.2%``, 0.35 ``0.3%``.

    ``format_number`` rounds the binary value half-even; ``format_string('%.1f')``
    rounds the shortest decimal text half-up, which differs on ties.
    """
    return F.concat(F.replace(F.format_number(as_column(percent), 1), F.lit(",")), F.lit("%"))


def percent_text(rate: ColumnOrName) -> Column:
    """A rate as percent, two decimals at most and one at least: ``5.0%``, ``33.33%``."""
    rounded = F.rint(as_column(rate) * 100 * 100) / 100
    two_decimals = rounded.cast("decimal(38,2)").cast("string")
    return F.concat(F.regexp_replace(two_decimals, r"(\.\d)0$", "$1"), F.lit("%"))


def pad_left(text: Column, width: int) -> Column:
    """Fill up with spaces on the left; longer text is kept whole, unlike ``lpad``."""
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit(" "))


def pad_right(text: Column, width: int) -> Column:
    """Fill up with spaces on the right; longer text is kept whole, unlike ``rpad``."""
    return F.rpad(text, F.greatest(F.length(text), F.lit(width)), F.lit(" "))
