"""Most-viewed products and their text report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from clicktide.functions import known, pad_left, pad_right
from clicktide.operators.ranking import top_rows
from clicktide.schemas import TOP_PRODUCTS

RULE_WIDTH = 64
# Report column heads and widths.
RANK_HEAD, RANK_WIDTH = "Rank", 6
PRODUCT_HEAD, PRODUCT_WIDTH = "Product", 10
CATEGORY_HEAD, CATEGORY_WIDTH = "Category", 16
VIEWS_HEAD, VIEWS_WIDTH = "Views", 10


def top_products(
    events: DataFrame, k: int = TOP_PRODUCTS, by: Sequence[str] = ()
) -> DataFrame:
    """``rank, product_id, category, view_count`` of the ``k`` most-viewed products."""
    views = (
        events.where((F.col("event_type") == "view") & known(*by, "product_id", "category"))
        .groupBy(*by, "product_id", "category")
        .agg(F.count("*").alias("view_count"))
    )
    return rank_products(views, k, by)


def rank_products(
    view_counts: DataFrame, k: int = TOP_PRODUCTS, by: Sequence[str] = ()
) -> DataFrame:
    """Rank finished view counts; ties by ascending product, then category."""
    order = [F.desc("view_count"), F.asc("product_id"), F.asc("category")]
    return top_rows(view_counts, k, order, by, rank="rank")


def _frame(k: int, label: Column) -> dict[int, Column]:
    """The lines of a report around its ranked products, by line number."""
    column_heads = (
        f"{RANK_HEAD:<{RANK_WIDTH}}{PRODUCT_HEAD:<{PRODUCT_WIDTH}}"
        f"{CATEGORY_HEAD:<{CATEGORY_WIDTH}}{VIEWS_HEAD:>{VIEWS_WIDTH}}"
    )
    double_rule = F.lit("=" * RULE_WIDTH)
    return {
        1: double_rule,
        2: F.concat(F.lit(f"  Top {k} Most-Viewed Products  -  "), label),
        3: double_rule,
        4: F.lit(column_heads),
        5: F.lit("-" * RULE_WIDTH),
        6 + k: double_rule,
    }


def _line(number: Column, text: Column) -> Column:
    return F.struct(number.cast("int").alias("line_no"), text.alias("line"))


def _frame_lines(k: int, label: Column) -> Column:
    return F.array(*[_line(F.lit(number), text) for number, text in _frame(k, label).items()])


def _ranked_line(row: Column | None = None) -> Column:
    of = F.col if row is None else row.getField
    text = F.concat(
        pad_right(of("rank").cast("string"), RANK_WIDTH),
        pad_right(of("product_id"), PRODUCT_WIDTH),
        pad_right(of("category"), CATEGORY_WIDTH),
        pad_left(F.format_number(of("view_count"), 0), VIEWS_WIDTH),
    )
    return _line(of("rank") + 5, text)


def top_products_report(ranked: DataFrame, days: DataFrame, k: int = TOP_PRODUCTS) -> DataFrame:
    """Fixed-width report lines ``report_date, line_no, line``.

    ``days`` lists the report dates as text; each gets its head and rules, even
    without a single ranked product. ``ranked`` carries ``report_date`` as well.
    """
    label = F.col("report_date")
    frame = days.select("report_date", F.inline(_frame_lines(k, label)))
    lines = ranked.select("report_date", F.inline(F.array(_ranked_line())))
    return frame.unionByName(lines)


def daily_top_products_report(events: DataFrame, k: int = TOP_PRODUCTS) -> DataFrame:
    """The report of every day in ``events``, from one scan: ``report_date, line_no, line``.

    A day with events but without views has its head and rules. Events without a date are
    in no report.
    """
    viewed = (F.col("event_type") == "view") & known("product_id", "category")
    counts = (
        events.where(known("event_date"))
        .groupBy("event_date", "product_id", "category")
        .agg(F.count_if(viewed).alias("view_count"))
    )
    # a day's unviewed products come last, and tell that there is such a day
    best = rank_products(counts, k, ["event_date"])
    viewed_rows = F.collect_list(
        F.when(F.col("view_count") > 0, F.struct("rank", "product_id", "category", "view_count"))
    )
    label = F.col("event_date").cast("string")
    lines = F.concat(_frame_lines(k, F.col("report_date")), F.transform("rows", _ranked_line))
    return (
        best.groupBy(label.alias("report_date"))
        .agg(viewed_rows.alias("rows"))
        .select("report_date", F.inline(lines))
    )
