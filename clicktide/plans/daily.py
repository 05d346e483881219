"""The daily job: three reports of one archived day, and the bundle made of them."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from clicktide.functions import event_type_counts, known, summed_counts
from clicktide.operators import (
    conversion_chart_series,
    conversion_rates,
    conversion_rates_display,
    daily_top_products_report,
    display_table,
    rank_products,
    rate_categories,
    segment_headline,
    top_active_users,
    top_products_report,
    user_segments,
)
from clicktide.schemas import (
    BUYER,
    CHART_SERIES,
    CONVERSION,
    TOP_PRODUCTS,
    TOP_USERS,
    USER_SEGMENT,
    WINDOW_SHOPPER,
)
from clicktide.session import planned_bytes, sized_for
from clicktide.sinks.reports import write_report_csv, write_report_text
from clicktide.sources.archive import Archive, open_archive
from clicktide.sources.reports import read_report_csv, read_report_text, require_reports


@dataclass(frozen=True)
class ReportPaths:
    """Folders of one day's reports, labelled with the requested day.

    ``user_segments_table`` holds the rows of ``user_segments`` as Parquet, for reading on.
    """

    user_segments: str
    user_segments_table: str
    top_products: str
    conversion_rates: str
    conversion_chart: str

    @classmethod
    def of(cls, out: str, day: date | str) -> ReportPaths:
        return cls(
            f"{out}/user_segments_{day}.csv",
            f"{out}/user_segments_{day}.parquet",
            f"{out}/top5_products_{day}.txt",
            f"{out}/conversion_rates_{day}.csv",
            f"{out}/conversion_chart_{day}.csv",
        )


@dataclass(frozen=True)
class DailyRun:
    """What a run read and wrote; ``source_date`` differs after a fallback."""

    requested_date: date
    source_date: date
    events: int
    users: int
    segments: dict[str, int]
    paths: ReportPaths


@dataclass(frozen=True)
class ReportBundle:
    """The data of the analysed report, read from the day's reports."""

    headline: DataFrame
    conversion_table: DataFrame
    conversion_chart: DataFrame
    top_products_lines: DataFrame
    top_users_table: DataFrame


def product_activity(events: DataFrame) -> DataFrame:
    """Counts per product and category: the common base of two of the reports.

    Rows without a product stay in, as they count for their category.
    """
    return (
        events.where(known("category", "event_type"))
        .groupBy("product_id", "category")
        .agg(*event_type_counts())
    )


def write_segments(spark: SparkSession, events: DataFrame, paths: ReportPaths) -> dict[str, int]:
    """Write the segments as a table and as the CSV report; returns the users per segment.

    The users are counted as they are written: the observation stands directly below the
    write, where a task that is run again reports only once.
    """
    segments, users = user_segments(events), Observation()
    counted = segments.observe(
        users,
        *(F.count_if(F.col("segment") == name).alias(name) for name in (BUYER, WINDOW_SHOPPER)),
    )
    counted.write.mode("overwrite").parquet(paths.user_segments_table)
    table = spark.read.schema(segments.schema).parquet(paths.user_segments_table)
    write_report_csv(table, paths.user_segments)
    return {name: number for name, number in users.get.items() if number}


def write_conversion(activity: DataFrame, paths: ReportPaths) -> None:
    """Write the rates per category and their chart series."""
    rates = rate_categories(activity.groupBy("category").agg(*summed_counts()))
    write_report_csv(rates, paths.conversion_rates)
    write_report_csv(conversion_chart_series(rates), paths.conversion_chart)


def write_top_products(
    spark: SparkSession, activity: DataFrame, paths: ReportPaths, day: date | str, k: int
) -> None:
    """Write the text report of the most-viewed products, titled ``day``."""
    views = activity.where(known("product_id") & (F.col("views") > 0)).select(
        "product_id", "category", F.col("views").alias("view_count")
    )
    label = F.lit(str(day)).alias("report_date")
    ranked = rank_products(views, k).select(label, "*")
    lines = top_products_report(ranked, spark.range(1).select(label), k)
    write_report_text(lines, paths.top_products)


def run_daily_reports(
    spark: SparkSession,
    archive: str | Archive,
    out: str,
    requested: date | str,
    k: int = TOP_PRODUCTS,
    source_date: date | None = None,
) -> DailyRun:
    """Write the three reports of a day, the segments beside the other two.

    ``archive`` is a folder, or an archive opened before; ``source_date`` the day to read
    where the caller has resolved it already.

    The day is scanned twice, each time for the columns that report needs: user and
    type for the segments; product, category and type for the other two, which share
    one small aggregate. That is less to read, and nothing to spill, compared with
    caching the day itself. The number of events comes from the file footers. Runs
    can be repeated: each replaces the outputs of the last.
    """
    if isinstance(archive, str):
        archive = open_archive(spark, archive)
    source_date = source_date or archive.resolve(requested)
    events = archive.read(source_date)
    paths = ReportPaths.of(out, requested)
    activity = product_activity(events).persist()

    def write_product_reports() -> None:
        # One after the other: the first fills the cache, the second reads it.
        write_conversion(activity, paths)
        write_top_products(spark, activity, paths, requested, k)

    tasks = [
        lambda: write_segments(spark, events, paths),
        lambda: events.count(),
        write_product_reports,
    ]
    try:
        with ThreadPoolExecutor(len(tasks)) as pool:
            started = [pool.submit(inheritable_thread_target(spark)(task)) for task in tasks]
        segments, event_count, *_ = [task.result() for task in started]
    finally:
        activity.unpersist()
    return DailyRun(
        requested_date=date.fromisoformat(str(requested)),
        source_date=source_date,
        events=event_count,
        users=sum(segments.values()),
        segments=segments,
        paths=paths,
    )


def build_report_bundle(spark: SparkSession, out: str, requested: date | str) -> ReportBundle:
    """Headline, percent table, chart, product lines and most active users of a day.

    Reads the written reports under their declared layouts, so it can run on its own
    after them. The users are read from their table, not from the CSV, and only the
    columns that are asked for. ``FileNotFoundError`` if one is missing or unfinished.
    """
    paths = ReportPaths.of(out, requested)
    require_reports(
        spark, paths.conversion_rates, paths.conversion_chart, paths.top_products,
        paths.user_segments, paths.user_segments_table,
    )
    segments = spark.read.schema(USER_SEGMENT).parquet(paths.user_segments_table)
    rates = read_report_csv(spark, paths.conversion_rates, CONVERSION).orderBy(
        F.desc("conversion_rate"), F.asc("category")
    )
    return ReportBundle(
        headline=segment_headline(segments),
        conversion_table=conversion_rates_display(rates),
        conversion_chart=read_report_csv(spark, paths.conversion_chart, CHART_SERIES).orderBy(
            F.desc("percent"), F.asc("category")
        ),
        top_products_lines=read_report_text(spark, paths.top_products),
        top_users_table=display_table(top_active_users(segments, TOP_USERS)),
    )


def write_report_bundle(bundle: ReportBundle, out: str, requested: date | str) -> str:
    """Write the bundle's tables as CSV below one folder, which is returned."""
    folder = f"{out}/analyzed_report_{requested}"
    write_report_csv(bundle.headline, f"{folder}/headline.csv")
    write_report_csv(bundle.conversion_table, f"{folder}/conversion_rates.csv")
    write_report_csv(bundle.conversion_chart, f"{folder}/conversion_chart.csv")
    write_report_csv(bundle.top_users_table, f"{folder}/top_users.csv")
    numbered = bundle.top_products_lines.select(
        F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("line")
    )
    write_report_text(numbered, f"{folder}/top_products.txt")
    return folder


def write_archive_reports(spark: SparkSession, events: DataFrame, out: str) -> dict[str, str]:
    """The reports of every day of an archive in one pass each, sized by what they read.

    Returns the folder of each report. Rows carry ``event_date``; users are written as a
    table, the others as they are for a single day.
    """
    by_day = ["event_date"]
    users = user_segments(events, by_day)
    rates = conversion_rates(events, by_day)
    lines = daily_top_products_report(events)
    paths = {
        name: f"{out}/{name}"
        for name in ("user_segments.parquet", "conversion_rates.csv", "top_products.csv")
    }
    with sized_for(spark, planned_bytes(users)):
        users.write.mode("overwrite").parquet(paths["user_segments.parquet"])
    with sized_for(spark, planned_bytes(rates)):
        write_report_csv(rates, paths["conversion_rates.csv"])
    with sized_for(spark, planned_bytes(lines)):
        ordered = lines.repartitionByRange("report_date").sortWithinPartitions("report_date", "line_no")
        write_report_csv(ordered, paths["top_products.csv"])
    return paths
