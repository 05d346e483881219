import pytest
from pyspark.sql import functions as F

from clicktide.operators import (
    conversion_chart_series,
    conversion_rates,
    conversion_rates_display,
    display_table,
    segment_headline,
    segment_summary,
    top_active_users,
    top_products,
    top_products_report,
    user_segments,
)
from tests.helpers import NOON, as_list, as_set, at, event, events_of

DAY = 24 * 60


def times(kind, count, **fields):
    return [event(kind, **fields) for _ in range(count)]


# Users


def test_segments(spark):
    events = events_of(spark, [
        *times("view", 3, user="buyer"), event("add_to_cart", user="buyer"),
        *times("purchase", 2, user="buyer"),
        *times("view", 2, user="looker"),
        event("signup", user="new"),
        event("purchase", user="blind", product=None, category=None, time=None),
        event("view", user=None),
        event(None, user="untyped"),
    ])
    segments = user_segments(events)
    assert segments.columns == ["user_id", "views", "cart_adds", "purchases", "segment"]
    assert as_set(segments) == {
        ("buyer", 3, 1, 2, "BUYER"),
        ("looker", 2, 0, 0, "WINDOW_SHOPPER"),
        ("new", 0, 0, 0, "WINDOW_SHOPPER"),
        ("blind", 0, 0, 1, "BUYER"),
    }
    assert as_set(segment_summary(segments)) == {("BUYER", 2), ("WINDOW_SHOPPER", 2)}


def test_day_without_purchases(spark):
    segments = user_segments(events_of(spark, times("view", 2)))
    assert as_list(segments) == [("U1", 2, 0, 0, "WINDOW_SHOPPER")]


def test_every_day_in_one_pass_equals_day_by_day(spark):
    rows = [
        event(kind, user=f"u{number % 3}", product=f"p{number % 4}", category=f"c{number % 2}",
              time=at(number * 300))
        for number, kind in enumerate(["view", "view", "purchase", "add_to_cart", "other"] * 8)
    ]
    dated = events_of(spark, rows)
    events = dated.union(events_of(spark, [event(user="undated", time=None)]))
    days = [row.event_date for row in dated.select("event_date").distinct().collect()]
    assert len(days) > 5
    reports = {
        "segments": user_segments,
        "top": lambda events, by=(): top_products(events, 2, by),
        "rates": conversion_rates,
        "users": lambda events, by=(): top_active_users(user_segments(events, by), 2, by),
        "head": lambda events, by=(): segment_headline(user_segments(events, by), by),
        "sum": lambda events, by=(): segment_summary(user_segments(events, by), by),
    }
    for report in reports.values():
        single = set()
        for day in days:
            one_day = report(events.where(F.col("event_date") == F.lit(day)))
            single |= {(day, *row) for row in as_set(one_day)}
        assert as_set(report(events, by=["event_date"])) == single


def test_headline(spark):
    segments = spark.createDataFrame(
        [("a", "BUYER"), ("b", "WINDOW_SHOPPER"), ("c", "WINDOW_SHOPPER")],
        "user_id STRING, segment STRING",
    )
    row = segment_headline(segments).first()
    assert (row.total_users, row.buyers, row.shoppers) == (3, 1, 2)
    assert row.buyer_percent == 1 / 3 * 100
    assert row.shopper_percent == 100 - 1 / 3 * 100
    assert (row.buyer_label, row.shopper_label) == ("33.3%", "66.7%")


def test_headline_without_users(spark):
    nobody = spark.createDataFrame([], "user_id STRING, segment STRING")
    assert as_list(segment_headline(nobody)) == [(0, 0, 0, 0.0, 100.0, "0.0%", "100.0%")]


def test_top_users_order_ties_and_size(spark):
    rows = [(f"u{number:02}", number % 4, 0, number % 3, "x") for number in range(40)]
    table = spark.createDataFrame(
        rows, "user_id STRING, views BIGINT, cart_adds BIGINT, purchases BIGINT, segment STRING"
    )
    expected = sorted(rows, key=lambda row: (-row[3], -row[1], row[0]))
    assert as_list(top_active_users(table)) == expected[:25]
    assert as_list(top_active_users(table, 3)) == expected[:3]
    assert as_list(top_active_users(table, 100)) == expected


@pytest.mark.parametrize("k", [7, 1500])
def test_top_users_of_large_days(spark, k):
    users = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit("2026-01-02")).otherwise("2026-01-01").cast("date")
        .alias("event_date"),
        F.format_string("u%05d", "id").alias("user_id"),
        (F.col("id") * 7 % 11).alias("views"), (F.col("id") * 5 % 13).alias("purchases"),
    )
    rows = as_list(users)
    expected = set()
    for day in {row[0] for row in rows}:
        best = sorted((row for row in rows if row[0] == day), key=lambda r: (-r[3], -r[2], r[1]))
        expected |= set(best[:k])
    top = top_active_users(users, k, by=["event_date"])
    assert top.columns == users.columns
    assert as_set(top) == expected


# Products


def test_top_products_ranks_ties_and_drops_null_keys(spark):
    events = events_of(spark, [
        *times("view", 3, product="b"), *times("view", 3, product="a", category="z"),
        *times("view", 3, product="a", category="y"),
        *times("view", 9, product=None), *times("view", 9, category=None),
        *times("purchase", 9, product="sold"), *times("view", 1, product="d"),
        *times("view", 1, product="e"), *times("view", 1, product="f"),
    ])
    assert as_list(top_products(events)) == [
        (1, "a", "y", 3), (2, "a", "z", 3), (3, "b", "C1", 3), (4, "d", "C1", 1), (5, "e", "C1", 1)
    ]
    assert as_list(top_products(events, k=1)) == [(1, "a", "y", 3)]


def report_lines(spark, events, k=5):
    label = F.lit("2026-01-01").alias("report_date")
    ranked = top_products(events, k).select(label, "*")
    report = top_products_report(ranked, spark.range(1).select(label), k)
    assert report.columns == ["report_date", "line_no", "line"]
    return [row.line for row in report.orderBy("line_no").collect()]


def test_report_lines(spark):
    events = events_of(spark, [
        *times("view", 1234, product="P001", category="Laptops"),
        *times("view", 2, product="a-product-with-a-long-id", category="A category of many words"),
    ])
    assert report_lines(spark, events) == [
        "=" * 64,
        "  Top 5 Most-Viewed Products  -  2026-01-01",
        "=" * 64,
        f"{'Rank':<6}{'Product':<10}{'Category':<16}{'Views':>10}",
        "-" * 64,
        f"{1:<6}{'P001':<10}{'Laptops':<16}{1234:>10,}",
        f"{2:<6}{'a-product-with-a-long-id':<10}{'A category of many words':<16}{2:>10,}",
        "=" * 64,
    ]


def test_report_of_a_day_without_views_keeps_head_and_rules(spark):
    lines = report_lines(spark, events_of(spark, times("purchase", 2)))
    assert len(lines) == 6 and lines[0] == lines[2] == lines[5] == "=" * 64


def test_report_width_counts_characters(spark):
    events = events_of(spark, times("view", 1, product="👟", category="Schuhe für Läufer"))
    assert report_lines(spark, events)[5] == f"{1:<6}{'👟':<10}{'Schuhe für Läufer':<16}{1:>10,}"


# Categories


def test_conversion(spark):
    events = events_of(spark, [
        *times("view", 3, category="low"), *times("purchase", 1, category="low"),
        *times("view", 1, category="high"), *times("purchase", 2, category="high"),
        *times("add_to_cart", 4, category="high"),
        *times("purchase", 2, category="unseen"),
        event("signup", category="other"),
        event(None, category="untyped"), event("view", category=None),
    ])
    rates = conversion_rates(events)
    assert rates.columns == ["category", "views", "cart_adds", "purchases", "conversion_rate"]
    assert as_list(rates) == [
        ("high", 1, 4, 2, 2.0), ("low", 3, 0, 1, 1 / 3), ("other", 0, 0, 0, 0.0),
        ("unseen", 0, 0, 2, 0.0),
    ]
    assert as_list(conversion_rates_display(rates)) == [
        ("high", "1", "4", "2", "200.0%"), ("low", "3", "0", "1", "33.33%"),
        ("other", "0", "0", "0", "0.0%"), ("unseen", "0", "0", "2", "0.0%"),
    ]
    assert as_list(conversion_chart_series(rates)) == [
        ("high", 200.0, "200.0%"), ("low", 1 / 3 * 100, "33.3%"), ("other", 0.0, "0.0%"),
        ("unseen", 0.0, "0.0%"),
    ]


def test_display_table_casts_and_cuts(spark):
    table = spark.sql("SELECT id, id / 2 AS half, CAST(NULL AS STRING) AS gap FROM range(5)")
    shown = display_table(table, max_rows=2)
    assert {kind for _, kind in shown.dtypes} == {"string"}
    assert as_list(shown.orderBy("id")) == [("0", "0.0", None), ("1", "0.5", None)]
    assert display_table(table).count() == 5


@pytest.mark.parametrize("report", [user_segments, top_products, conversion_rates])
def test_no_events(spark, report):
    assert as_list(report(events_of(spark, []))) == []


def test_noon_is_in_its_day(spark):
    assert events_of(spark, [event(time=NOON)]).first().event_date.isoformat() == "2026-01-01"
