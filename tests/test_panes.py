"""Streams whose windows overlap often: panes first, then windows of pane totals."""

import random

import pytest
from pyspark.sql import functions as F

from clicktide.operators import sliding_window_counts, with_window_bounds
from tests.helpers import as_set, event, events_of
from tests.test_streaming import Feed, minute, run

HOURLY = ("60 minutes", "5 minutes")


def random_batches(seed, batches=6):
    rnd, clock, made = random.Random(seed), 0, []
    for _ in range(batches):
        clock += rnd.choice([5, 30, 90])
        made.append([
            event(rnd.choice(["view", "purchase"]), product=rnd.choice(["a", "b", None]), time=minute(clock + rnd.random() * 2))
            for _ in range(rnd.randint(1, 20))
        ])
    return made


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_final_counts_equal_the_table(spark, folder, seed):
    feed, rows = Feed(spark, f"{folder}/feed"), []
    for batch in random_batches(seed):
        feed.add(*batch)
        rows += batch
    events = events_of(spark, rows)
    newest = events.agg(F.max("timestamp")).first()[0]
    expected = with_window_bounds(sliding_window_counts(events, *HOURLY)).where(
        F.col("window_end") <= F.lit(newest) - F.expr("INTERVAL 2 MINUTES")
    )
    counts = with_window_bounds(sliding_window_counts(feed.events(), *HOURLY, final=True))
    root, _ = run(counts, folder, "append")
    assert as_set(spark.read.parquet(root).select(expected.columns)) == as_set(expected)


def test_windows_receive_pane_totals(spark, folder):
    feed = Feed(spark, f"{folder}/feed")
    for _ in range(3):
        feed.add(*[event(time=minute(1))] * 50)
    feed.add(event(time=minute(300)))
    feed.add(event(time=minute(301)))
    root, query = run(with_window_bounds(sliding_window_counts(feed.events(), *HOURLY, final=True)), folder, "append")
    states = [p["stateOperators"] for p in query.recentProgress]
    assert {len(operators) for operators in states} == {2}
    windows, panes = zip(*((s[0]["numRowsUpdated"], s[1]["numRowsUpdated"]) for s in states))
    assert sum(panes) == 5 and sum(windows) == 12  # 150 events: one pane, which is in 12 windows
    assert {row.views for row in spark.read.parquet(root).collect()} == {150}
    plain = with_window_bounds(sliding_window_counts(feed.events(), *HOURLY))
    _, query = run(plain, f"{folder}/plain", "append")
    assert {len(p["stateOperators"]) for p in query.recentProgress} == {1}


def test_event_behind_its_closed_pane_is_late(spark, folder):
    feed = Feed(spark, f"{folder}/feed")
    for moment in (20, 21, 1, 200, 201):
        feed.add(event(time=minute(moment)))
    counts = with_window_bounds(sliding_window_counts(feed.events(), *HOURLY, final=True))
    root, query = run(counts, folder, "append")
    assert sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"]) == 1
    assert max(row.views for row in spark.read.parquet(root).collect()) == 2


def test_few_copies_stay_one_stage(spark, folder):
    feed = Feed(spark, f"{folder}/feed")
    feed.add(event())
    _, query = run(with_window_bounds(sliding_window_counts(feed.events(), final=True)), folder, "append")
    assert {len(p["stateOperators"]) for p in query.recentProgress} == {1}
