"""Alerts as they begin and end."""

import random

import pytest
from pyspark.sql import functions as F

from clicktide.operators import sliding_window_counts, with_window_bounds
from clicktide.sinks import AlertChanges, CurrentTable, all_rows, write_to_sinks
from tests.helpers import as_list, event
from tests.test_streaming import HOUR0, TO_THE_END, Feed, Model, minute

KEYS = ("window_start", "window_end", "product_id", "category")
RULE = {"views_over": 2, "purchases_under": 2}


def started(spark, folder, feed, every=2, **options):
    counts = with_window_bounds(sliding_window_counts(feed.events()))
    table = CurrentTable(f"{folder}/counts", counts.schema, KEYS, every)
    changes = AlertChanges(table, f"{folder}/changes", **RULE, **options)
    return counts, changes


def told(spark, root):
    start = ((F.unix_seconds("window_start") - int(HOUR0.timestamp())) / 60).cast("int")
    rows = spark.read.parquet(root).select("batch_id", start.alias("start"), "product_id", "views", "purchases", "change")
    return sorted(as_list(rows))


def test_raised_and_withdrawn_once_each(spark, folder):
    feed = Feed(spark, f"{folder}/feed")
    feed.add(*[event(time=minute(6))] * 3)
    feed.add(event(time=minute(6)))
    feed.add(*[event("purchase", time=minute(6))] * 2)
    feed.add(event("purchase", time=minute(6)))
    counts, changes = started(spark, folder, feed)
    seen = []
    changes = AlertChanges(changes.table, changes.root, [lambda rows, n: seen.append((n, rows.count()))], **RULE)
    write_to_sinks(counts, [changes.deliver], f"{folder}/cp", trigger=TO_THE_END).awaitTermination()
    assert told(spark, changes.root) == [
        (0, 0, "P1", 3, 0, "raised"), (0, 5, "P1", 3, 0, "raised"),
        (2, 0, "P1", 4, 2, "withdrawn"), (2, 5, "P1", 4, 2, "withdrawn"),
    ]
    assert seen == [(0, 2), (2, 2)]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_sequence_of_batches(spark, folder, seed):
    choose, clock, model, feed = random.Random(seed), 100, Model(), Feed(spark, f"{folder}/feed")
    expected, alerts = set(), {}
    for number in range(8):
        clock += choose.choice([0, 0, 3, 8])
        batch = [
            (choose.choice(["view", "view", "view", "purchase"]), choose.choice("ab"), clock - choose.choice([0, 1, 4]))
            for _ in range(choose.randint(1, 6))
        ]
        feed.add(*[event(kind, product=product, time=minute(moment)) for kind, product, moment in batch])
        model.batch(batch)
        for start, product, views, purchases in model.updates[-1]:
            now = views > 2 and purchases < 2
            if now != alerts.get((start, product), False):
                alerts[start, product] = now
                expected.add((number, start, product, views, purchases, "raised" if now else "withdrawn"))
    counts, changes = started(spark, folder, feed, every=3)
    write_to_sinks(counts, [changes.deliver], f"{folder}/cp", trigger=TO_THE_END).awaitTermination()
    assert set(told(spark, changes.root)) == expected and expected


@pytest.mark.parametrize("every", [1, 5])
def test_repeated_batch_tells_the_same(spark, folder, every):
    feed = Feed(spark, f"{folder}/feed")
    counts, changes = started(spark, folder, feed, every)
    seen = []
    changes = AlertChanges(changes.table, changes.root, [lambda rows, n: seen.append(sorted(map(tuple, rows.collect())))], **RULE)
    layout = counts.schema

    def batch(views, purchases):
        return spark.createDataFrame([(HOUR0, minute(10), "p", None, views, 0, purchases)], layout)

    for number, (views, purchases) in enumerate([(3, 0), (4, 2), (9, 2)]):
        for _ in range(2):
            changes.deliver(batch(views, purchases), number)
    assert [row[:1] + row[-1:] for rows in seen for row in rows] == [("p", c) for c in ("raised", "raised", "withdrawn", "withdrawn")]
    schema = spark.read.parquet(f"{changes.root}/batch_id=0").schema
    assert all_rows(spark, changes.root, schema).count() == 2
