import json
import os
import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from clicktide.operators import flash_sale_alerts, sliding_window_counts, with_window_bounds
from clicktide.sinks import (
    all_rows,
    latest_rows,
    console_sink,
    kafka_sink_options,
    message_sink,
    table_sink,
    write_alerts_console,
    write_alerts_messages,
    write_archive_stream,
    write_to_sinks,
)
from clicktide.sources import (
    parse_events,
    read_archive,
    read_event_stream,
    to_event_messages,
    with_ingest_metrics,
)
from clicktide.streaming import PipelineConfig, start_pipeline
from tests.helpers import as_list, as_set, at, event, events_of

HOUR0 = datetime(2026, 1, 1, tzinfo=timezone.utc)
TO_THE_END = {"availableNow": True}
STRICT = {"views_over": 2, "purchases_under": 3}


def minute(value):
    return at(value, HOUR0)


class Feed:
    """A folder of JSON-lines files, read one file per micro-batch in their order."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.files = spark, folder, 0
        os.makedirs(folder)

    def add(self, *events):
        names = ["user_id", "product_id", "category", "event_type", "timestamp"]
        with open(f"{self.folder}/{self.files:04}.json", "w") as file:
            for values in events:
                record = dict(zip(names, values))
                if record["timestamp"] is not None:
                    record["timestamp"] = record["timestamp"].isoformat()
                file.write(json.dumps(record) + "\n")
        self.settle()

    def add_text(self, *lines):
        with open(f"{self.folder}/{self.files:04}.json", "w") as file:
            file.write("\n".join(lines) + "\n")
        self.settle()

    def settle(self):
        stamp = 1_700_000_000 + self.files
        os.utime(f"{self.folder}/{self.files:04}.json", (stamp, stamp))
        self.files += 1

    def messages(self):
        return read_event_stream(self.spark, "text", self.folder, maxFilesPerTrigger="1")

    def events(self):
        return parse_events(self.messages())


@pytest.fixture
def feed(spark, folder):
    return Feed(spark, f"{folder}/feed")


def batches(spark, root):
    """``batch_id`` and the start minute of each delivered window, with its counters."""
    rows = spark.read.parquet(root)
    start = ((F.unix_seconds("window_start") - int(HOUR0.timestamp())) / 60).cast("int")
    return as_list(
        rows.select("batch_id", start.alias("start"), "views", "purchases")
        .orderBy("batch_id", "start")
    )


def run(rows, folder, mode):
    root = f"{folder}/{mode}"
    query = write_to_sinks(rows, [table_sink(root)], f"{root}-checkpoint", mode, TO_THE_END)
    query.awaitTermination()
    return root, query


def test_provisional_alert_is_raised_once_and_never_taken_back(spark, feed, folder):
    feed.add(*[event(time=minute(1))] * 3, event("purchase", time=minute(1)))
    feed.add(*[event("purchase", time=minute(2))] * 5)
    feed.add(event(product="later", time=minute(120)))
    feed.add(event(product="later", time=minute(121)))
    alerts = flash_sale_alerts(sliding_window_counts(feed.events()), **STRICT)

    root, _ = run(alerts, folder, "update")
    assert batches(spark, root) == [(0, -5, 3, 1), (0, 0, 3, 1)]
    root, _ = run(alerts, folder, "append")
    assert all_rows(spark, root, alerts.schema).count() == 0


def test_final_alert_is_raised_once_with_final_counts(spark, feed, folder):
    feed.add(*[event(time=minute(1))] * 3)
    feed.add(*[event(time=minute(2))] * 2, event("purchase", time=minute(2)))
    feed.add(event(product="later", time=minute(120)))
    feed.add(event(product="later", time=minute(121)))
    alerts = flash_sale_alerts(sliding_window_counts(feed.events()), **STRICT)

    root, _ = run(alerts, folder, "append")
    assert [row[1:] for row in batches(spark, root)] == [(-5, 5, 1), (0, 5, 1)]
    root, _ = run(alerts, folder, "update")
    assert batches(spark, root) == [(0, -5, 3, 0), (0, 0, 3, 0), (1, -5, 5, 1), (1, 0, 5, 1)]


def test_late_rows_are_dropped_per_window_one_batch_after_the_watermark(spark, feed, folder):
    for moment in (60, 1, 2, 61, 3):
        feed.add(event(time=minute(moment)))
    counts = with_window_bounds(sliding_window_counts(feed.events()))
    root, query = run(counts, folder, "update")
    delivered = {(batch, start) for batch, start, _, _ in batches(spark, root)}
    assert delivered == {(0, 55), (0, 60), (1, -5), (1, 0), (3, 55), (3, 60)}
    dropped = [
        progress["stateOperators"][0]["numRowsDroppedByWatermark"]
        for progress in query.recentProgress if progress["numInputRows"]
    ]
    assert dropped == [0, 0, 2, 0, 2]


def test_row_late_for_one_window_still_counts_in_the_other(spark, feed, folder):
    feed.add(event(time=minute(13)))
    feed.add(event(time=minute(13)))
    feed.add(event(time=minute(7)))
    counts = with_window_bounds(sliding_window_counts(feed.events()))
    root, _ = run(counts, folder, "update")
    assert [row for row in batches(spark, root) if row[0] == 2] == [(2, 5, 3, 0)]


def test_state_of_closed_windows_is_removed(spark, feed, folder):
    for moment in (0, 30, 60, 90):
        feed.add(*[event(product=f"p{number}", time=minute(moment)) for number in range(5)])
    _, query = run(with_window_bounds(sliding_window_counts(feed.events())), folder, "update")
    kept = [progress["stateOperators"][0]["numRowsTotal"] for progress in query.recentProgress]
    assert max(kept) <= 20 and kept[-1] == 10


def test_null_groups_stay_and_null_times_go(spark, feed, folder):
    feed.add(event(product=None, time=minute(1)), event(category=None, time=minute(1)),
             event(product="timeless", time=None))
    root, _ = run(with_window_bounds(sliding_window_counts(feed.events())), folder, "update")
    groups = spark.read.parquet(root).select("product_id", "category").distinct()
    assert as_set(groups) == {(None, "C1"), ("P1", None)}


def test_one_batch_stream_equals_the_table(spark, folder):
    kinds = ["view", "purchase", "view", "add_to_cart", "other"]
    events = events_of(spark, [
        event(kinds[number % 5], product=f"p{number % 3}", time=minute(number * 0.7))
        for number in range(200)
    ])
    to_event_messages(events).coalesce(1).write.parquet(f"{folder}/in")
    stream = read_event_stream(spark, "parquet", f"{folder}/in", "key STRING, value STRING")
    counts = with_window_bounds(sliding_window_counts(parse_events(stream)))
    root, _ = run(counts, folder, "update")
    expected = with_window_bounds(sliding_window_counts(events))
    assert as_set(spark.read.parquet(root).select(expected.columns)) == as_set(expected)

    root, _ = run(counts, folder, "append")
    last = events.agg(F.max("timestamp")).first()[0]
    closed = expected.where(F.col("window_end") <= F.lit(last) - F.expr("INTERVAL 2 MINUTES"))
    assert as_set(spark.read.parquet(root).select(expected.columns)) == as_set(closed)


def test_archive_resumes_without_loss_or_repetition(spark, feed, folder):
    root, checkpoint = f"{folder}/archive", f"{folder}/checkpoint"

    def catch_up():
        write_archive_stream(feed.events(), root, checkpoint, TO_THE_END).awaitTermination()
        return sorted(str(row.user_id) for row in read_archive(spark, root).collect())

    feed.add(event(user="a"), event(user="b", time=None))
    assert catch_up() == ["a", "b"]
    assert catch_up() == ["a", "b"]
    feed.add(event(user="c", time=minute(-10_000)))
    feed.add(event(user="d"), event(user="a"))
    assert catch_up() == ["a", "a", "b", "c", "d"]


@pytest.mark.parametrize("files, expected", [(None, 4), (1, 1)])
def test_archive_files_per_batch(spark, feed, folder, files, expected):
    for number in range(4):
        feed.add(*[event(user=f"{number}-{other}") for other in range(5)])
    messages = read_event_stream(spark, "text", feed.folder)
    query = write_archive_stream(
        parse_events(messages), f"{folder}/archive", f"{folder}/cp", TO_THE_END, files
    )
    query.awaitTermination()
    archived = read_archive(spark, f"{folder}/archive")
    assert archived.count() == 20 and len(archived.inputFiles()) == expected


def test_alert_state_survives_a_restart(spark, feed, folder):
    alerts = flash_sale_alerts(sliding_window_counts(feed.events()), **STRICT)
    feed.add(*[event(time=minute(1))] * 2)
    root, _ = run(alerts, folder, "update")
    assert not os.path.exists(f"{root}/batch_id=0")  # nothing to keep
    feed.add(event(time=minute(2)))
    root, _ = run(alerts, folder, "update")
    assert [row[1:] for row in batches(spark, root)] == [(-5, 3, 0), (0, 3, 0)]


def test_ingest_metrics_count_events_without_any_field(spark, feed, folder):
    feed.add_text("not json", "{}", '{"user_id":"u"}', "[1]")
    query = write_archive_stream(
        with_ingest_metrics(feed.events()), f"{folder}/archive", f"{folder}/cp", TO_THE_END
    )
    query.awaitTermination()
    seen = [progress["observedMetrics"]["ingest"] for progress in query.recentProgress
            if progress["numInputRows"]]
    counts = [(metrics["events"], metrics["malformed"], metrics["undated"]) for metrics in seen]
    assert counts == [(4, 3, 1)]
    assert read_archive(spark, f"{folder}/archive").count() == 4


def test_batches_without_rows_reach_no_sink(spark, feed, folder):
    for number in range(4):
        feed.add(event(time=minute(number)))
    delivered = []
    alerts = flash_sale_alerts(sliding_window_counts(feed.events()), views_over=3)
    sinks = [table_sink(f"{folder}/table"), lambda batch, batch_id: delivered.append(batch_id)]
    write_to_sinks(alerts, sinks, f"{folder}/cp", trigger=TO_THE_END).awaitTermination()
    assert len(delivered) == 1 and len(os.listdir(f"{folder}/table")) == 1
    assert all_rows(spark, f"{folder}/none", alerts.schema).collect() == []


def test_latest_rows_replace_superseded_ones(spark, feed, folder):
    for views in (3, 3, 3):
        feed.add(*[event(time=minute(1))] * views)
    counts = with_window_bounds(sliding_window_counts(feed.events()))
    root, _ = run(counts, folder, "update")
    every = all_rows(spark, root, counts.schema)
    assert sorted(row.views for row in every.collect()) == [3, 3, 6, 6, 9, 9]
    keys = ["window_start", "window_end", "product_id", "category"]
    latest = latest_rows(spark, root, counts.schema, keys)
    assert latest.columns == counts.columns
    assert [row.views for row in latest.collect()] == [9, 9]


def test_one_query_feeds_several_sinks(spark, feed, folder, capsys):
    feed.add(*[event(time=minute(1))] * 3)
    alerts = flash_sale_alerts(sliding_window_counts(feed.events()), **STRICT)
    sinks = [
        console_sink(), message_sink("json", path=f"{folder}/topic"), table_sink(f"{folder}/table")
    ]
    write_to_sinks(alerts, sinks, f"{folder}/cp", trigger=TO_THE_END).awaitTermination()
    assert "FLASH_SALE_SUGGESTED" in capsys.readouterr().out
    table = spark.read.parquet(f"{folder}/table")
    messages = spark.read.schema("key STRING, value STRING").json(f"{folder}/topic").collect()
    assert table.count() == len(messages) == 2
    assert {row.key for row in messages} == {"P1"}
    assert {json.loads(row.value)["views"] for row in messages} == {3}


def test_state_is_whole_when_a_sink_reads_only_some_rows(spark, feed, folder):
    products = [f"p{number}" for number in range(40)]
    for _ in range(3):
        feed.add(*[event(product=product, time=minute(1)) for product in products])
    counts = with_window_bounds(sliding_window_counts(feed.events()))
    seen = []

    def first_row(batch, batch_id):
        batch.show(1)
        seen.append(batch.first().views)

    query = write_to_sinks(counts, [first_row], f"{folder}/cp", trigger=TO_THE_END)
    query.awaitTermination()
    assert seen == [1, 2, 3]
    kept = [progress["stateOperators"][0]["numRowsTotal"] for progress in query.recentProgress]
    assert kept[:3] == [80, 80, 80]


def test_repeated_batch_replaces_itself_in_a_table(spark, folder):
    alerts = spark.range(3)
    deliver = table_sink(folder)
    deliver(alerts, 7)
    deliver(alerts, 7)
    assert spark.read.parquet(folder).count() == 3


def test_builtin_console_and_message_sinks(spark, feed, folder):
    feed.add(*[event(time=minute(1))] * 3)
    alerts = flash_sale_alerts(sliding_window_counts(feed.events()), **STRICT)
    console = write_alerts_console(alerts, f"{folder}/cp1", trigger=TO_THE_END)
    messages = write_alerts_messages(
        alerts, f"{folder}/cp2", "memory", TO_THE_END, queryName="alert_messages"
    )
    for query in (console, messages):
        query.awaitTermination()
        assert query.exception() is None
    assert spark.table("alert_messages").columns == ["key", "value"]
    assert spark.table("alert_messages").count() == 2


def test_kafka_sink_options():
    assert kafka_sink_options("b:1") == {
        "kafka.bootstrap.servers": "b:1", "topic": "flash-sale-alerts"
    }


def test_pipeline_with_default_rule(spark, feed, folder):
    feed.add(*[event(time=minute(1), user=f"u{number}") for number in range(101)],
             *[event("purchase", time=minute(2))] * 4)
    feed.add_text("not json")
    config = PipelineConfig(
        archive=f"{folder}/archive",
        checkpoints=f"{folder}/checkpoints",
        alert_sinks=[table_sink(f"{folder}/alerts"), console_sink()],
        archive_trigger=TO_THE_END,
        alert_trigger=TO_THE_END,
    )
    for _ in range(2):
        for query in start_pipeline(feed.messages(), config).values():
            query.awaitTermination()
            assert query.exception() is None
        assert read_archive(spark, config.archive).count() == 106
        assert batches(spark, f"{folder}/alerts") == [(0, -5, 101, 4), (0, 0, 101, 4)]


def test_console_alone_is_enough_for_many_products(spark, feed, folder, capsys):
    for _ in range(2):
        feed.add(*[event(product=f"p{number}", time=minute(1)) for number in range(60)] * 2)
    config = PipelineConfig(
        archive=f"{folder}/archive", checkpoints=f"{folder}/checkpoints", views_over=3,
        archive_trigger=TO_THE_END, alert_trigger=TO_THE_END,
    )
    queries = start_pipeline(feed.messages(), config)
    for query in queries.values():
        query.awaitTermination()
    totals = [progress["stateOperators"][0]["numRowsTotal"]
              for progress in queries["alerts"].recentProgress]
    assert totals[:2] == [120, 120]
    assert capsys.readouterr().out.count("FLASH_SALE_SUGGESTED") == 20


def test_pipeline_defaults(folder):
    config = PipelineConfig(archive=folder, checkpoints=folder)
    assert (config.size, config.slide, config.lateness) == ("10 minutes", "5 minutes", "2 minutes")
    assert (config.views_over, config.purchases_under, config.alert_mode) == (100, 5, "update")
    assert config.archive_trigger == {"processingTime": "30 seconds"}
    assert config.alert_trigger is None


def test_processing_time_trigger_runs_until_stopped(spark, feed, folder):
    feed.add(event(user="a"))
    query = write_archive_stream(
        feed.events(), f"{folder}/archive", f"{folder}/cp", {"processingTime": "1 second"}
    )
    try:
        query.processAllAvailable()
        feed.add(event(user="b"))
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert read_archive(spark, f"{folder}/archive").count() == 2


class Model:
    """What a stream delivers, batch by batch, in plain Python; times are minutes."""

    def __init__(self, lateness=2):
        self.lateness, self.newest, self.closing = lateness, None, None
        self.state, self.updates, self.finals = {}, [], []

    def batch(self, events):
        dropping = self.closing
        self.closing = None if self.newest is None else self.newest - self.lateness
        touched = set()
        for kind, product, moment in events:
            newest_start = moment // 5 * 5
            for start in (newest_start, newest_start - 5):
                if dropping is not None and start + 10 <= dropping:
                    continue
                touched.add((start, product))
                counts = self.state.setdefault((start, product), {"view": 0, "purchase": 0})
                counts[kind] += 1
        self.updates.append({(*key, *self.state[key].values()) for key in touched})
        closed = [
            key for key in self.state if self.closing is not None and key[0] + 10 <= self.closing
        ]
        self.finals.append({(*key, *self.state.pop(key).values()) for key in closed})
        if events:
            latest = max(moment for _, _, moment in events)
            self.newest = latest if self.newest is None else max(latest, self.newest)


@pytest.mark.parametrize("seed", range(4))
def test_any_sequence_of_batches_delivers_what_the_model_says(spark, feed, folder, seed):
    choose = random.Random(seed)
    model, clock = Model(), 100
    for _ in range(7):
        clock += choose.choice([0, 3, 8, 20])
        batch = [
            (choose.choice(["view", "view", "purchase"]), choose.choice("ab"),
             clock - choose.choice([0, 1, 4, 9, 14, 30]))
            for _ in range(choose.randint(1, 12))
        ]
        feed.add(*[event(kind, product=product, time=minute(moment))
                   for kind, product, moment in batch])
        model.batch(batch)
    model.batch([])

    counts = with_window_bounds(sliding_window_counts(feed.events()))
    for mode, expected in (("update", model.updates), ("append", model.finals)):
        root, _ = run(counts, folder, mode)
        start = (F.unix_seconds("window_start") - int(HOUR0.timestamp())) / 60
        rows = spark.read.parquet(root).select(
            "batch_id", start.cast("int"), "product_id", "views", "purchases"
        )
        delivered = as_set(rows)
        assert delivered == {
            (number, *row) for number, batch in enumerate(expected) for row in batch
        }
