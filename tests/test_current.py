"""The table of current rows: snapshots and the batches behind them."""

import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from clicktide.sinks import CurrentTable, current
from clicktide.sinks.alerts import write_to_sinks
from tests.test_streaming import TO_THE_END, Feed, event, minute

SCHEMA = StructType().add("day", LongType()).add("name", StringType()).add("n", LongType())


def table_of(folder, **options):
    return CurrentTable(f"{folder}/table", SCHEMA, ("day", "name"), **options)


def rows_of(frame):
    return sorted(tuple(row) for row in frame.collect())


@pytest.mark.parametrize("slice_by", [None, "day"])
def test_last_row_per_key_after_every_batch(spark, folder, slice_by):
    table, rnd, expected = table_of(folder, every=3, slice_by=slice_by), random.Random(1), {}
    for batch_id in range(0, 26, 2):  # batches without rows leave gaps
        rows = {(rnd.choice([1, 2, 3, None]), rnd.choice("ab")): rnd.randint(0, 99) for _ in range(3)}
        expected |= rows
        table.deliver(spark.createDataFrame([(*k, n) for k, n in rows.items()], SCHEMA), batch_id)
        got = table.read(spark)
        assert got.columns == SCHEMA.names
        assert {(row.day, row.name): row.n for row in got.collect()} == expected
        slices, batches = table.folders(spark)
        assert batches < 3 and slices <= 4


def test_many_batches_are_one_snapshot_and_a_short_tail(spark, folder):
    table = table_of(folder, every=16)
    spark.range(1).select(F.lit(0).cast("long").alias("day"), F.lit("x").alias("name"), F.col("id").alias("n")) \
        .write.parquet(f"{folder}/one")
    made = os.listdir(f"{folder}/one")
    for number in range(1000):  # as many deliveries leave them, without waiting for each
        os.makedirs(f"{folder}/table/batch_id={number}")
        for name in made:
            os.link(f"{folder}/one/{name}", f"{folder}/table/batch_id={number}/{name}")
        if number % 250 == 249:
            assert table.merge(spark, number)
    for number in range(1000, 1010):
        table.deliver(spark.createDataFrame([(0, "x", number)], SCHEMA), number)
    slices, batches = table.folders(spark)
    assert slices == 1 and batches < 16
    assert rows_of(table.read(spark)) == [(0, "x", 1009)]
    # what the last two snapshots do not need is gone
    assert len([n for n in os.listdir(f"{folder}/table") if n.startswith("batch_id=")]) <= 260


def test_only_touched_slices_are_written_again(spark, folder):
    table = table_of(folder, every=2, slice_by="day")
    for number in range(4):
        table.deliver(spark.createDataFrame([(number // 2, "x", number)], SCHEMA), number)
    _, slices = table._snapshot(spark)
    first = slices["_slice=0"]
    for number in range(4, 8):
        table.deliver(spark.createDataFrame([(1, "y", number)], SCHEMA), number)
    assert table._snapshot(spark)[1]["_slice=0"] == first
    assert rows_of(table.read(spark)) == [(0, "x", 1), (1, "x", 3), (1, "y", 7)]


def test_killed_merge_changes_nothing(spark, folder, monkeypatch):
    table = table_of(folder, every=2)
    table.deliver(spark.createDataFrame([(1, "x", 1)], SCHEMA), 0)

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(current, "renamed_once", killed)
    with pytest.raises(KeyboardInterrupt):
        table.deliver(spark.createDataFrame([(1, "x", 2)], SCHEMA), 1)
    assert rows_of(table.read(spark)) == [(1, "x", 2)] and table.folders(spark) == (0, 2)
    monkeypatch.undo()
    table.deliver(spark.createDataFrame([(1, "x", 2)], SCHEMA), 1)  # the batch is run again
    assert rows_of(table.read(spark)) == [(1, "x", 2)] and table.folders(spark) == (1, 0)


def test_repeated_batch_and_earlier_states(spark, folder):
    table = table_of(folder, every=3)
    for number in range(5):
        for _ in range(2):
            table.deliver(spark.createDataFrame([(1, "x", number)], SCHEMA), number)
    assert rows_of(table.read(spark)) == [(1, "x", 4)]
    assert rows_of(table.read(spark, before=4)) == [(1, "x", 3)]
    assert rows_of(table.read(spark, before=3)) == [(1, "x", 2)]
    with pytest.raises(ValueError, match="merged"):
        table.read(spark, before=2)
    assert rows_of(table_of(f"{folder}/none").read(spark)) == []


def test_stream_into_a_current_table(spark, folder):
    from clicktide.operators import sliding_window_counts, with_window_bounds

    feed = Feed(spark, f"{folder}/feed")
    for number in range(5):
        feed.add(event(time=minute(number)))
    counts = with_window_bounds(sliding_window_counts(feed.events()))
    keys = ("window_start", "window_end", "product_id", "category")
    table = CurrentTable(f"{folder}/table", counts.schema, keys, 2, "floor(unix_seconds(window_start) / 86400)")
    write_to_sinks(counts, [table.deliver], f"{folder}/cp", trigger=TO_THE_END).awaitTermination()
    assert [row.views for row in table.read(spark).collect()] == [5, 5]
    assert table.folders(spark) == (2, 1)  # the windows of two days, and the fifth batch
