"""Messages in order: bulk publication, files for streams, and what cannot be parsed."""

import json
import os
import random
from collections import defaultdict

import pytest

from clicktide.schemas import MESSAGE
from clicktide.sinks import publish_event_files, publish_events, write_junk_stream
from clicktide.sources import junk_messages, parse_events, read_event_stream
from clicktide.streaming import PipelineConfig, start_pipeline
from tests.helpers import as_set, at, event, events_of
from tests.test_streaming import TO_THE_END, Feed

DAY = 24 * 60


def some_events(spark, n=600, undated=0):
    rnd = random.Random(3)
    users = ["hot"] * 4 + [f"u{i}" for i in range(40)] + [None, ""]
    rows = [event(user=rnd.choice(users), product=f"{i}", time=at(rnd.random() * 5 * DAY)) for i in range(n)]
    return events_of(spark, rows + [event(user="u1", product=f"lost {i}", time=None) for i in range(undated)])


def test_a_users_messages_leave_in_the_order_of_time(spark, folder):
    events = some_events(spark).repartition(7)
    publish_events(events, "json", path=folder)
    times, files, without_user = defaultdict(list), defaultdict(set), set()
    for name in sorted(n for n in os.listdir(folder) if n.endswith(".json")):
        for line in open(f"{folder}/{name}"):
            message = json.loads(line)
            if "key" not in message:
                without_user.add(name)
                continue
            times[message["key"]].append(json.loads(message["value"])["timestamp"])
            files[message["key"]].add(name)
    assert all(moments == sorted(moments) for moments in times.values())
    assert all(len(names) == 1 for names in files.values()) and len(without_user) > 1
    published = parse_events(spark.read.schema(MESSAGE).json(folder))
    assert as_set(published) == as_set(events)


@pytest.mark.parametrize("files", [1, 3, 50])
def test_groups_of_files_are_micro_batches(spark, folder, files):
    events = some_events(spark, 200, undated=20)
    groups = publish_event_files(events, f"{folder}/in", days_per_group=2, files_per_group=files)
    seen = []

    def batch(rows, batch_id):
        seen.append(sorted({(row.event_date - at(0).date()).days // 2 if row.event_date else None for row in rows.collect()}, key=str))

    stream = parse_events(read_event_stream(spark, "parquet", f"{folder}/in", MESSAGE, maxFilesPerTrigger=str(files)))
    writer = stream.writeStream.foreachBatch(batch).trigger(**TO_THE_END).option("checkpointLocation", f"{folder}/cp")
    writer.start().awaitTermination()
    assert groups == len(seen) and seen[-1] == [None]
    days = [day for day, in seen[:-1]]  # one group of days in each batch
    assert days == sorted(days) and len(set(days)) == len(days)
    # a second publication follows the first
    publish_event_files(some_events(spark, 30), f"{folder}/in", days_per_group=2, files_per_group=files)
    before = len(seen)
    writer.start().awaitTermination()
    later = [day for day, in seen[before:]]
    assert later and later == sorted(later)


TEXTS = {
    "not json": "malformed", "[1]": "malformed", '{"user_id":': "malformed", "": "malformed", "7": "malformed",
    "{}": "no known field", '{"other": 1}': "no known field", None: "no value",
    '{"user_id":"u","timestamp":"soon"}': "wrong type", '{"user_id":{"a":1},"product_id":"p"}': None,
    '{"user_id":"u"}': None, '{"user_id":"u","timestamp":"2026-01-01T00:00:00Z","more":1}': None,
}


def test_reasons(spark):
    rows = [(str(i), None if text is None else bytearray(text.encode()), 5) for i, text in enumerate(TEXTS)]
    rows.append(("bytes", bytearray(b"\xff\xfe{"), 5))
    messages = spark.createDataFrame(rows, "key STRING, value BINARY, offset LONG")
    found = {r.key: (None if r.value is None else bytes(r.value), r.reason, r.offset) for r in junk_messages(messages).collect()}
    expected = {
        str(i): (None if text is None else text.encode(), reason, 5)
        for i, (text, reason) in enumerate(TEXTS.items()) if reason
    }
    assert found == expected | {"bytes": (b"\xff\xfe{", "malformed", 5)}


def test_junk_of_a_running_pipeline_comes_back(spark, folder):
    feed = Feed(spark, f"{folder}/feed")
    feed.add(event())
    feed.add_text("not json", '{"user_id":"u","timestamp":"soon"}')
    config = PipelineConfig(
        archive=f"{folder}/archive", checkpoints=f"{folder}/checkpoints", alert_sinks=[], junk=f"{folder}/junk",
        archive_trigger=TO_THE_END, alert_trigger=TO_THE_END,
    )
    for _ in range(2):  # exactly once, however often it starts
        queries = start_pipeline(feed.messages(), config)
        assert sorted(queries) == ["alerts", "archive", "junk"]
        for query in queries.values():
            query.awaitTermination()
        assert as_set(spark.read.parquet(config.junk).select("value", "reason")) == {
            ("not json", "malformed"), ('{"user_id":"u","timestamp":"soon"}', "wrong type"),
        }


def test_junk_stream_without_junk(spark, folder):
    feed = Feed(spark, f"{folder}/feed")
    feed.add(event())
    write_junk_stream(feed.messages(), f"{folder}/junk", f"{folder}/cp", TO_THE_END).awaitTermination()
    assert spark.read.schema("value STRING, reason STRING").parquet(f"{folder}/junk").count() == 0
