import json
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from clicktide.schemas import MESSAGE
from clicktide.sources import (
    kafka_source_options,
    parse_events,
    read_event_stream,
    to_alert_messages,
    to_event_messages,
)
from tests.helpers import as_list, event, events_of

FULL = {
    "user_id": "U0001",
    "product_id": "P003",
    "category": "Smartphones",
    "event_type": "view",
    "timestamp": "2026-01-01T00:00:00.123456+00:00",
}


def parse(spark, *values):
    messages = spark.createDataFrame([(value,) for value in values], "value STRING")
    binary = messages.select(F.col("value").cast("binary").alias("value"))
    fields = parse_events(binary).withColumn("timestamp", F.unix_micros("timestamp"))
    return as_list(fields)


def micros(text):
    moment = datetime.fromisoformat(text)
    return int(moment.replace(microsecond=0).timestamp()) * 1_000_000 + moment.microsecond


NOTHING = (None,) * 6


@pytest.mark.parametrize("changes, expected", [
    ({}, ("U0001", "P003", "Smartphones", "view",
          micros("2026-01-01T00:00:00.123456+00:00"), date(2026, 1, 1))),
    ({"timestamp": "2026-01-01T03:00:00+05:30"},
     ("U0001", "P003", "Smartphones", "view",
      micros("2025-12-31T21:30:00+00:00"), date(2025, 12, 31))),
    ({"timestamp": "2026-01-01T00:00:00"},
     ("U0001", "P003", "Smartphones", "view",
      micros("2026-01-01T00:00:00+00:00"), date(2026, 1, 1))),
    ({"timestamp": "2026-01-01"},
     ("U0001", "P003", "Smartphones", "view",
      micros("2026-01-01T00:00:00+00:00"), date(2026, 1, 1))),
    ({"timestamp": 1767225600},
     ("U0001", "P003", "Smartphones", "view",
      micros("2026-01-01T00:00:00+00:00"), date(2026, 1, 1))),
    ({"timestamp": "garbage"}, ("U0001", "P003", "Smartphones", "view", None, None)),
    ({"timestamp": None, "user_id": 7, "product_id": {"a": 1}, "event_type": True, "more": [1]},
     ("7", '{"a":1}', "Smartphones", "true", None, None)),
])
def test_fields_are_parsed_permissively(spark, changes, expected):
    assert parse(spark, json.dumps({**FULL, **changes})) == [expected]


def test_junk_gives_rows_of_nulls(spark):
    junk = ["not json", "{}", '[{"user_id":"A"}]', "", None, "null", '"text"', "{", "12"]
    rows = parse(spark, *junk)
    assert len(rows) == len(junk)
    assert set(rows) == {NOTHING}


def test_value_may_be_text_or_bytes(spark):
    text = spark.createDataFrame([(json.dumps(FULL),)], "value STRING")
    as_bytes = text.select(F.col("value").cast("binary").alias("value"))
    assert as_list(parse_events(text)) == as_list(parse_events(as_bytes))


def test_event_message_round_trip_keeps_every_field(spark):
    moment = datetime(2026, 1, 1, 10, 20, 30, 123456, tzinfo=timezone.utc)
    events = events_of(spark, [
        event(user="Zoë \"q\" \\ \n", time=moment),
        event(kind=None, category=None, time=moment),
        event(user=None, product=None, time=None),
    ])
    assert as_list(parse_events(to_event_messages(events))) == as_list(events)


def test_event_message_text_and_key(spark):
    moment = datetime(2026, 1, 1, 10, 20, 30, 5, tzinfo=timezone.utc)
    events = events_of(spark, [
        event(user="U7", time=moment), event(user="", time=moment), event(user=None, time=None)
    ])
    messages = as_list(to_event_messages(events))
    assert [key for key, _ in messages] == ["U7", None, None]
    assert json.loads(messages[0][1]) == {
        "user_id": "U7", "product_id": "P1", "category": "C1", "event_type": "view",
        "timestamp": "2026-01-01T10:20:30.000005+00:00",
    }
    assert json.loads(messages[1][1])["user_id"] == ""
    assert json.loads(messages[2][1]) == {
        "user_id": None, "product_id": "P1", "category": "C1", "event_type": "view",
        "timestamp": None,
    }


def test_alert_message_omits_nulls_and_keeps_column_order(spark):
    alerts = spark.sql(
        "SELECT 'P1' AS product_id, CAST(NULL AS STRING) AS category, "
        "TIMESTAMP_LTZ '2026-01-01 00:00:00Z' AS window_start, 101L AS views"
    )
    assert as_list(to_alert_messages(alerts)) == [
        ("P1", '{"product_id":"P1","window_start":"2026-01-01T00:00:00.000Z","views":101}')
    ]


def test_kafka_defaults_can_be_overridden():
    assert kafka_source_options("broker:1") == {
        "kafka.bootstrap.servers": "broker:1",
        "subscribe": "clickstream-events",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }
    changed = kafka_source_options("b:1", "t", startingOffsets="earliest", minPartitions="64")
    assert (changed["startingOffsets"], changed["minPartitions"]) == ("earliest", "64")
    assert changed["subscribe"] == "t"


def test_stream_reader_hands_format_schema_path_and_options_on(spark):
    class Recorder:
        def __init__(self):
            self.calls = {}

        def __getattr__(self, name):
            def record(*args, **kwargs):
                self.calls[name] = (args, kwargs)
                return self
            return record

    class Session:
        readStream = Recorder()

    read_event_stream(Session, **{"source": "kafka", **kafka_source_options("b:1")})
    calls = Session.readStream.calls
    assert calls["format"] == (("kafka",), {})
    assert calls["options"] == ((), kafka_source_options("b:1"))
    assert calls["load"] == ((), {})

    read_event_stream(Session, "parquet", "/somewhere", MESSAGE, maxFilesPerTrigger="1")
    assert calls["schema"] == ((MESSAGE,), {})
    assert calls["load"] == (("/somewhere",), {})
