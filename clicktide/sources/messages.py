"""Keyed JSON messages: reading a stream of them, decoding and encoding events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clicktide.functions import utc_date
from clicktide.schemas import CLICKSTREAM, CLICKSTREAM_COLUMNS, EVENT_TOPIC

# Start with new events, and go on when a broker has lost old ones.
KAFKA_SOURCE_OPTIONS = {"startingOffsets": "latest", "failOnDataLoss": "false"}

# Explicit nulls, microseconds and the numeric offset.
EVENT_JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx",
    "timeZone": "UTC",
}


def kafka_source_options(servers: str, topic: str = EVENT_TOPIC, **options: str) -> dict[str, str]:
    """Options of a topic subscription; ``options`` may override or extend them."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        **KAFKA_SOURCE_OPTIONS,
        **options,
    }


def read_event_stream(
    spark: SparkSession,
    source: str = "kafka",
    path: str | None = None,
    schema: str | None = None,
    **options: str,
) -> DataFrame:
    """A stream of messages with a ``value`` column, from a topic or from files.

    ``source`` is any streaming format: ``kafka`` with ``kafka_source_options``,
    ``text`` with one JSON event per line, or ``parquet`` with a ``schema``.
    """
    reader = spark.readStream.format(source).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def parse_events(messages: DataFrame) -> DataFrame:
    """Decode JSON values into the archive layout; batch or stream.

    Decoding is permissive: text that is no such object gives a row of nulls, a
    wrongly typed field a null. The record is unpacked by a generator, which keeps a
    later filter on event time from being pushed below it, where the text would be
    parsed a second time.
    """
    record = F.from_json(F.col("value").cast("string"), CLICKSTREAM, {"timeZone": "UTC"})
    return messages.select(F.inline(F.array(record))).withColumn(
        "event_date", utc_date("timestamp")
    )


def with_ingest_metrics(events: DataFrame, name: str = "ingest") -> DataFrame:
    """Count events into the query's observed metrics: all, ``malformed`` ones without any
    field, and ``undated`` ones, which no report of a day can hold.

    A monitoring figure: a task that is run again after a lost executor may be
    counted again. The rows themselves pass through untouched.
    """
    empty = F.coalesce(*[F.col(field).cast("string") for field in CLICKSTREAM_COLUMNS]).isNull()
    return events.observe(
        name,
        F.count(F.lit(1)).alias("events"),
        F.count_if(empty).alias("malformed"),
        F.count_if(F.col("timestamp").isNull() & ~empty).alias("undated"),
    )


def junk_messages(messages: DataFrame) -> DataFrame:
    """The messages that ``parse_events`` cannot take as they are, with all their columns and a
    ``reason``; batch or stream. ``value`` keeps its bytes.

    ``no value``, ``malformed`` (no JSON object), ``no known field``, or ``wrong type``: of the
    last the archive has the other fields, of the others nothing.
    """
    layout, kept = f"{CLICKSTREAM}, _malformed STRING", {"columnNameOfCorruptRecord": "_malformed"}
    record = F.from_json(F.col("value").cast("string"), layout, {"timeZone": "UTC", **kept})
    fields = [F.col(f"_record.{name}").cast("string") for name in CLICKSTREAM_COLUMNS]
    empty, broken = F.coalesce(*fields).isNull(), F.col("_record._malformed").isNotNull()
    return (
        messages.select("*", F.explode(F.array(record)).alias("_record"))
        .withColumn(
            "reason",
            F.when(F.col("value").isNull(), "no value")
            .when(empty & (broken | F.col("_record").isNull()), "malformed")
            .when(empty, "no known field")
            .when(broken, "wrong type"),
        )
        .where("reason is not null")
        .drop("_record")
    )


def to_event_messages(events: DataFrame, *kept: str) -> DataFrame:
    """``key, value``: each event as JSON, keyed by user; batch or stream. ``kept`` columns stay.

    An empty or missing user gives a null key, so a topic spreads such events over
    its partitions.
    """
    return events.select(
        F.nullif(F.col("user_id"), F.lit("")).alias("key"),
        F.to_json(F.struct(*CLICKSTREAM_COLUMNS), EVENT_JSON_OPTIONS).alias("value"),
        *kept,
    )


def to_alert_messages(alerts: DataFrame) -> DataFrame:
    """``key, value``: each alert as JSON, keyed by product; null fields are omitted."""
    return alerts.select(
        F.col("product_id").alias("key"),
        F.to_json(F.struct(*alerts.columns), {"timeZone": "UTC"}).alias("value"),
    )
