"""Delivering alerts: console, topic, table, or several of them from one query."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from clicktide.schemas import ALERT_TOPIC, CONSOLE_ROWS
from clicktide.sources.files import path_exists
from clicktide.sources.messages import to_alert_messages

BatchSink = Callable[[DataFrame, int], None]


def kafka_sink_options(servers: str, topic: str = ALERT_TOPIC, **options: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, **options}


def console_sink(rows: int = CONSOLE_ROWS) -> BatchSink:
    """Print the first rows of each batch, untruncated."""
    def deliver(batch: DataFrame, batch_id: int) -> None:
        batch.show(rows, truncate=False)
    return deliver


def message_sink(fmt: str = "kafka", **options: str) -> BatchSink:
    """Publish each alert as a keyed JSON message; at least once, as topics are."""
    def deliver(alerts: DataFrame, batch_id: int) -> None:
        to_alert_messages(alerts).write.format(fmt).mode("append").options(**options).save()
    return deliver


def table_sink(root: str) -> BatchSink:
    """Keep each batch under its own folder, so a repeated batch replaces itself.

    The folder belongs to one checkpoint: batches are numbered anew in another. Batches
    without rows leave no folder. ``latest_rows`` reads the state that they end in.
    """
    def deliver(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")
    return deliver


def all_rows(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """Everything that a ``table_sink`` kept, with ``batch_id``.

    In update mode a row is delivered again whenever it has changed: these are alerts as
    they were raised, the provisional ones among them.
    """
    with_batch = StructType(list(schema.fields)).add("batch_id", "long")
    if not path_exists(spark, root):
        return spark.createDataFrame([], with_batch)
    return spark.read.schema(with_batch).option("basePath", root).parquet(root)


def latest_rows(
    spark: SparkSession, root: str, schema: StructType, keys: Sequence[str]
) -> DataFrame:
    """Of a ``table_sink`` in update mode the current row per key: that of the last batch.

    A row that stopped being an alert is not delivered again, so ask this of window counts
    and apply the rule to the result.
    """
    rest = [name for name in schema.names if name not in keys]
    newest = F.max_by(F.struct(*rest), "batch_id").alias("newest")
    rows = all_rows(spark, root, schema).groupBy(*keys).agg(newest)
    return rows.select(*[F.col(n) if n in keys else F.col(f"newest.{n}") for n in schema.names])


def write_to_sinks(
    stream: DataFrame,
    sinks: Sequence[BatchSink],
    checkpoint: str,
    output_mode: str = "update",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Feed every sink from one query: one read and one state for all of them.

    The batch is computed whole, once, before the first sink sees it: a sink may look at
    a few rows only, and window state is committed just for the partitions computed. It
    is kept meanwhile, as its count tells whether there is anything to deliver; a batch
    without rows reaches no sink. One that is run again after a failure is delivered again.

    ``update`` delivers provisional alerts, ``append`` final ones; consumers recognise a
    repeated alert by product, category and window start.
    """
    def fan_out(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if batch.count():
                for deliver in sinks:
                    deliver(batch, batch_id)
        finally:
            batch.unpersist()

    writer = (
        stream.writeStream.foreachBatch(fan_out)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def write_alerts_console(
    alerts: DataFrame, checkpoint: str, rows: int = CONSOLE_ROWS, trigger: dict | None = None
) -> StreamingQuery:
    """Print alerts with the built-in console sink, in a query of their own."""
    writer = (
        alerts.writeStream.format("console")
        .options(truncate="false", numRows=rows)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def write_alerts_messages(
    alerts: DataFrame,
    checkpoint: str,
    fmt: str = "kafka",
    trigger: dict | None = None,
    **options: str,
) -> StreamingQuery:
    """Publish alerts with a built-in streaming sink, in a query of their own."""
    writer = (
        to_alert_messages(alerts).writeStream.format(fmt)
        .options(**options)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()
