"""Writing the event archive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from clicktide.schemas import ARCHIVE_PARTITION, ARCHIVE_TRIGGER
from clicktide.sources.archive import has_commit_log
from clicktide.sources.messages import junk_messages


def write_archive(
    events: DataFrame, root: str, mode: str = "append", rebalance: bool = True
) -> None:
    """Write a table of events as one folder per event date.

    ``rebalance`` shuffles by date so that a day gets few files of advisory size;
    adaptive execution splits a day that is too large for one task. Without adaptive
    execution rows are spread evenly instead, which leaves more files but no hot task.
    Turn it off for input that is already clustered by time. ``mode="overwrite"``
    replaces only the days that occur in ``events``, so a backfill can be repeated.
    """
    if has_commit_log(events.sparkSession, root):
        raise ValueError(f"{root} is written by a stream; readers would not see other files")
    if rebalance:
        conf = events.sparkSession.conf
        if conf.get("spark.sql.adaptive.enabled") == "true":
            events = events.hint("rebalance", ARCHIVE_PARTITION)
        else:
            events = events.repartition(int(conf.get("spark.sql.shuffle.partitions")))
    (
        events.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(ARCHIVE_PARTITION)
        .parquet(root)
    )


def write_archive_stream(
    events: DataFrame,
    root: str,
    checkpoint: str,
    trigger: dict | None = None,
    files: int | None = None,
) -> StreamingQuery:
    """Append a stream to the archive, exactly once; no event is too late for it.

    Every task of a micro-batch writes a file per date it holds. ``files`` spreads the
    batch evenly over that many tasks first, so a wide source and a short trigger do
    not leave many small files.
    """
    if files:
        events = events.repartition(files)
    return (
        events.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(ARCHIVE_PARTITION)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or ARCHIVE_TRIGGER))
        .start(root)
    )


def write_junk_stream(
    messages: DataFrame, root: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append the messages that cannot be parsed to a table of their bytes, exactly once.

    A query of its own over the same messages, so the archive's layout and commit log stay
    as they are; it parses a second time, and writes nothing as long as nothing is wrong.
    """
    return (
        junk_messages(messages).writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or ARCHIVE_TRIGGER))
        .start(root)
    )
