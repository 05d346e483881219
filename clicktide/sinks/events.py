"""Publishing events as keyed messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clicktide.schemas import CLICKSTREAM_COLUMNS, EVENT_TOPIC, MESSAGE
from clicktide.sources.files import data_files, file_system, folder_names, make_folder
from clicktide.sources.messages import to_event_messages

# Modification times of message files only have to rise.
FIRST_MODIFIED = 1_700_000_000_000


def _spread() -> Column:
    """The user; an event without one, which has no key, goes by its fields."""
    whole = F.concat(F.lit("\0"), F.xxhash64(*CLICKSTREAM_COLUMNS).cast("string"))
    return F.coalesce(F.nullif(F.col("user_id"), F.lit("")), whole)


def publish_events(events: DataFrame, fmt: str = "kafka", **options: str) -> None:
    """Send a table of events in bulk, for instance to replay an archived day.

    A user's events are in one task and leave it in the order of time, so a topic that is
    partitioned by key holds every user's events in order. Events without a user need no
    order and are spread evenly. Equal times are in no particular order.
    """
    if fmt == "kafka":
        options = {"topic": EVENT_TOPIC, **options}
    tasks = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_order = (
        events.withColumn("_spread", F.xxhash64(_spread()))
        .repartitionByRange(tasks, "_spread")
        .sortWithinPartitions("timestamp")
    )
    to_event_messages(in_order).write.format(fmt).mode("append").options(**options).save()


def publish_event_files(
    events: DataFrame, root: str, days_per_group: int = 10, files_per_group: int = 1
) -> int:
    """Events as Parquet files of JSON messages for a file stream, in groups by event date.

    A group holds ``days_per_group`` days, in ``files_per_group`` files among which its events
    are spread by user, so no task or file holds a whole group. Undated events come last, as
    a group of their own. Files are modified in the groups' order, and every group has the
    same number of files: a stream with that many ``maxFilesPerTrigger`` reads a group per
    micro-batch. Files of a second call follow those of the first. Returns the groups.
    """
    spark = events.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs, _ = file_system(spark, root)
    earlier = fs.globStatus(path(f"{root}/publication=*/_group=*/_part=*/part-*")) or []
    stamp = max((status.getModificationTime() for status in earlier), default=FIRST_MODIFIED)
    group = F.coalesce(F.floor(F.unix_date("event_date") / days_per_group), F.lit(1 << 40))
    numbered = events.withColumns({
        "_group": group, "_part": F.pmod(F.xxhash64(_spread()), F.lit(files_per_group)),
    }).repartition("_group", "_part")
    layout = f"{root}/publication={len(folder_names(spark, root))}"
    to_event_messages(numbered, "_group", "_part").write.partitionBy("_group", "_part").parquet(layout)

    groups = sorted(int(name.split("=")[1]) for name in folder_names(spark, layout))
    for number in groups:
        for part in range(files_per_group):
            folder = f"{layout}/_group={number}/_part={part}"
            names = list(data_files(spark, folder))
            if not names:  # no user of the group is here; the count of files must not change
                make_folder(spark, folder)
                spark.createDataFrame([], MESSAGE).coalesce(1).write.mode("append").parquet(folder)
                names = list(data_files(spark, folder))
            for name in names:
                stamp += 1000
                fs.setTimes(path(f"{folder}/{name}"), stamp, -1)
    return len(groups)
