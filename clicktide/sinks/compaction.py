"""Rewriting closed days of a streamed archive in few files."""

from __future__ import annotations

import json
import uuid
from datetime import date
from urllib.parse import unquote

from pyspark.sql import SparkSession

from clicktide.schemas import ARCHIVE_PARTITION
from clicktide.session import MIB
from clicktide.sources.archive import (
    COMPACTED, RECORDS, Archive, live_files, open_archive, read_parts,
)
from clicktide.sources.files import data_files, make_folder, put_text, remove, renamed_once

FILE_BYTES = 256 * MIB


def files_of(bytes_: int, file_bytes: int) -> int:
    """Files of about that size that hold so many bytes."""
    return max(1, -(-bytes_ // file_bytes))


def compact_day(
    spark: SparkSession, archive: str | Archive, day: date, file_bytes: int = FILE_BYTES, remove_replaced: bool = False
) -> bool:
    """Rewrite a day in files of about ``file_bytes``, ordered by time; whether it was needed.

    It is needed if the day has more than twice as many files as that. The new files become
    the day's at once, by the renaming of a record that names them and the table of the files
    they replace; readers of this package follow the records. A run that is killed leaves
    files that no record names. Events that the stream adds meanwhile or later are read beside
    the new files, and join them when the day is rewritten again.

    Replaced files stay, as the stream's log still names them and Spark's own readers follow
    that, unless ``remove_replaced`` gives them up. One rewriting of a day runs at a time;
    a second one fails when its record is to be named.
    """
    archive = open_archive(spark, archive) if isinstance(archive, str) else archive
    root, found = archive.root, (archive.committed or {}).get(day)
    if archive.committed is None:
        raise ValueError(f"{root} has no commit log; write_archive(mode='overwrite') rewrites its days")
    if found is None or found.files <= 2 * files_of(found.bytes, file_bytes):
        return False
    before = found.record
    live = live_files(spark, root, [before] if before else [], day).select("path")
    paths = [row.path for row in live.collect()]  # what is read below is replaced, nothing later
    name, of_day = uuid.uuid4().hex, f"{COMPACTED}/{ARCHIVE_PARTITION}={day}"
    events = read_parts(spark, root, paths, [before] if before else []).drop(ARCHIVE_PARTITION)
    # files are bounded by their number; ranges of time let readers skip most row groups
    tasks = files_of(found.bytes, file_bytes)
    events = events.repartitionByRange(tasks, "timestamp") if tasks > 1 else events.repartition(1)
    events.sortWithinPartitions("timestamp").write.parquet(f"{root}/{of_day}/{name}")

    names = spark.createDataFrame([(path,) for path in paths], "path STRING")
    if before:
        names = names.union(spark.read.schema("path STRING").parquet(f"{root}/{before.replaced}"))
    names.coalesce(1).write.parquet(f"{root}/{of_day}/{name}-replaced")

    made = data_files(spark, f"{root}/{of_day}/{name}")
    version = before.version + 1 if before else 0
    record = {
        ARCHIVE_PARTITION: str(day), "version": version, "folder": f"{of_day}/{name}",
        "replaced": f"{of_day}/{name}-replaced", "files": len(made), "bytes": sum(made.values()),
    }
    make_folder(spark, f"{root}/{RECORDS}")
    draft = f"{root}/{COMPACTED}/_draft-{name}"
    put_text(spark, draft, json.dumps(record))
    renamed_once(spark, draft, f"{root}/{RECORDS}/{day}-{version}.json")
    if remove_replaced:
        for path in paths:
            remove(spark, unquote(path))
        if before:
            remove(spark, f"{root}/{before.folder}")
    return True


def compact_closed_days(
    spark: SparkSession, root: str, before: date, file_bytes: int = FILE_BYTES, remove_replaced: bool = False
) -> list[date]:
    """Rewrite every earlier day that has too many files, newest first; returns those days."""
    archive = open_archive(spark, root)
    return [
        day for day in archive.days
        if day < before and compact_day(spark, archive, day, file_bytes, remove_replaced)
    ]
