"""Reading the event archive: Parquet under ``event_date=YYYY-MM-DD`` folders."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from clicktide.schemas import ARCHIVE, ARCHIVE_PARTITION
from clicktide.sources.files import data_files, file_names, file_system, path_exists

COMMIT_LOG = "_spark_metadata"
# Days rewritten in fewer files, and a record of each rewriting.
COMPACTED = "_compacted"
RECORDS = f"{COMPACTED}/records"
RECORD = f"{ARCHIVE_PARTITION} DATE, version INT, folder STRING, replaced STRING, files LONG, bytes LONG"
_LOG_ENTRY = "path STRING, size LONG, action STRING"


def has_commit_log(spark: SparkSession, root: str) -> bool:
    """Whether a streaming query writes this archive."""
    return path_exists(spark, f"{root}/{COMMIT_LOG}")


def _day_of(folder: str) -> date | None:
    """The day of a partition folder; None for other folders and for undated events."""
    name, _, value = folder.partition("=")
    try:
        return date.fromisoformat(value) if name == ARCHIVE_PARTITION else None
    except ValueError:
        return None


def logged_files(spark: SparkSession, root: str) -> DataFrame:
    """``event_date, path, bytes`` of every file that the stream has committed.

    The commit log is read as a table: its last summary and the batches behind it. Spark's
    readers of files leave such folders out, hence the lines come from an RDD of the JVM.
    """
    names = file_names(spark, f"{root}/{COMMIT_LOG}")
    summaries = [int(n.split(".")[0]) for n in names if n.endswith(".compact")]
    last = max(summaries, default=-1)
    wanted = [f"{last}.compact"] if summaries else []
    wanted += [n for n in names if n.isdecimal() and int(n) > last]
    if not wanted:
        return spark.createDataFrame([], f"{ARCHIVE_PARTITION} DATE, path STRING, bytes LONG")
    lines = spark._jsc.textFile(",".join(f"{root}/{COMMIT_LOG}/{n}" for n in wanted), 1)
    text = spark._jsparkSession.createDataset(lines.rdd(), spark._jvm.org.apache.spark.sql.Encoders.STRING())
    entry = F.from_json("value", _LOG_ENTRY)
    day = F.regexp_extract("path", f"/{ARCHIVE_PARTITION}=([^/]*)/[^/]*$", 1)
    return (
        DataFrame(text.toDF(), spark)
        .where(F.startswith("value", F.lit("{")))
        .select(F.inline(F.array(entry)))
        .where(F.col("action") == "add")
        .select(F.try_to_date(day).alias(ARCHIVE_PARTITION), "path", F.col("size").alias("bytes"))
    )


def compaction_records(spark: SparkSession, root: str) -> DataFrame:
    """The last record of each rewritten day."""
    if not path_exists(spark, f"{root}/{RECORDS}"):
        return spark.createDataFrame([], RECORD)
    records = spark.read.schema(RECORD).json(f"{root}/{RECORDS}")
    last = F.max_by(F.struct(*records.columns), "version").alias("last")
    return records.groupBy(ARCHIVE_PARTITION).agg(last).select("last.*")


def live_files(spark: SparkSession, root: str, records: list, day: date | None = None) -> DataFrame:
    """Committed files that no rewriting has replaced; of one day, or of all."""
    files = logged_files(spark, root)
    if day is not None:
        files = files.where(F.col(ARCHIVE_PARTITION) == F.lit(day))
    replaced = [f"{root}/{r.replaced}" for r in records if day in (None, r.event_date)]
    if not replaced:
        return files
    return files.join(spark.read.schema("path STRING").parquet(*replaced), "path", "left_anti")


@dataclass(frozen=True)
class DayFiles:
    """Of one day of a streamed archive: how many files there are, their bytes, and the folder
    of the day's last rewriting (``record``), if any."""

    files: int
    bytes: int
    record: object | None = None


@dataclass(frozen=True)
class Archive:
    """An archive looked at once: its days, and how its events are read.

    ``committed`` is set for an archive that a stream writes. It tells the files of each day
    by the stream's commit log, so files of an unfinished or repeated batch are in none; the
    files themselves are looked up for the day that is read.
    """

    spark: SparkSession
    root: str
    days: tuple[date, ...]  # newest first
    committed: dict[date, DayFiles] | None = None

    def resolve(self, requested: date | str) -> date:
        """The requested day if the archive has its folder, else its last day.

        The last day may be later than the requested one. A day of a streamed archive is
        there if a file of it was committed. ``FileNotFoundError`` if there is no day at
        all, or if the folder of the day taken has no data file. A day whose files have no
        rows is that day, without events.
        """
        wanted = date.fromisoformat(str(requested))
        if not self.days:
            raise FileNotFoundError(f"no event partition under {self.root}")
        day = wanted if wanted in self.days else self.days[0]
        if self.committed is None and not data_files(self.spark, self._folder(day)):
            raise FileNotFoundError(f"no data files in {self._folder(day)}")
        return day

    def read(self, day: date) -> DataFrame:
        """One day's partition, without listing the files of other days."""
        if self.committed is not None:
            return self._read_committed(day)
        reader = self.spark.read.schema(ARCHIVE).option("basePath", self.root)
        return reader.parquet(self._folder(day)).where(F.col(ARCHIVE_PARTITION) == F.lit(day))

    def size(self, day: date) -> int:
        """Bytes of a day's files."""
        if self.committed is not None:
            return self.committed[day].bytes if day in self.committed else 0
        return sum(data_files(self.spark, self._folder(day)).values())

    def _folder(self, day: date) -> str:
        return f"{self.root}/{ARCHIVE_PARTITION}={day}"

    def _read_committed(self, day: date) -> DataFrame:
        record = self.committed[day].record if day in self.committed else None
        records = [record] if record else []
        live = live_files(self.spark, self.root, records, day).select("path").collect()
        events = read_parts(self.spark, self.root, [row.path for row in live], records)
        return events.where(F.col(ARCHIVE_PARTITION) == F.lit(day))


def read_parts(spark: SparkSession, root: str, paths: list[str], records: list) -> DataFrame:
    """Events of some files of the log and of rewritten days."""
    parts = []
    if paths:
        reader = spark.read.schema(ARCHIVE).option("basePath", root)
        parts.append(reader.parquet(*map(unquote, paths)))
    if records:
        reader = spark.read.schema(ARCHIVE).option("basePath", f"{root}/{COMPACTED}")
        parts.append(reader.parquet(*(f"{root}/{r.folder}" for r in records)))
    if not parts:
        return spark.createDataFrame([], ARCHIVE)
    return parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0]


def open_archive(spark: SparkSession, root: str) -> Archive:
    """Look at an archive once; a job passes the result on instead of looking again.

    One directory listing; or for an archive that a stream writes one job over its commit
    log, which leaves a row for each day, however many files there are.
    """
    if has_commit_log(spark, root):
        records = {r.event_date: r for r in compaction_records(spark, root).collect()}
        dated = live_files(spark, root, list(records.values())).where(F.col(ARCHIVE_PARTITION).isNotNull())
        counted = dated.groupBy(ARCHIVE_PARTITION).agg(
            F.count("*").alias("files"), F.sum("bytes").alias("bytes")
        )
        live = {row.event_date: row for row in counted.collect()}
        committed = {}
        for day in live.keys() | records.keys():
            of_day = [part for part in (live.get(day), records.get(day)) if part]
            committed[day] = DayFiles(
                sum(part.files for part in of_day), sum(part.bytes for part in of_day), records.get(day)
            )
        return Archive(spark, root, tuple(sorted(committed, reverse=True)), committed)
    fs, path = file_system(spark, root)
    found = fs.listStatus(path) if fs.exists(path) else []
    days = {_day_of(status.getPath().getName()) for status in found if status.isDirectory()}
    return Archive(spark, root, tuple(sorted(days - {None}, reverse=True)))


def archive_dates(spark: SparkSession, root: str) -> list[date]:
    """Days of the archive, newest first; the folder of undated events is none."""
    return list(open_archive(spark, root).days)


def day_bytes(spark: SparkSession, root: str, day: date) -> int:
    """Size of a day's files, asked of the file system."""
    return open_archive(spark, root).size(day)


def read_archive(spark: SparkSession, root: str) -> DataFrame:
    """The whole archive, undated events included; rewritten days from their new files."""
    if not path_exists(spark, f"{root}/{RECORDS}"):
        return spark.read.schema(ARCHIVE).parquet(root)
    records = compaction_records(spark, root).collect()
    live = live_files(spark, root, records).select("path").collect()
    return read_parts(spark, root, [row.path for row in live], records)


def resolve_event_date(spark: SparkSession, root: str, requested: date | str) -> date:
    """The requested day, or the last one where that is absent; see ``Archive.resolve``."""
    return open_archive(spark, root).resolve(requested)


def load_events_for_date(spark: SparkSession, root: str, requested: date | str) -> DataFrame:
    """All events of a day, or of the archive's last day where that day is absent.

    The ``event_date`` column tells which day was taken.
    """
    archive = open_archive(spark, root)
    return archive.read(archive.resolve(requested))
