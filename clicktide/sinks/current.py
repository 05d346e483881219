"""The current rows of an update-mode stream, at a cost that does not grow with its age."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from clicktide.sources.files import (
    file_names, folder_names, put_text, read_text, remove, renamed_once,
)

SNAPSHOTS = "_snapshots"
NO_SLICE = "all"


@dataclass(frozen=True)
class CurrentTable:
    """Of every key the last row that a stream delivered, kept under ``root``.

    Each batch leaves a folder; after ``every`` of them the folders are merged into a
    snapshot, so a reader sees one snapshot and fewer than ``every`` folders, however many
    batches there were. ``slice_by``, an SQL expression with whole numbers that never changes
    for a key, cuts the snapshot: merging rewrites only the slices that the batches touch. For
    windows that is their day, so closed days are written no more.

    A snapshot is a list of slice folders in one file that appears by renaming: a merge that is
    killed leaves folders that nothing names. A batch that is delivered again replaces its
    folder, or changes nothing if a snapshot holds it already. Folders that the last two
    snapshots do not need are removed; readers have the time between two merges.
    One query writes a table; its batches are numbered by that query's checkpoint.
    """

    root: str
    schema: StructType
    keys: tuple[str, ...]
    every: int = 16
    slice_by: str | None = None

    def deliver(self, batch: DataFrame, batch_id: int) -> None:
        """A sink of ``write_to_sinks``."""
        spark = batch.sparkSession
        if self.holds(spark, batch_id):
            return
        batch.select(*self.schema.names).write.mode("overwrite").parquet(self._batch(batch_id))
        self.merge(spark, batch_id)

    def read(
        self, spark: SparkSession, before: int | None = None, like: DataFrame | None = None
    ) -> DataFrame:
        """The current rows; with ``before`` those that the batches below that number left.

        ``like`` leaves out slices of the snapshot that none of its rows belong to.
        ``ValueError`` if a snapshot already holds later batches.
        """
        upto, slices = self._snapshot(spark)
        if like is not None:
            touched = self._touched(like)
            slices = {name: path for name, path in slices.items() if name in touched}
        if before is not None and upto >= before:
            raise ValueError(f"batches up to {upto} are merged, the state before {before} is gone")
        tail = self._tail(spark, upto)
        return self._newest(spark, slices.values(), [n for n in tail if before is None or n < before])

    def merge(self, spark: SparkSession, batch_id: int) -> bool:
        """Merge the batches up to this one, if there are enough of them."""
        upto, slices = self._snapshot(spark)
        tail = [number for number in self._tail(spark, upto) if number <= batch_id]
        if len(tail) < self.every:
            return False
        touched = self._touched(self._batches(spark, tail))
        named = {name: path for name, path in slices.items() if name in touched}
        merged = self._newest(spark, named.values(), tail)
        target = f"{self.root}/{SNAPSHOTS}/slices-{uuid.uuid4().hex}"
        if self.slice_by is None:
            merged.write.parquet(f"{target}/{NO_SLICE}")
        else:
            sliced = merged.withColumn("_slice", F.expr(self.slice_by).cast("long"))
            sliced.hint("rebalance", "_slice").write.partitionBy("_slice").parquet(target)
        written = {name: f"{target}/{name}" for name in folder_names(spark, target)}
        draft = f"{self.root}/{SNAPSHOTS}/_draft-{uuid.uuid4().hex}"
        put_text(spark, draft, json.dumps({**slices, **written}))
        renamed_once(spark, draft, f"{self.root}/{SNAPSHOTS}/upto={batch_id}.json")
        self._clean(spark, batch_id)
        return True

    def holds(self, spark: SparkSession, batch_id: int) -> bool:
        """Whether a snapshot already has this batch in it."""
        return batch_id <= self._snapshot(spark)[0]

    def folders(self, spark: SparkSession) -> tuple[int, int]:
        """How many slice folders and batch folders a reader opens."""
        upto, slices = self._snapshot(spark)
        return len(slices), len(self._tail(spark, upto))

    def _batch(self, number: int) -> str:
        return f"{self.root}/batch_id={number}"

    def _snapshots(self, spark: SparkSession) -> list[int]:
        names = file_names(spark, f"{self.root}/{SNAPSHOTS}")
        return sorted(int(name[5:-5]) for name in names if name.startswith("upto="))

    def _snapshot(self, spark: SparkSession) -> tuple[int, dict[str, str]]:
        """The last merged batch and the folder of each slice."""
        numbers = self._snapshots(spark)
        return (numbers[-1], self._slices(spark, numbers[-1])) if numbers else (-1, {})

    def _slices(self, spark: SparkSession, number: int) -> dict[str, str]:
        return json.loads(read_text(spark, f"{self.root}/{SNAPSHOTS}/upto={number}.json"))

    def _tail(self, spark: SparkSession, upto: int) -> list[int]:
        names = [name for name in folder_names(spark, self.root) if name.startswith("batch_id=")]
        return sorted(number for number in (int(name[9:]) for name in names) if number > upto)

    def _rows(self, spark: SparkSession, folders: Sequence[str], number: int) -> DataFrame:
        rows = spark.read.schema(self.schema).parquet(*folders)
        return rows.withColumn("_batch", F.lit(number).cast("long"))

    def _batches(self, spark: SparkSession, numbers: Sequence[int]) -> DataFrame:
        rows = spark.read.schema(StructType(list(self.schema.fields)).add("batch_id", "long"))
        rows = rows.option("basePath", self.root).parquet(*map(self._batch, numbers))
        return rows.withColumnRenamed("batch_id", "_batch")

    def _touched(self, rows: DataFrame) -> set[str]:
        """Names of the slices to which rows belong: days, not rows."""
        if self.slice_by is None:
            return {NO_SLICE}
        values = rows.select(F.expr(self.slice_by).cast("long")).distinct()
        return {
            f"_slice={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"
            for (value,) in values.collect()
        }

    def _newest(self, spark: SparkSession, folders: Sequence[str], numbers: Sequence[int]) -> DataFrame:
        parts = [self._rows(spark, list(folders), -1)] if folders else []
        if numbers:
            parts.append(self._batches(spark, numbers))
        if not parts:
            return spark.createDataFrame([], self.schema)
        rows = parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0]
        rest = [name for name in self.schema.names if name not in self.keys]
        newest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), "_batch").alias("_newest"))
        return newest.select(
            *(F.col(n) if n in self.keys else F.col(f"_newest.{n}") for n in self.schema.names)
        )

    def _clean(self, spark: SparkSession, upto: int) -> None:
        """Remove what neither this snapshot nor the one before it names or precedes."""
        numbers = self._snapshots(spark)
        if len(numbers) < 2:
            return
        before = numbers[-2]
        needed = {path for n in numbers[-2:] for path in self._slices(spark, n).values()}
        base = f"{self.root}/{SNAPSHOTS}"
        for name in folder_names(spark, base):
            inner = [f"{base}/{name}/{child}" for child in folder_names(spark, f"{base}/{name}")]
            if not needed.intersection(inner):
                remove(spark, f"{base}/{name}")
        for number in numbers[:-2]:
            remove(spark, f"{base}/upto={number}.json")
        for number in self._tail(spark, -1):
            if number <= before:
                remove(spark, self._batch(number))
