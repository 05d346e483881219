"""Helpers that several operators share: tables written between steps, sizes, batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from hashlib import blake2b

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clicktide.session import planned_bytes, shared_folder

# Word separators of the contracts: space and the five ASCII controls \t \n \v \f \r.
# ``bytes.split()`` splits at the same six bytes.
BLANKS = r"[\x20\x09-\x0D]+"
ROWS_A_BATCH = 1000


def written(rows: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the cluster's shared folder.

    Cuts the lineage: what follows reads files that outlive any executor.
    """
    spark = rows.sparkSession
    path = shared_folder(spark, label)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def few_rows_a_batch(spark: SparkSession) -> None:
    """Let Spark hand over at most ``ROWS_A_BATCH`` rows to Python at once, from now on.

    Rows that are whole texts are long: Spark's default of 10,000 would keep tens of MB of
    each task in both processes. A lower setting of the session stays.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ROWS_A_BATCH:
        spark.conf.set(name, str(ROWS_A_BATCH))


def text_bytes(texts: DataFrame, column: str = "text") -> int:
    """Bytes of all texts, counted over the whole table."""
    return texts.agg(F.sum(F.octet_length(column))).first()[0] or 0


def tasks_for(rows: DataFrame, bytes_each: int = 32 << 20) -> int:
    """Tasks for a shuffle of these rows: one for so many bytes of the files they come from.

    At least the session's own number; rows of unknown size get that as well.
    """
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    planned = planned_bytes(rows)
    return least if planned >= 1 << 60 else max(least, -(-planned // bytes_each))


@contextmanager
def shuffles_for(rows: DataFrame) -> Iterator[None]:
    """Run the block with ``tasks_for(rows)`` shuffle partitions, then restore the session's number."""
    conf, name = rows.sparkSession.conf, "spark.sql.shuffle.partitions"
    before, tasks = conf.get(name), tasks_for(rows)
    conf.set(name, str(tasks))
    try:
        yield
    finally:
        conf.set(name, before)


def joined_to_totals(rows: DataFrame, totals: DataFrame, on: list[str], size: str, share: int = 1000) -> DataFrame:
    """Inner join of rows with one row of totals for each key, whatever share a key holds.

    ``size`` in ``totals`` counts the key's rows. Keys with a ``share``-th of all rows are at
    most ``share``, and are broadcast; the others are shuffled, where none can weigh much.
    Nulls are a key like any other. Both inputs are read twice: pass written tables.
    """
    all_rows = totals.agg(F.sum(size)).first()[0] or 0
    large = F.col(size) * share >= F.lit(all_rows)
    keys = [F.struct(F.col(k).isNull(), F.col(k)) for k in on]
    named = totals.withColumn("key_of_totals", F.struct(*keys)).drop(*on)
    keyed = rows.withColumn("key_of_rows", F.struct(*keys))
    same = F.col("key_of_rows") == F.col("key_of_totals")
    heavy = F.broadcast(named.where(large))
    by_broadcast = keyed.join(heavy, same)
    rest = keyed.join(heavy.select("key_of_totals"), same, "left_anti")
    by_shuffle = rest.join(named.where(~large), same)
    return by_broadcast.unionByName(by_shuffle).drop("key_of_rows", "key_of_totals")


def in_fold(key: str | Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the key as text leaves this remainder; a null key counts as ''."""
    as_text = F.coalesce((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit(""))
    return F.crc32(F.encode(as_text, "UTF-8")) % folds == fold


def computed_once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, however often it names the value."""
    return F.transform(F.array(value), use)[0]


def hash_share(*keys: str) -> Column:
    """A number in [0, 1) by the keys' hash: a filter on it keeps that share of the keys.

    A hash leaves nulls out, so rows whose keys are all null are kept or dropped together.
    """
    return F.xxhash64(*keys) / F.lit(2.0**64) + 0.5


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def small_batches(
    batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 4 << 20, most_rows: int = 2000
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most_bytes`` of text; a longer text is one alone.

    After the last one Arrow gives back what it holds, as a worker goes on to other tasks.
    """
    try:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(column))
            lengths = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
            start, held = 0, 0
            for i, length in enumerate(lengths):
                if held and (held + length > most_bytes or i - start >= most_rows):
                    yield batch.slice(start, i - start)
                    start, held = i, 0
                held += int(length) + 64
            if start < batch.num_rows:
                yield batch.slice(start)
    finally:
        pa.default_memory_pool().release_unused()


def hash64(data: bytes) -> int:
    """A 64-bit hash as a signed number."""
    return int.from_bytes(blake2b(data, digest_size=8).digest(), "little", signed=True)
