"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Target size of a rebalanced archive file and of a coalesced shuffle block.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # Window state lives in RocksDB, so it is bounded by disk and not by heap;
    # changelogs keep the per-batch commit proportional to what changed.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str = "clicktide", conf: dict[str, str] | None = None) -> SparkSession:
    """A session in UTC with adaptive execution; ``conf`` overrides any default.

    Master, memory and parallelism stay with ``spark-submit``.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


MIB = 1024 * 1024
SPLIT_BYTES = (128 * MIB, 1024 * MIB)
INPUT_PER_SHUFFLE_PARTITION = 256 * MIB
# Beyond this the driver's bookkeeping starts to cost more than smaller partitions save.
MAX_SHUFFLE_PARTITIONS = 50_000


def sizing(
    input_bytes: int, cores: int, most_partitions: int = MAX_SHUFFLE_PARTITIONS
) -> dict[str, str]:
    """Scan and shuffle settings for a batch job over that much Parquet.

    Reports read a few columns of a split, so splits may be large: four rounds of
    tasks per core, within bounds. Shuffles start with a partition per 256 MiB of
    input, which adaptive execution merges where partial counts are smaller.
    ``most_partitions`` bounds their number; raise it with the driver's memory for
    inputs of more than 12 TiB per job.
    """
    smallest, largest = SPLIT_BYTES
    split = min(max(input_bytes // (4 * cores), smallest), largest)
    partitions = min(max(input_bytes // INPUT_PER_SHUFFLE_PARTITION, cores), most_partitions)
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(partitions),
    }


def planned_bytes(*frames: DataFrame) -> int:
    """What the optimizer expects to be read: of the tables' files the share of the columns
    that are needed, whatever rows are. No file is opened for it."""
    return sum(sum(_scans(frame._jdf.queryExecution().optimizedPlan())[0]) for frame in frames)


def _scans(plan) -> tuple[list[int], bool]:
    """Bytes of each scan as the projections directly above leave them; whether only those are."""
    own = int(str(plan.stats().sizeInBytes()))
    children = [plan.children().apply(i) for i in range(plan.children().size())]
    if not children:
        return [own], True
    below = [_scans(child) for child in children]
    if plan.nodeName() in ("Project", "Filter") and below[0][1]:
        return [min(own, *below[0][0])], True
    return [size for sizes, _ in below for size in sizes], False


@contextmanager
def sized_for(
    spark: SparkSession, input_bytes: int, most_partitions: int = MAX_SHUFFLE_PARTITIONS
) -> Iterator[None]:
    """Run the block with ``sizing`` for this session's cores, then restore."""
    settings = sizing(input_bytes, spark.sparkContext.defaultParallelism, most_partitions)
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def shared_root(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``.

    Without that setting a temporary folder is used, but only where driver and
    executors are one process; on a cluster a machine-local folder would lose data.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="clicktide-")
    return root.rstrip("/")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``shared_root``, gone with the application."""
    folder = f"{shared_root(spark)}/clicktide-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return f"{folder}/{label}-{uuid.uuid4().hex}"
