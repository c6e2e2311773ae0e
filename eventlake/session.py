"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every operator relies on: event times are UTC, AQE re-plans joins and splits
# skewed partitions, and stream state lives off-heap and is saved as changes, not as whole snapshots.
# Rows grow up to thirtyfold behind a shuffle here (ids become JSON texts, keys and hashes), so AQE makes
# tasks of 8 MB: 64 MB became over 1 GB to sort in one task, and hardly more tasks than cores. Files of texts
# and keys are packed with zstd, in about half the bytes of snappy, and read in tasks of 8 MB as well.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.files.maxPartitionBytes": "8m",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

CHECKPOINT_SETTING = "spark.checkpoint.dir"
# A row group is the least that one task can read of a file: packed, 4 MB hold some 90,000 messages. Most columns
# here are ids, keys and texts, for which a dictionary is built in vain; zstd packs the others about as well.
WITHOUT_DICTIONARY = {"parquet.enable.dictionary": "false"}
ROW_GROUP = {"parquet.block.size": 4 << 20, **WITHOUT_DICTIONARY}
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "eventlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; extra settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the library's runtime settings on a session somebody else built."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.conf.get("spark.master", "").startswith("local")


def streaming_session(spark: SparkSession) -> SparkSession:
    """A sibling session for stateful queries.

    State is partitioned once, at the first start, by ``spark.sql.shuffle.partitions``. A local run
    that kept the default would open hundreds of state stores, so it takes its core count instead.
    """
    sibling = apply_settings(spark.newSession())
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    if is_local(spark):
        partitions = str(min(int(partitions), spark.sparkContext.defaultParallelism))
    sibling.conf.set("spark.sql.shuffle.partitions", partitions)
    return sibling


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder named by ``spark.checkpoint.dir``.

    Executors and a restarted driver must all reach it, so a machine-local folder is used only when
    the whole session is one process.
    """
    base = spark.conf.get(CHECKPOINT_SETTING, None)
    if not base:
        if not is_local(spark):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
        base = os.path.join(tempfile.gettempdir(), "eventlake-scratch")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` computed once and read back from Parquet files in the shared folder.

    For wide or many rows that several steps read: columns are compressed, and each step opens only its own.
    """
    return written_to(df, scratch_dir(df.sparkSession, purpose))


def written_to(df: DataFrame, path: str) -> DataFrame:
    """The same in a folder of its own, whose files it replaces."""
    with shuffles_removed(df.sparkSession):
        df.write.mode("overwrite").options(**ROW_GROUP).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def emptied(df: DataFrame) -> None:
    """Give up the rows of a ``written`` frame that no later step reads: its files are replaced by empty ones."""
    for path in {unquote(f.rsplit("/", 1)[0]) for f in df.inputFiles()}:
        written_to(df.limit(0), path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes started inside remove their shuffle files when they end, not when the driver's memory is next
    cleaned up. The setting is taken back, since the shuffles of a frame that is read again are still needed."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once and written to the shared checkpoint folder, with its lineage cut."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_dir(spark, "checkpoints"))
    return df.checkpoint()
