"""Session settings the jobs rely on, and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Partitions that a shuffle starts with, at least; AQE merges those of less than 64 KB.
PARTITIONS = 512


def prepare(spark: SparkSession, finer: bool = True) -> SparkSession:
    """UTC clock for all time arithmetic; AQE for run-time joins, coalescing and skew; times that files can be skipped by.

    ``finer`` starts shuffles with more partitions and merges them less.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Rows here are small but costly (they explode to grids), so start with more partitions and merge them less: bytes
    # shuffled say little of what a task will hold. Files written are not smaller for it, as the advisory size stays.
    started = max(PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    for setting in ("initialPartitionNum", "minPartitionNum"):
        name = f"spark.sql.adaptive.coalescePartitions.{setting}"
        spark.conf.set(name, str(started)) if finer else spark.conf.unset(name)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    # Split a hot join partition even when the aggregate above then needs its own shuffle.
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    # The older type has no statistics, so no row group could be skipped by a time.
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables that all executors share.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a
    local session that names none gets a folder of its own. Spark removes a checkpoint once nothing refers to
    it where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set, which only a session's start can do.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="limnocast-checkpoint-"))
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from the files."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


@contextmanager
def scratch_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """A new path in the shared folder for tables that one job writes and reads; removed at the end, also after a failure."""
    path = f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
