"""Shared working folders for data that has to outlive one Spark job."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Stored tables are mostly texts and hashes, which this packs far closer than the session's default.
CODEC = "zstd"
_local_folders: dict[str, str] = {}
_collecting: list[list[str]] = []


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared folder that the session names.

    A single-machine session that names none gets a temporary one. On a cluster
    that would not be seen by all executors, so the setting is required there.
    """
    base = spark.conf.get(CHECKPOINT_KEY, None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        if context.applicationId not in _local_folders:
            _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="listingloom-")
        base = _local_folders[context.applicationId]
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go when their write ends.

    Otherwise they stay until the driver happens to collect its garbage, so a plan of
    many writes holds the shuffles of all of them at once. For frames that are run
    once: a second run of the same one would have to make its shuffles again.
    """
    before = spark.conf.get(CLEANUP_KEY, None)
    spark.conf.set(CLEANUP_KEY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_KEY)
        else:
            spark.conf.set(CLEANUP_KEY, before)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and go on from the written table.

    Used where several branches read the same expensive frame. Unlike a cache
    the table survives lost executors, and each branch reads only its columns.
    """
    spark = df.sparkSession
    target = work_dir(spark, label)
    with shuffles_freed(spark):
        df.write.mode("errorifexists").option("compression", CODEC).parquet(target)
    if _collecting:
        _collecting[-1].append(target)
    return spark.read.schema(df.schema).parquet(target)


@contextmanager
def temporary_stages(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables staged inside when it ends.

    For plans that write all their results before they return; a frame that is
    still to be read must not rest on these tables.
    """
    made: list[str] = []
    _collecting.append(made)
    try:
        yield
    finally:
        _collecting.remove(made)
        hadoop = spark._jvm.org.apache.hadoop.fs
        for folder in made:
            path = hadoop.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
