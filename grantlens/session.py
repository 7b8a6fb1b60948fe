"""Session settings and the shared working folder."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this library runs well with, small or large.  None of
# them fixes a partition count: that follows from the data through adaptive
# execution.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The vocabulary of a document is a small set of ids; let a task hold a few
    # thousand of them before it falls back to sorting.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "2048",
    # A batch of a stream of files names each file, and listing them takes a task for every name unless
    # tasks share them.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session that already runs."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def work_folder(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Where it is unset, a
    local session gets a folder of its own; a cluster has to name one, because a
    folder on one machine would be lost with that machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="grantlens-")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{work_folder(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a frame that several results read, and read it back.

    The plan behind it then runs once, and the table survives lost executors.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
