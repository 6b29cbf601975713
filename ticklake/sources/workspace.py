"""Where intermediate tables go: a fresh subfolder of the shared folder named by the cluster."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; where that is unset, a folder of the warehouse, which executors share too."""
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    return (root or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared").rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/ticklake/{purpose}/{uuid.uuid4().hex}"


@contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside delete their shuffle files when they end. Else these stay until the driver happens to collect its garbage, so
    that a run of several writes holds the shuffles of all of them on disk."""
    before = spark.conf.get(SHUFFLE_CLEANUP_CONF)
    spark.conf.set(SHUFFLE_CLEANUP_CONF, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP_CONF, before)


def settle(df: DataFrame, purpose: str = "settled", partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once as Parquet and read it back: computed a single time, cheap to count, safe
    against lost executors, and with real file sizes for the optimizer."""
    path = scratch_path(df.sparkSession, purpose)
    with freeing_shuffles(df.sparkSession):
        df.write.partitionBy(*partition_by).parquet(path)
    settled = df.sparkSession.read.schema(df.schema).parquet(path)
    settled.settled_at = path
    return settled


def discard(*tables: DataFrame) -> None:
    """Delete what ``settle`` wrote for these frames; they and all that reads them must not be used again."""
    for table in tables:
        jvm = table.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(table.settled_at)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def sweep(spark: SparkSession, older_than_hours: float) -> int:
    """Delete scratch tables that were made longer ago; how many. Lazy frames read theirs until they are done, so leave
    more time than the longest job takes."""
    jvm, deleted = spark._jvm, 0
    root = jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/ticklake")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    limit = (time.time() - older_than_hours * 3600) * 1000
    for purpose in fs.listStatus(root) if fs.exists(root) else []:
        for table in fs.listStatus(purpose.getPath()):
            if table.getModificationTime() < limit:
                deleted += fs.delete(table.getPath(), True)
    return deleted
