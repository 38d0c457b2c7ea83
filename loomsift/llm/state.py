"""Intermediate tables that outlive the loss of an executor."""

from __future__ import annotations

import gc
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset, a temporary one, but only if Spark runs in one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='loomsift-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    # a checkpoint goes when nothing refers to its rows any more
    spark.sparkContext._jsc.sc().conf().set("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint: the rows as written once to the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def small_batches(spark: SparkSession) -> None:
    """Batches of a few MB between the JVM and Python, however long the texts are, unless the session sets its own."""
    for name, usual, small in (("maxBytesPerBatch", "67108864b", "4m"), ("maxRecordsPerBatch", "10000", "2000")):
        key = f"spark.sql.execution.arrow.{name}"
        if spark.conf.get(key) == usual:
            spark.conf.set(key, small)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder, wherever Hadoop's file systems reach."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def release(spark: SparkSession) -> None:
    """Has the driver collect its garbage. Spark's cleaner goes by that: shuffles, broadcasts and checkpoints that nothing refers to leave disks and memory now, not when the heap happens to be full; finished plans leave the heap."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def table(df: DataFrame):
    """df written as Parquet to the shared folder; it is deleted at the end of the block."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path)
