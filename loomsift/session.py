"""A Spark session with the settings that this library expects."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def session(app: str = "loomsift", master: str | None = None, **conf: str) -> SparkSession:
    """UTC, adaptive plans and Arrow; further settings as key=value with _ for the dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.files.ignoreCorruptFiles": "false",
        **{k.replace("_", "."): v for k, v in conf.items()},
    }
    spark = builder.config(map=settings).getOrCreate()
    small_batches(spark)
    return spark


def small_batches(spark: SparkSession) -> None:
    """Batches of a few MB between the JVM and Python, however long the texts are, unless the session has settings of its own."""
    for name, usual, small in (("maxBytesPerBatch", "67108864b", "4m"), ("maxRecordsPerBatch", "10000", "2000")):
        key = f"spark.sql.execution.arrow.{name}"
        if spark.conf.get(key) == usual:
            spark.conf.set(key, small)


def checkpoints(spark: SparkSession) -> None:
    """Iterative plans cut their lineage in the cluster's shared folder; a temporary one only where Spark is one process. What nothing refers to any more is deleted."""
    context = spark.sparkContext
    context._jsc.sc().conf().set("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if not context._jsc.sc().getCheckpointDir().isDefined():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = f"file://{tempfile.mkdtemp(prefix='loomsift-')}"
        context.setCheckpointDir(folder)


def release(spark: SparkSession, wait: float = 1.5) -> None:
    """Has the driver collect its garbage, so that Spark's cleaner deletes shuffles that nothing refers to now, not when the heap is full. Some are garbage only after a first round, and the cleaner works beside."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(wait)


def spread(df: DataFrame) -> DataFrame:
    """df in as many partitions as there are cores, if a scan gives fewer than half of that: files of one row group, or compressed as a whole, are read by one task each. A table of many files stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if 2 * df._jdf.queryExecution().toRdd().getNumPartitions() > cores:
        return df
    # the optimiser would move filters before the exchange, but not before an observation
    return df.repartition(cores, df[df.columns[0]]).observe(f"spread-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))
