"""Streams of pages: the row-wise operators run unchanged, dedup keeps state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import normalize as nz


def read(spark: SparkSession, path: str, schema: str, format: str = "json", files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).format(format).load(path)


def distinct_urls(pages: DataFrame, time: str = "ts", url: str = "url", delay: str = "1 day") -> DataFrame:
    """The first page of each normalised URL within the watermark; older keys leave the state."""
    return pages.withWatermark(time, delay).withColumn("_key", nz.url(F.col(url))).dropDuplicatesWithinWatermark(["_key"]).drop("_key")


def counts(events: DataFrame, time: str, by: str, window: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    return events.withWatermark(time, delay).groupBy(F.window(time, window), by).agg(F.count("*").alias("n"))


def write(df: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Parquet with exactly-once output; `once` takes what is there and ends."""
    writer = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start(path)
