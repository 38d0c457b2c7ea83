"""JSON lines and listings: reading, writing, sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx

SUFFIXES = ("jsonl", "jsonl.gz", "jsonl.zst", "jsonl.zstd")
GLOB = "*.{jsonl,jsonl.gz,jsonl.zst,jsonl.zstd}"


def read(spark: SparkSession, path: str | list[str], schema: str | None = None, recursive: bool = True, lineage: bool = False) -> DataFrame:
    """Plain, gzip and zstd JSON lines below a folder; lineage adds the file that a row is from as `source_file`. A given schema saves a pass over the data."""
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", GLOB)
    df = (reader.schema(schema) if schema else reader).json(path)
    return df.withColumn("source_file", F.input_file_name()) if lineage else df


def write(df: DataFrame, path: str, compression: str = "gzip", mode: str = "errorifexists", files: int | None = None) -> None:
    """JSON lines, an even number of files if wanted. Appending works with every compression, by new files."""
    (df.repartition(files) if files else df).write.mode(mode).option("compression", compression).json(path)


def output_paths(base: str) -> dict[str, str]:
    """Where a run puts its rows and its statistics."""
    return {"data": f"{base.rstrip('/')}/processed_data", "stats": f"{base.rstrip('/')}/stats"}


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    _, p, fs = _files(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> bool:
    _, p, fs = _files(spark, path)
    return fs.delete(p, True)


def make_folder(spark: SparkSession, path: str) -> bool:
    _, p, fs = _files(spark, path)
    return fs.mkdirs(p)


def list_files(spark: SparkSession, path: str, suffixes: tuple[str, ...] = SUFFIXES, containing: tuple[str, ...] = (), most: int | None = None) -> list[str]:
    """Sorted files below a folder with one of the suffixes; statistics are left out. Filters come before the limit."""
    _, p, fs = _files(spark, path)
    found, walk = [], fs.listFiles(p, True)
    while walk.hasNext():
        name = walk.next().getPath().toString()
        if name.endswith(tuple("." + s for s in suffixes)) and "/stats/" not in name and not name.endswith("_stats.jsonl") and all(c in name for c in containing):
            found.append(name)
    return sorted(found)[:most]


def folder_size(spark: SparkSession, path: str) -> int:
    _, p, fs = _files(spark, path)
    return fs.getContentSummary(p).getLength()


def keys(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(key): lines of text files, those that begin with a match of the pattern."""
    df = spark.read.text(path).withColumnRenamed("value", "key")
    return df.where(F.col("key").rlike(rf"\A(?:{pattern})")) if pattern else df


def sample(df: DataFrame, n: int, key: str = "key", seed: int = 42) -> DataFrame:
    """n rows, the same ones on every run: those with the least seeded hash of their key."""
    return df.orderBy(tx.draw(F.col(key), seed), key).limit(n)


def head(df: DataFrame, order: str, n: int | None = None, fraction: float | None = None) -> DataFrame:
    """The first n rows, or the first fraction of them, in the given order."""
    return df.orderBy(order).limit(int(df.count() * fraction) if n is None else n)


def crawl_paths(spark: SparkSession, folder: str, prefix: str = "") -> DataFrame:
    """(path): archives named by the path lists of crawls."""
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.paths.gz").text(folder).select(F.concat(F.lit(prefix), "value").alias("path"))


def text_archive_path(path: Column) -> Column:
    """From a path of raw records to that of extracted text."""
    return F.replace(F.replace(path, F.lit("/warc/"), F.lit("/wet/")), F.lit("warc.gz"), F.lit("warc.wet.gz"))


def not_done(paths: DataFrame, done: DataFrame, key: str = "path") -> DataFrame:
    """Inputs that aren't in the list of finished ones."""
    return paths.join(done.select(key), key, "left_anti")


def ban_list(spark: SparkSession, folder: str, categories: list[str]) -> DataFrame:
    """(category, kind, item): the files `domains` and `urls` of each category."""
    parts = [spark.read.text(f"{folder}/{c}/{kind}").select(F.lit(c).alias("category"), F.lit(kind).alias("kind"), F.trim("value").alias("item")) for c in categories for kind in ("domains", "urls")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where("item <> ''").distinct()


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)
