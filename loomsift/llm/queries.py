"""The queries of this subpackage, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, htmlcrf, lblm, linededup, mixing, neardup, ogg, packing, quality, secrets


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that importance resampling keeps, with their weights."""
    return quality.resample(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"), scored=True)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lblm.score(_read(spark, sf_dir, "documents"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmlcrf.extract(_read(spark, sf_dir, "pages"))


def op4_ogg_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packets of a media column that holds every document as an Ogg file."""
    return ogg.demux(ogg.media_table(_read(spark, sf_dir, "documents")))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_read(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document that goes, beside the one of its group that stays."""
    return neardup.duplicates(_read(spark, sf_dir, "documents"))


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest of all vectors for each whose id is divisible by 50."""
    return ann.neighbours(_read(spark, sf_dir, "embeddings"), k=10, asked=F.expr("vec_id % 50 = 0"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, sf_dir, "documents"), copy="copy")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(_read(spark, sf_dir, "documents")).select("doc_id", "text")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_html_extraction": op3_html_extraction,
    "op4_ogg_packets": op4_ogg_packets,
    "op5_secret_scan": op5_secret_scan,
    "op6_packing": op6_packing,
    "op7_near_dedup": op7_near_dedup,
    "op8_nearest_neighbours": op8_nearest_neighbours,
    "op9_mixing": op9_mixing,
    "op10_line_dedup": op10_line_dedup,
}

ORACLE_SQL: dict[str, str] = {
    "op5_secret_scan": secrets.SQL,
    "op9_mixing": mixing.SQL,
    "op10_line_dedup": linededup.SQL,
}
