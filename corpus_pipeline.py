"""From raw documents to packed windows: the stages of a training-data pipeline.

Defined results, each operator's own besides:
* A document with a null text is rejected by the classifier; an empty one has
  weight 0, and is kept, unless the limit is above that, as one that is nobody's
  copy. Texts of any length are classified, deduplicated and packed as a whole.
* Rows that repeat id and text leave one row (line dedup). Of a group of near
  copies the least id stays, null last. Ids may have any atomic type.
* Without a label all documents pass the classifier. Empty tables give no rows.
* Columns besides those of documents pass through to packing, whatever their
  names; the plan of windows that it returns has its own columns only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomsift.llm import linededup, mixing, neardup, packing, quality
from loomsift.llm.state import remove, shared_dir


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.resample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.drop_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

#: The classifier, near dedup and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each one's rows written as Parquet to the shared folder and read again by the next. Once a stage is written its predecessor's rows go; the last ones stay for the caller."""
    import uuid

    folder = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            remove(spark, f"{folder}/{k - 1}")
    return docs
