"""A catalog of datasets, models and evaluations: JSON records as tables, joined by their ids."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SUFFIX = {"K": 1e3, "M": 1e6, "B": 1e9, "T": 1e12}


def flatten(df: DataFrame) -> DataFrame:
    """Nested fields as columns with dots in their names."""

    def walk(schema: T.StructType, path: list[str]) -> list[Column]:
        out = []
        for f in schema.fields:
            here = [*path, f.name]
            if isinstance(f.dataType, T.StructType):
                out += walk(f.dataType, here)
            else:
                out.append(F.col(".".join(f"`{p}`" for p in here)).alias(".".join(here)))
        return out

    return df.select(*walk(df.schema, []))


def load(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Records below a folder, a file each, with the path they are from. Records of differing fields are unions of them."""
    reader = spark.read.option("multiLine", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json")
    return flatten((reader.schema(schema) if schema else reader).json(path).withColumn("source_path", F.input_file_name()))


def number(text: str) -> float:
    """12, 1.5B, 300K"""
    m = re.fullmatch(r"\s*(-?\d+(?:\.\d+)?)\s*([KMBTkmbt]?)\s*", text)
    if not m:
        raise ValueError(f"not a number: {text}")
    return float(m.group(1)) * SUFFIX.get(m.group(2).upper(), 1)


def condition(text: str) -> Column:
    """`column=regex` (found anywhere), or `column>=1B` and the like."""
    m = re.fullmatch(r"\s*([^<>=]+?)\s*(>=|<=|>|<|=)\s*(.*?)\s*", text)
    if not m:
        raise ValueError(f"not a filter: {text}")
    name, op, value = m.groups()
    column = F.col(f"`{name}`")
    if op == "=":
        return column.cast("string").rlike(value)
    x, v = column.try_cast("double"), number(value)
    return {">=": x >= v, "<=": x <= v, ">": x > v, "<": x < v}[op]


def where(df: DataFrame, *conditions: str) -> DataFrame:
    for c in conditions:
        df = df.where(condition(c))
    return df


def first_by(df: DataFrame, key: str, order: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(order)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def enrich_evaluations(evals: DataFrame, models: DataFrame, datasets: DataFrame) -> DataFrame:
    """Evaluations with columns of their model and of that model's dataset. An id that occurs twice counts once, so nothing fans out."""
    m = first_by(models, "uuid", "name").select(F.col("uuid").alias("model_uuid"), F.col("name").alias("model_name"), "dataset_uuid", *[c for c in models.columns if c not in ("uuid", "name", "dataset_uuid")])
    d = first_by(datasets, "uuid", "name").select(F.col("uuid").alias("dataset_uuid"), F.col("name").alias("dataset_name"), *[c for c in ("tokenizer", "num_tokens") if c in datasets.columns])
    return evals.join(m, "model_uuid", "left").join(d, "dataset_uuid", "left")


def name_references(df: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """For each column x_uuid the name of that record from the table xs, as x_name."""
    for c in [c for c in df.columns if c.endswith("_uuid")]:
        table = tables.get(c.removesuffix("_uuid") + "s")
        if table is not None:
            df = df.join(first_by(table, "uuid", "name").select(F.col("uuid").alias(c), F.col("name").alias(c.removesuffix("_uuid") + "_name")), c, "left")
    return df


def columns(df: DataFrame, leading: str = "", only: list[str] | None = None) -> DataFrame:
    """The named columns in their order, those that match the regex first."""
    names = [c for c in (only or df.columns) if c in df.columns]
    front = [c for c in names if leading and re.search(leading, c)]
    return df.select(*[f"`{c}`" for c in front + [c for c in names if c not in front]])


def find(df: DataFrame, key: str, value) -> DataFrame:
    return df.where(F.col(f"`{key}`") == value)


def rows(df: DataFrame, order: str, start: int, end: int) -> DataFrame:
    """Rows start to end (not with it) in the given order."""
    return df.orderBy(order).offset(start).limit(max(0, end - start))


def replace_prefix(column: Column, prefixes: dict[str, str]) -> Column:
    """The first prefix that fits is replaced."""
    out = None
    for old, new in prefixes.items():
        hit, value = column.startswith(old), F.concat(F.lit(new), F.substring(column, len(old) + 1, 1 << 30))
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return column if out is None else out.otherwise(column)


def with_mirror(df: DataFrame, mirror: str, fields: tuple[str, ...] = ("dataset_url", "manifest_url")) -> DataFrame:
    """Fields overridden by a mirror's values, where the map `mirrors` has it."""
    for f in fields:
        df = df.withColumn(f, F.coalesce(F.try_element_at(F.try_element_at(F.col("mirrors"), F.lit(mirror)), F.lit(f)), F.col(f)))
    return df


def run_name(df: DataFrame, fields: list[str], name: str = "run_name") -> DataFrame:
    return df.withColumn(name, F.concat_ws("-", *[F.concat(F.lit(f"{f}="), F.col(f).cast("string")) for f in fields]))


def dataset_record(spark: SparkSession, path: str, record: dict) -> None:
    """One JSON record; refuses to replace another."""
    import json

    spark.createDataFrame([(json.dumps(record),)], "value string").coalesce(1).write.mode("errorifexists").text(path)
