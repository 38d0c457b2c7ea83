"""Enrichers: columns computed from a page. `add` refuses to overwrite unless told to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import normalize as nz
from ..functions import text as tx
from ..functions import words as wd


def add(df: DataFrame, name: str, value: Column, overwrite: bool = False) -> DataFrame:
    if name in df.columns and not overwrite:
        raise ValueError(f"the column {name} exists")
    return df.withColumn(name, value)


def line_count(text: Column, end: str = "\n", remove_empty: bool = True) -> Column:
    return F.size(tx.paragraphs(text, end, remove_empty))


def word_count(text: Column, model: str = "fasttext", ignore_punctuation: bool = True) -> Column:
    return wd.word_count(text, model, ignore_punctuation)


def language_of_page(text: Column, model: Column, newlines: str = "") -> Column:
    """A map of language to probability; empty for a text of spaces and punctuation. `model` is a function of the text, see `providers`. Newlines are deleted before."""
    return F.when(tx.is_space_or_punct(text), F.create_map().cast("map<string,double>")).otherwise(model(F.replace(text, F.lit("\n"), F.lit(newlines))))


def languages_of_sentences(df: DataFrame, key: str, text: str, model) -> DataFrame:
    """(key, languages): for each page a map of language to the mean probability and the number of its sentences."""
    rows = df.select(key, F.explode(wd.sentences(F.col(text))).alias("s"))
    scored = rows.select(key, F.explode(model(F.col("s"))).alias("lang", "p"))
    best = scored.groupBy(key, "lang").agg(F.avg("p").alias("average_probability"), F.count("*").cast("int").alias("number_of_sentences"))
    return best.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("lang", F.struct("average_probability", "number_of_sentences"))))).alias("languages"))


def high_quality_probability(text: Column, model) -> Column:
    """Probability of the good class; the model sees the text stripped and on one line."""
    return model(F.replace(tx.strip(text), F.lit("\n"), F.lit(" ")))


def high_quality_probability_of(df: DataFrame, text: Column, model, name: str, overwrite: bool = False) -> DataFrame:
    """The same by a model of whole tables, see `providers.QualityModel`."""
    scored = model.score(df, text, "_hq").drop("predicted")
    return add(scored, name, F.col("_hq"), overwrite).drop("_hq")


def perplexity(text: Column, line_scores) -> Column:
    """10 ** (-log10 probability / words), rounded to one digit. line_scores gives a struct (log10_prob, tokens) of a normalised text; each line counts an end mark."""
    return perplexity_from(line_scores(nz.language_model_line(text)))


def perplexity_from(s: Column) -> Column:
    return F.round(F.pow(F.lit(10.0), F.try_divide(-s["log10_prob"], s["tokens"])), 1)


def perplexity_of(df: DataFrame, text: Column, model, name: str, overwrite: bool = False) -> DataFrame:
    """df with the perplexity by a model that is a table, see `providers.NgramModel`."""
    scored = model.score(df, nz.language_model_line(text), "_lm", by=text)
    return add(scored, name, perplexity_from(F.col("_lm")), overwrite).drop("_lm")
