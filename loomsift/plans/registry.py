"""Operators by name, for pipeline files and for users' own functions.

An operator is made from keyword arguments and is one of: a predicate, a map of
the text, an enricher, or a change of the whole table. Users register their own
with `register`, or name a dotted path to a builder; plain Python row functions
(a dict to a list of dicts) run in Arrow batches through `row_function`.
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import normalize as nz
from ..operators import aggregates as ag
from ..operators import dedup as dd
from ..operators import enrichers as en
from ..operators import filters as fl
from ..operators import modifiers as md
from ..operators import packing as pk


@dataclass(frozen=True)
class Op:
    """kind: filter, modify, enrich or table. build: keyword arguments to a function of a DataFrame. wide: needs a shuffle."""

    kind: str
    apply: Callable[[DataFrame], DataFrame]
    name: str
    wide: bool = False


_BUILDERS: dict[str, tuple[str, Callable[..., Callable[[DataFrame], DataFrame]], bool]] = {}


def register(name: str, kind: str, wide: bool = False):
    """Decorates a builder: keyword arguments in, a function of a DataFrame out."""
    if kind not in ("filter", "modify", "enrich", "table"):
        raise ValueError(f"unknown kind of operator: {kind}")

    def add(build):
        _BUILDERS[name] = (kind, build, wide)
        return build

    return add


def names() -> list[str]:
    return sorted(_BUILDERS)


def make(func: str, **kwargs) -> Op:
    """The operator of this name. Arguments that begin with _ are for the pipeline and not passed on."""
    own = {k: v for k, v in kwargs.items() if not k.startswith("_") and k not in ("func", "module")}
    if func in _BUILDERS:
        kind, build, wide = _BUILDERS[func]
        return Op(kind, build(**own), func, wide)
    module, _, name = func.rpartition(".")
    if not module:
        raise KeyError(f"no operator is called {func}")
    if module.startswith("."):
        raise ValueError("relative imports are refused")
    return Op("table", getattr(importlib.import_module(module), name)(**own), func)


def row_function(function: Callable[[dict], list[dict]], schema: T.StructType | str) -> Callable[[DataFrame], DataFrame]:
    """A Python function from a row to rows as an operator. A row that raises, or a result that isn't a list, gives no row but one with `_error`."""

    def apply(df: DataFrame) -> DataFrame:
        out = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        full = T.StructType([*out.fields, T.StructField("_error", T.StringType())])
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(full)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = []
                for row in b.to_pylist():
                    try:
                        made = function(row)
                        rows += made if isinstance(made, list) else [{"_error": f"no list: {type(made).__name__}"}]
                    except Exception as e:  # the page is reported, not the job stopped
                        rows.append({"_error": repr(e)})
                yield from pa.Table.from_pylist(rows, schema=arrow).to_batches()

        return df.mapInArrow(run, full)

    return apply


def _predicate(name: str, make_column: Callable[..., Column]):
    register(name, "filter")(lambda **kw: lambda df: df.where(make_column(**kw)))


def _text(name: str, make_column: Callable[..., Column]):
    register(name, "modify")(lambda **kw: lambda df: md.apply(df, "text", make_column(F.col("text"), **kw)))


_text_ = lambda: F.col("text")
_as_list = lambda x: [x] if isinstance(x, str) else list(x)


def _file(path: str) -> list[str]:
    with open(path, encoding="utf-8") as f:
        return [x for x in f.read().splitlines() if x]


def _banned(banlist, banlist_from_fname) -> list[str]:
    return _file(banlist_from_fname) if banlist_from_fname else _as_list(banlist or [])


_predicate("github_extension_filter", lambda filename_key="filename", allowed_extensions=None: fl.source_file(F.col(filename_key), *([tuple(_as_list(allowed_extensions))] if allowed_extensions else [])))
_predicate("line_length_filter", lambda length_type="max", max_length=1000: fl.line_length(_text_(), length_type, max_length))
_predicate("alphanumeric_char_ratio_filter", lambda max_alnum_ratio=0.25: fl.alphanumeric_ratio(_text_(), max_alnum_ratio))
_predicate("alphabetic_characters_to_tokens_filter", lambda tokenizer, max_ratio=1.5: fl.letters_per_token(_text_(), tokenizer, max_ratio))
_predicate("massive_web_repetition_filters", lambda skip_paragraph=False: fl.web_repetition(_text_(), skip_paragraph))
_predicate("page_length_filter", lambda length_type, min_length=1, max_length=float("inf"), tokenizer=None, tokenizer_lang=None, **kw: fl.page_length(_text_(), length_type, min_length, max_length, **kw))
_predicate("substring_filter", lambda banlist=None, banlist_from_fname=None, location="any", case_sensitive=False, exact_word=False: fl.no_substring(_text_(), _banned(banlist, banlist_from_fname), location, case_sensitive, exact_word))
_predicate("bullet_count_filter", lambda max_bullet_start_ratio=0.9: fl.bullet_lines(_text_(), max_bullet_start_ratio))
_predicate("ellipsis_count_filter", lambda max_ellipsis_end_ratio=0.3: fl.ellipsis_lines(_text_(), max_ellipsis_end_ratio))
_predicate("stop_word_filter", lambda count_unique=False, min_stop_word=2: fl.stop_words(_text_(), min_stop_word, count_unique))
_predicate("word_length_filter", lambda min_length=0, max_length=float("inf"): fl.mean_word_length(_text_(), min_length, max_length))
_predicate("symbol_ratio_filter", lambda max_symbol_to_word_ratio=0.1: fl.symbol_ratio(_text_(), max_symbol_to_word_ratio))
_predicate("word_removal_ratio_filter", lambda prev_word_count_key, new_word_count_key=None, max_removed_ratio=0.05, ignore_punctuation=True, model="fasttext": fl.words_removed(_text_(), F.col(prev_word_count_key), F.col(new_word_count_key) if new_word_count_key else None, max_removed_ratio, model, ignore_punctuation))
_predicate("alphabetic_word_ratio_filter", lambda max_ratio=0.2: fl.wordless_words(_text_(), max_ratio))
_predicate("random_sampling_filter", lambda keep_probability=0.1, key="text", seed=0: fl.sampled(F.col(key), keep_probability, seed))
_predicate("language_filter", lambda keep_languages, key, threshold=0.0: fl.in_language(F.col(key), keep_languages, threshold))


@register("quality_filter", "filter")
def _quality(key, threshold=0.0, lower_better=False, key_must_exist=True):
    """Rows without the key go; a table without it is refused if it must exist."""

    def apply(df: DataFrame) -> DataFrame:
        if key not in df.columns:
            if key_must_exist:
                raise ValueError(f"there is no column {key}")
            return df.where(F.lit(False))
        return df.where(fl.scored(F.col(key), threshold, lower_better))

    return apply




def repetition(granularity, max_fraction, count_characters=True, ngram_char_ratio=None, ignore_case=False):
    if isinstance(granularity, int):
        return fl.repeated_ngrams(_text_(), {granularity: max_fraction}, ngram_char_ratio, ignore_case)
    return fl.repeated_segments(_text_(), max_fraction, {"line": "\n", "paragraph": "\n\n"}[granularity], count_characters, ignore_case)


_predicate("repetition_filter", repetition)


@register("url_substring_filter", "filter")
def _urls(banlist=None, banlist_from_fname=None, ignore_chars=None, num_banned_substrs=1, exact_domain_match=False, match_substrings=True, case_sensitive=False):
    banned, ignored = _banned(banlist, banlist_from_fname), _as_list(ignore_chars or [])
    if exact_domain_match:
        return lambda df: fl.banned_domains(df, df.sparkSession.createDataFrame([(b,) for b in banned], "domain string"), "url", ignored, case_sensitive)
    return lambda df: df.where(fl.url_substrings(F.col("url"), banned, ignored, num_banned_substrs, match_substrings, case_sensitive))


_text("arxiv_appendix_modifier", md.cut_appendix)
_text("arxiv_comment_modifier", lambda c, remove_multiline=False: md.drop_comments(c, remove_multiline))
_text("arxiv_macro_modifier", md.expand_macros)
_text("arxiv_section_strip_modifier", lambda c, compat=False: md.from_first_section(c, compat))
_text("html_content_extraction_modifier", md.html_text)
_text("substring_line_modifier", lambda c, banlist, case_sensitive=False, location="any", max_length=None, remove_substring_only=False: md.drop_lines_with(c, banlist, case_sensitive, location, max_length, remove_substring_only))
_text("punctuation_line_modifier", lambda c, remove_ellipses=False: md.punctuated_lines(c, remove_ellipses))
_text("line_length_modifier", lambda c, min_length=0, max_length=float("inf"): md.lines_by_length(c, min_length, max_length))
_text("word_length_modifier", lambda c, max_length=1000, model="split": md.lines_by_longest_word(c, max_length, model))
_text("uppercase_ratio_line_modifier", lambda c, max_ratio=0.5: md.uppercase_lines(c, max_ratio))
_text("numeric_ratio_line_modifier", lambda c, max_ratio=1.0: md.numeric_lines(c, max_ratio))
_text("citation_removal_modifier", md.drop_citations)
_text("url_removal_modifier", lambda c, tlds_filepath=None, tlds=("com", "org", "net", "edu", "gov", "io", "info"), strict_gate=False: md.drop_urls(c, _file(tlds_filepath) if tlds_filepath else list(tlds), strict_gate))
_text("counter_line_modifier", md.drop_counters)
_text("within_page_dedup", lambda c, granularity="line", normalize=True: md.dedup_within(c, granularity, normalize))
_text("newline_removal_modifier", lambda c, max_consecutive=2: md.squeeze_newlines(c, max_consecutive))

register("split_lines_modifier", "modify")(lambda delimiter="\n": lambda df: df if isinstance(df.schema["text"].dataType, T.ArrayType) else md.apply(df, "text", md.split_lines(F.col("text"), delimiter)))
register("join_lines_modifier", "modify")(lambda delimiter="\n": lambda df: md.apply(df, "text", md.join_lines(F.col("text"), delimiter)) if isinstance(df.schema["text"].dataType, T.ArrayType) else df)
register("move_url_modifier", "modify")(lambda: md.url_from_metadata)
register("key_name_modifier", "modify")(lambda old_key="content", new_key="text", allow_overwrite=False: lambda df: md.rename(df, old_key, new_key, allow_overwrite))
register("starcoder_v2_repo_splitter", "table")(lambda max_files=1000: lambda df: md.split_repositories(df, max_files))
register("starcoder_v2_format_modifier", "modify")(lambda add_metadata_prob=0.5, add_sentinels=True, seed=0: lambda df: md.apply(df, "text", md.format_repository(F.col("files"), F.col("repo_name"), F.col("repo_name"), add_metadata_prob, add_sentinels, seed)))
register("stackexchange_list_modifier", "modify")(lambda: lambda df: md.on_posts(df, md.mark_lists))
register("stackexchange_answer_sort_modifier", "modify")(lambda descending=True: lambda df: df.withColumn("answers", md.sort_answers(F.col("answers"), descending)))
register("stackexchange_html_extraction_modifier", "modify")(lambda: lambda df: md.on_posts_html(df))
register("stackexchange_qa_formatter", "modify")(lambda remove_qa=False: lambda df: (lambda out: out.drop("question", "answers") if remove_qa else out)(md.apply(df, "text", md.question_and_answers(F.col("question"), F.col("answers")))))
register("pattern_splitter", "table")(lambda pattern, context=0: lambda df: md.split_around(df, pattern, context))

register("line_counter_enricher", "enrich")(lambda paragraph_end="\n", remove_empty=True, key="num_lines", overwrite=False: lambda df: en.add(df, key, en.line_count(F.col("text"), paragraph_end, remove_empty), overwrite))
register("word_counter_enricher", "enrich")(lambda key="word_count", model="fasttext", ignore_punctuation=True, overwrite=False: lambda df: en.add(df, key, en.word_count(F.col("text"), model, ignore_punctuation), overwrite))
register("detect_lang_whole_page_enricher", "enrich")(lambda provider, model="own", key_prefix="language_id_whole_page", overwrite=False, seed=None: lambda df: en.add(df, f"{key_prefix}_{model}", en.language_of_page(F.col("text"), provider), overwrite))
register("classify_fasttext_hq_prob_enricher", "enrich")(lambda provider, key="fasttext_hq_prob", overwrite=False: lambda df: en.high_quality_probability_of(df, F.col("text"), provider, key, overwrite) if hasattr(provider, "score") else en.add(df, key, en.high_quality_probability(F.col("text"), provider), overwrite))
register("ken_lm_perplexity_enricher", "enrich")(lambda provider, key="kenlm_perplexity", overwrite=False: lambda df: en.perplexity_of(df, F.col("text"), provider, key, overwrite) if hasattr(provider, "score") else en.add(df, key, en.perplexity(F.col("text"), provider), overwrite))


@register("detect_lang_paragraph_enricher", "enrich", wide=True)
def _sentence_languages(provider, model="own", tokenizer=None, key_prefix="language_id_paragraph", row_key="doc_id", overwrite=False):
    key = f"{key_prefix}_{model}"

    def apply(df: DataFrame) -> DataFrame:
        if key in df.columns and not overwrite:
            raise ValueError(f"the column {key} exists")
        found = en.languages_of_sentences(df, row_key, "text", provider).withColumnRenamed("languages", key)
        return df.drop(key).join(found, row_key, "left")

    return apply


FUZZY = {"paragraph": dd.fuzzy_paragraphs, "document": dd.fuzzy_documents, **{f"{r}-both" if r != "both" else r: (lambda df, r=r, **kw: dd.fuzzy_both(df, rule=r, **kw)) for r in ("old", "naive", "both")}}


@register("fuzzy_dedup", "table", wide=True)
def _fuzzy(remove_type="paragraph", ngram_size=13, threshold=0.8, row_key="doc_id", stored=None, update=True):
    if stored:
        return lambda df: dd.fuzzy_incremental(df, stored, row_key, "text", ngram_size, threshold, remove_type, update=update)
    return lambda df: FUZZY[remove_type](df, key=row_key, size=ngram_size, threshold=threshold)


register("tokenize", "enrich")(lambda tokenizer_file, key="tokens", pattern=None: lambda df: pk.tokenize(df, tokenizer_file, "text", key, pattern))
register("pack_contexts", "table", wide=True)(lambda length=pk.CONTEXT, shard_key="source", row_key="doc_id", end=pk.END_OF_TEXT, pad=-1: lambda df: pk.contexts(pk.end_marked(df, end=end), shard_key, row_key, length=length, pad=pad))


@register("exact_dedup", "table", wide=True)
def _exact(content_key="text", normalize=None, selection_key=None, selection_normalize=None, selection_reverse=False, row_key="doc_id"):
    norm = nz.BY_NAME[normalize] if normalize else lambda c: c
    pick = nz.BY_NAME[selection_normalize] if selection_normalize else lambda c: c

    def apply(df: DataFrame) -> DataFrame:
        order = [(pick(F.col(selection_key)))] if selection_key else []
        if isinstance(df.schema[content_key].dataType, T.ArrayType):
            if selection_reverse:
                raise ValueError("units have no reverse order")
            return dd.exact_units(df, content_key, norm, order, row_key)
        order = [o.desc() if selection_reverse else o for o in order]
        return dd.exact(df, norm(F.col(content_key)), [*order, F.col(row_key)])

    return apply


AGGREGATORS = {"percentiles": ag.percentiles, "histogram": lambda df, v: ag.counts(df, v) if isinstance(df.schema[v].dataType, T.StringType) else ag.histogram(df, v)}
TRANSFORMS = {"threshold_transform": lambda c, threshold, default: ag.top_key(c, threshold, default)}
