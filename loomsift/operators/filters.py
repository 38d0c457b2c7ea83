"""Filters: predicates that say which pages stay.

Each function takes the text (or metadata) column and returns a boolean column
for `where`. A null input gives null, which drops the row. Those that need a few
numbers about the text (its words, segments, symbols) share one Arrow function
that measures a whole column of bytes; the others, but for the tokenizer,
`uniseg` and repetition rules, are built-in expressions.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import features as ft
from ..functions import text as tx
from ..functions import words as wd

#: Suffixes of source files, by language family.
SOURCE_SUFFIXES = (
    *"Dockerfile Makefile .dockerfile .cmake".split(),
    *".c .C .cc .cpp .c++ .h .H .hh .hpp .h++ .cs .m .go .rs .java .scala".split(),
    *".py .rb .lua .pl .perl .pm .pod .php .phps .phpt .php3 .php4 .php5 .jl .hs".split(),
    *".js .ts .tsx .css .html .xml .sql .vb .asm .smali".split(),
    *".f .for .fpp .f03 .f08 .f77 .f90 .f95".split(),
    *".sh .zsh .bash .bat .cmd .command .ps1 .psd1 .psm1".split(),
    *".md .markdown .rst .tex".split(),
)
STOP_WORDS = ft.STOP_WORDS
#: Most repetition that a page may have: n -> share of characters in repeated n-grams.
NGRAM_LIMITS = {2: 0.20, 3: 0.18, 4: 0.16, 5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}


def source_file(filename: Column, suffixes: tuple[str, ...] = SOURCE_SUFFIXES) -> Column:
    """The file name ends in one of the suffixes; case counts, and a null name doesn't pass."""
    return F.coalesce(reduce(lambda a, b: a | b, [filename.endswith(s) for s in suffixes]), F.lit(False))


def line_length(text: Column, kind: str = "max", limit: float = 1000) -> Column:
    """The longest line (or the mean) has at most `limit` characters; an empty text doesn't pass."""
    sizes = F.transform(tx.lines(text), lambda x: F.length(x))
    if kind not in ("max", "mean"):
        raise ValueError(f"unknown kind of length: {kind}")
    value = F.array_max(sizes) if kind == "max" else F.try_divide(tx.total(sizes), F.size(sizes))
    return (text != "") & (value <= limit)


def alphanumeric_ratio(text: Column, least: float = 0.25) -> Column:
    return F.coalesce(F.try_divide(tx.alphanumerics(text), F.length(text)) >= least, F.lit(False))


def letters_per_token(text: Column, tokenizer_file: str, least: float = 1.5) -> Column:
    """Letters / tokens of a byte-pair tokenizer (a `tokenizers` JSON file) reach `least`; an empty text doesn't pass."""

    def count(texts: pa.Array) -> pa.Array:
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(tokenizer_file)
        t.encode_special_tokens = True
        return pa.array([None if x is None else len(t.encode(x, add_special_tokens=False).ids) for x in texts.to_pylist()], pa.int32())

    return F.coalesce(F.try_divide(tx.letters(text), F.arrow_udf(count, "int")(text)) >= least, F.lit(False))


def repeated_segments(text: Column, limit: float, mark: str = "\n", characters: bool = True, ignore_case: bool = False) -> Column:
    """Lines (or other segments) that occur more than once, every occurrence counted, make up at most `limit`.

    One segment alone passes, none doesn't. Sorting puts equal segments side by
    side, so the cost is n log n in the number of segments.
    """
    own = tx.segments(F.lower(text) if ignore_case else text, mark)
    size = lambda a: tx.total(F.transform(a, lambda s: F.length(s).cast("long"))) if characters else F.size(a)

    def verdict(ordered: Column) -> Column:
        repeated = F.filter(ordered, lambda s, i: ((i > 0) & (F.try_element_at(ordered, i) == s)) | (F.try_element_at(ordered, i + 2) == s))
        share = F.coalesce(F.try_divide(size(repeated), size(ordered)), F.lit(0.0))
        return F.when(F.size(ordered) == 0, False).when(F.size(ordered) == 1, True).otherwise(share <= limit)

    # a lambda's variable is computed once, while an expression inside a lambda is computed for each element
    return F.when(text.isNotNull(), F.transform(F.array(F.array_sort(own)), verdict)[0])


def ngram_share(words: list[str], n: int, rule: str) -> float:
    """Share of characters in repeated n-grams. `most_common`: the most frequent one (the longest of those tied); `all`: every word that some repeated n-gram covers."""
    if len(words) < n or n < 1:
        return 0.0
    lengths = np.fromiter((len(w) for w in words), np.int64, len(words))
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    grams = np.unique(np.lib.stride_tricks.sliding_window_view(ids, n), axis=0, return_inverse=True)[1].ravel()
    counts = np.bincount(grams)
    if counts.max() == 1:
        return 0.0
    total = lengths.sum()
    if rule == "most_common":
        sizes = np.convolve(lengths, np.ones(n, np.int64), "valid")
        return float((sizes[counts[grams] == counts.max()].max() * counts.max()) / total)
    hit = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(counts[grams] > 1)
    np.add.at(hit, at, 1)
    np.add.at(hit, at + n, -1)
    return float(lengths[np.cumsum(hit[:-1]) > 0].sum() / total)


def repeated_ngrams(text: Column, limits: dict[int, float] | None = None, rule: str | None = None, ignore_case: bool = False) -> Column:
    """No n has a larger share of repeated n-grams than its limit. n of 2 to 4 go by the most common n-gram, larger ones by all; other n need a rule.

    All n are looked at in one pass over a text's words (UAX #29, words only),
    and the first that fails ends it.
    """
    limits = NGRAM_LIMITS if limits is None else limits
    rules = {n: rule or ("most_common" if 2 <= n <= 4 else "all" if 5 <= n <= 10 else None) for n in limits}
    if None in rules.values():
        raise ValueError("n-grams of other sizes than 2 to 10 need a rule")

    def run(texts: pa.Array) -> pa.Array:
        own = texts.to_pylist()
        return pa.array([None if t is None else bool(ok) for t, ok in zip(own, _ngrams_ok(own, limits, rules, ignore_case))], pa.bool_())

    return F.arrow_udf(run, "boolean")(text)


def _ngrams_ok(texts: list[str | None], limits: dict[int, float], rules: dict[int, str], ignore_case: bool = False) -> list[bool]:
    """The rule of `repeated_ngrams` for some thousand words at a time."""
    out: list[bool] = []
    held: list[list[str]] = []
    size = 0
    how = {n: (rules[n], limit) for n, limit in limits.items()}
    for t in texts:
        held.append(wd.uax29(t.lower() if ignore_case else t, ignore_punctuation=True) if t else [])
        size += len(held[-1])
        if size > 200_000:
            out += ft.ngram_verdicts(held, how).tolist()
            held, size = [], 0
    out += ft.ngram_verdicts(held, how).tolist()
    return [bool(t) and ok for t, ok in zip(texts, out)]


def _segments_ok(text: str, mark: str, limits: list[tuple[bool, float]]) -> bool:
    """Whether repeated segments stay within each limit, by characters (true) or number."""
    own = [s for s in map(str.strip, text.split(mark)) if s]
    if len(own) < 2:
        return len(own) == 1
    times = Counter(own)
    if len(times) == len(own):
        return True
    again = [(len(s), n) for s, n in times.items() if n > 1]
    shares = {True: sum(size * n for size, n in again) / sum(map(len, own)), False: sum(n for _, n in again) / len(own)}
    return all(shares[by] <= limit for by, limit in limits)


def web_repetition(text: Column, skip_paragraphs: bool = False) -> Column:
    """The thirteen repetition rules for web pages: lines and paragraphs by number and by characters, then n-grams."""
    marks = ["\n"] if skip_paragraphs else ["\n", "\n\n"]
    rules = {n: "most_common" if n <= 4 else "all" for n in NGRAM_LIMITS}

    def run(texts: pa.Array) -> pa.Array:
        own = texts.to_pylist()
        left = [t if t and all(_segments_ok(t, m, [(False, 0.30), (True, 0.20)]) for m in marks) else None for t in own]
        return pa.array([None if t is None else ok for t, ok in zip(own, _ngrams_ok(left, NGRAM_LIMITS, rules))], pa.bool_())

    return F.arrow_udf(run, "boolean")(text)


def length_of(text: Column, kind: str, model: str = "fasttext", ignore_punctuation: bool = False, paragraph_end: str = "\n\n", remove_empty: bool = True) -> Column:
    if kind == "char":
        return F.length(text)
    if kind == "line":
        return F.size(tx.paragraphs(text, "\n", remove_empty))
    if kind == "paragraph":
        return F.size(tx.paragraphs(text, paragraph_end, remove_empty))
    if kind == "word" and model == "split" and not ignore_punctuation:
        return ft.of(text)["words"]
    if kind == "word":
        return wd.word_count(text, model, ignore_punctuation)
    if kind == "sentence":
        return wd.sentence_count(text)
    raise ValueError(f"unknown kind of length: {kind}")


def page_length(text: Column, kind: str, least: float = 1, most: float = float("inf"), **how) -> Column:
    """The page has between `least` and `most` words, sentences, lines, paragraphs or characters."""
    n = length_of(text, kind, **how)
    return (n >= least) & (n <= F.lit(float(most)))


def no_substring(text: Column, banned: list[str], where: str = "any", case_sensitive: bool = False, exact_word: bool = False) -> Column:
    """None of the regexes occurs: anywhere, at the beginning (`prefix`) or at the end (`suffix`)."""
    pattern = tx.any_of(banned, case_sensitive=True, word=exact_word).removeprefix("(?d)")
    pattern = {"any": pattern, "prefix": rf"\A{pattern}", "suffix": rf"{pattern}(?=\n?\z)"}[where]
    return ~text.rlike(("(?d)" if case_sensitive else "(?iud)") + pattern)


def bullet_lines(text: Column, most: float = 0.9) -> Column:
    """Lines that begin with a bullet (or * or -) are at most this share."""
    f = ft.of(text)
    return f["bullets"] <= f["segments"] * most


def ellipsis_lines(text: Column, most: float = 0.3) -> Column:
    f = ft.of(text)
    return f["ellipses"] <= f["segments"] * most


def stop_words(text: Column, least: int = 2, unique: bool = False, words: tuple[str, ...] = STOP_WORDS) -> Column:
    """At least so many stop words, in all or distinct ones; a page without any never passes."""
    if words == STOP_WORDS:
        return ft.of(text)["distinct_stop_words" if unique else "stop_words"] >= max(1, least)
    found = F.filter(tx.words(F.lower(text)), lambda w: w.isin(*words))
    n = F.size(F.array_distinct(found) if unique else found)
    return n >= max(1, least)


def mean_word_length(text: Column, least: float = 0, most: float = float("inf")) -> Column:
    f = ft.of(text)
    mean = F.try_divide(f["word_chars"], f["words"])
    return F.coalesce(mean.between(F.lit(float(least)), F.lit(float(most))), F.lit(False))


def symbol_ratio(text: Column, most: float = 0.1) -> Column:
    """#, ... (also spaced, or as one character) per word."""
    f = ft.of(text)
    return F.coalesce(F.try_divide(f["symbols"], f["words"]) <= most, F.lit(False))


def words_removed(text: Column, before: Column, after: Column | None = None, most: float = 0.05, model: str = "fasttext", ignore_punctuation: bool = True) -> Column:
    """At most this share of the words that a page had went; a page that had none doesn't pass."""
    now = wd.word_count(text, model, ignore_punctuation) if after is None else after
    return F.coalesce(F.try_divide(before - now, before) <= most, F.lit(False))


def wordless_words(text: Column, most: float = 0.2) -> Column:
    """Words without a letter are at most this share."""
    f = ft.of(text)
    return F.coalesce(F.try_divide(f["wordless"], f["words"]) <= most, F.lit(False))


def sampled(key: Column, probability: float, seed: int = 0) -> Column:
    """A coin for each row from a hash of its key: the same rows on every run and every cluster."""
    return tx.draw(key, seed) < probability


def in_language(probabilities: Column, languages: list[str], threshold: float = 0.0) -> Column:
    """One of the languages has a probability above the threshold; probabilities is a map."""
    if not isinstance(languages, (list, tuple)):
        raise TypeError("languages is a list")
    return F.exists(F.array(*[F.lit(x) for x in languages]), lambda x: F.coalesce(F.try_element_at(probabilities, x), F.lit(0.0)) > threshold)


def scored(score: Column, threshold: float = 0.0, lower_is_better: bool = False) -> Column:
    """The score reaches the threshold (or stays under it); a null score doesn't pass."""
    return F.coalesce(score <= threshold if lower_is_better else score >= threshold, F.lit(False))


def _without(text: Column, ignored: Sequence[str]) -> Column:
    """text without any of the given strings, taken out one after another."""
    for x in [ignored] if isinstance(ignored, str) and ignored else ignored:
        text = F.replace(text, F.lit(x), F.lit(""))
    return text


def authority(url: Column, ignored: Sequence[str] = (), case_sensitive: bool = False) -> Column:
    """The part of a URL between // and the next / ? or #, user and port included, without the ignored strings; empty where there is none."""
    host = F.regexp_extract(url, r"\A[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    return _without(host if case_sensitive else F.lower(host), ignored)


def banned_domains(pages: DataFrame, banned: DataFrame, url: str = "url", ignored: Sequence[str] = (), case_sensitive: bool = False) -> DataFrame:
    """Pages whose domain, without the ignored strings, isn't in the column `domain` as that stands. Spark broadcasts the list only if it knows it to be small."""
    key = authority(F.col(url), ignored, case_sensitive)
    names = banned.select((F.col("domain") if case_sensitive else F.lower("domain")).alias("_domain")).where("_domain is not null").distinct()
    return pages.join(names, key == names["_domain"], "left_anti")


def url_substrings(url: Column, banned: list[str], ignored: Sequence[str] = (), least: int = 1, inside_words: bool = True, case_sensitive: bool = False) -> Column:
    """Fewer than `least` distinct banned strings (literals) occur in the URL; matches don't overlap."""
    text = _without(url if case_sensitive else F.lower(url), ignored)
    items = sorted({b if case_sensitive else b.lower() for b in banned}, key=lambda b: (-len(b), b))
    body = tx.any_of(items, case_sensitive=True, word=not inside_words, literal=True)
    return F.size(F.array_distinct(F.regexp_extract_all(text, F.lit(body), F.lit(0)))) < least
