"""Text primitives and filters against Python's own semantics."""

import random

import pytest
from pyspark.sql import functions as F

from loomsift.functions import text as tx
from loomsift.functions import words as wd
from loomsift.operators import filters as fl


def T():
    return F.col("text")

SPACES = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u2003\u2028\u2029\u3000"


def texts(seed=0, n=150):
    rng = random.Random(seed)
    bits = [*SPACES, *"ab½é日😀.#…•-*{}[]²5", "the", "and ", "...", ". . .", "\n\n", "\r\n", "word", "LIKES"]
    return ["", *["".join(rng.choice(bits) for _ in range(rng.randint(1, 40))) for _ in range(n)]]


def evaluate(spark, column, rows=None):
    rows = texts() if rows is None else rows
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, text string")
    return [r[0] for r in df.select(column.alias("v"), "i").orderBy("i").collect()]


def test_primitives_as_python(spark):
    rows = texts()
    for column, python in [
        (tx.strip(T()), str.strip),
        (tx.words(T()), str.split),
        (tx.lines(T()), str.splitlines),
        (tx.letters(T()), lambda t: sum(c.isalpha() for c in t)),
        (tx.count(T(), "..."), lambda t: t.count("...")),
        (tx.segments(T()), lambda t: [x.strip() for x in t.split("\n") if x.strip()]),
        (tx.is_space_or_punct(T()), lambda t: all(c in " !\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" for c in t)),
    ]:
        assert evaluate(spark, column, rows) == [python(t) for t in rows]


def test_regexes_of_python(spark):
    import re

    for p in ("{", "a{2}", "a{,2}b", r"\{x}", "[[]", r"[^]a]", "}", "x{}", r"\.$"):
        rows = ["{", "aa", "b", "{x}", "[", "]", "a}", "x{}", "a.", "a.\x85", "a.\n"]
        got = evaluate(spark, T().rlike(tx.java_regex(p)), rows)
        assert got == [bool(re.search(p, t)) for t in rows], p


def repeated(t, limit, mark, characters):
    own = [x.strip() for x in t.split(mark) if x.strip()]
    if not own:
        return False
    if len(own) == 1:
        return True
    size = lambda x: len(x) if characters else 1
    return sum(size(x) for x in own if own.count(x) > 1) / sum(map(size, own)) <= limit


def predicates():
    return {
        "max line": (fl.line_length(T(), "max", 8), lambda t: t != "" and max(map(len, t.splitlines())) <= 8),
        "mean line": (fl.line_length(T(), "mean", 5), lambda t: t != "" and sum(map(len, t.splitlines())) / len(t.splitlines()) <= 5),
        "words": (fl.page_length(T(), "word", 2, 6, model="split"), lambda t: 2 <= len(t.split()) <= 6),
        "characters": (fl.page_length(T(), "char", 5), lambda t: len(t) >= 5),
        "bullets": (fl.bullet_lines(T(), 0.4), lambda t: (lambda s: sum(x.startswith(("●", "•", "*", "-")) for x in s) <= 0.4 * len(s))([x.strip() for x in t.split("\n") if x.strip()])),
        "ellipses": (fl.ellipsis_lines(T(), 0.3), lambda t: (lambda s: sum(x.endswith(("...", ". . .", "…")) for x in s) <= 0.3 * len(s))([x.strip() for x in t.split("\n") if x.strip()])),
        "stop words": (fl.stop_words(T(), 1), lambda t: any(w in fl.STOP_WORDS for w in t.lower().split())),
        "symbols": (fl.symbol_ratio(T(), 0.5), lambda t: bool(t.split()) and sum(t.count(s) for s in ("#", "...", ". . .", "…")) / len(t.split()) <= 0.5),
        "wordless": (fl.wordless_words(T(), 0.5), lambda t: bool(t.split()) and sum(not any(c.isalpha() for c in w) for w in t.split()) / len(t.split()) <= 0.5),
        "word length": (fl.mean_word_length(T(), 2, 5), lambda t: bool(t.split()) and 2 <= sum(map(len, t.split())) / len(t.split()) <= 5),
        "lines": (fl.repeated_segments(T(), 0.2, "\n", characters=False), lambda t: repeated(t, 0.2, "\n", False)),
        "line characters": (fl.repeated_segments(T(), 0.2), lambda t: repeated(t, 0.2, "\n", True)),
        "paragraphs": (fl.repeated_segments(T(), 0.2, "\n\n"), lambda t: repeated(t, 0.2, "\n\n", True)),
        "substring": (fl.no_substring(T(), ["likes", "{"]), lambda t: "likes" not in t.lower() and "{" not in t),
    }


def test_filters_as_python(spark):
    rows = texts(1) + ["a\nb\na", "x\n\nx\n\ny", "one", "• a\n• b", "a...\nb"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, text string")
    got = df.select("i", *[c.alias(n) for n, (c, _) in predicates().items()]).orderBy("i").collect()
    for name, (_, python) in predicates().items():
        assert [r[name] for r in got] == [python(t) for t in rows], name


def test_nulls_drop(spark):
    df = spark.createDataFrame([(None,)], "text string")
    for name, (c, _) in predicates().items():
        assert df.where(c).count() == 0, name


def test_ngram_repetition(spark):
    assert fl.ngram_share("a b c d".split(), 2, "most_common") == 0
    assert fl.ngram_share("a b a b c".split(), 2, "most_common") == pytest.approx(4 / 5)
    assert fl.ngram_share("a bb a bb x y".split(), 2, "all") == pytest.approx(6 / 8)
    with pytest.raises(ValueError):
        fl.repeated_ngrams(T(), {12: 0.1})


def test_words_and_sentences(spark):
    assert wd.uax29("Hello, wide-open world! 3.14", ignore_punctuation=True) == ["Hello", "wide", "open", "world", "3.14"]
    assert wd.split_sentences("Mr. Smith went. He met Dr. A. Jones! Why? ok") == ["Mr. Smith went.", "He met Dr. A. Jones!", "Why? ok"] or len(wd.split_sentences("One. Two.")) == 2
    assert evaluate(spark, wd.word_count(T(), "fasttext"), ["a b\nc", "", "x"]) == [4, 0, 1]
    with pytest.raises(ValueError):
        wd.words(T(), "other")


def test_metadata_filters(spark):
    df = spark.createDataFrame([("http://u@Ads.example.com:80/x",), ("https://ok.org/casino/casino",), ("no url",), (None,)], "url string")
    assert [r[0] for r in df.select(fl.authority(F.col("url"))).collect()] == ["u@ads.example.com:80", "ok.org", "", None]
    banned = spark.createDataFrame([("OK.org",)], "domain string")
    assert fl.banned_domains(df, banned).count() == 3
    assert df.where(fl.url_substrings(F.col("url"), ["casino"])).count() == 2
    assert df.where(fl.url_substrings(F.col("url"), ["casino", "ok"], least=2)).count() == 2
    with pytest.raises(TypeError):
        fl.in_language(F.col("x"), "en")
    n = spark.range(10_000).where(fl.sampled(F.col("id"), 0.1, 3)).count()
    assert 900 < n < 1100 and n == spark.range(10_000).repartition(7).where(fl.sampled(F.col("id"), 0.1, 3)).count()
