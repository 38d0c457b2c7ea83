"""Word and sentence models that built-in expressions can't give: Arrow functions over whole columns."""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as tx

#: Abbreviations after which a full stop doesn't end a sentence.
ABBREVIATIONS = frozenset("mr mrs ms dr prof sr jr st vs etc e.g i.e no inc ltd co corp fig vol al approx dept gen rep sen gov capt lt col sgt rev hon".split())
_STOP = re.compile(r"""([.!?…]+["'”’)\]]*)(\s+)(?=["'“‘(\[]*[^\s])""")


@lru_cache(maxsize=1)
def _boundary():
    import regex

    return regex.compile(r"(?wV1)\b"), regex.compile(r"\s")


_L, _LNE = r"A-Za-z\xaa\xb5\xb8\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", r"A-Za-z\xaa\xb5\xb8\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f0-9_"
#: Texts of these characters (apostrophes have rules by vowel), for which _LATIN_WORDS finds what the boundaries of UAX #29 leave, white space apart.
_LATIN = re.compile(r"[\0-&(-\xac\xae-\u024f]*")
_LATIN_WORDS = re.compile(rf"[{_LNE}]+(?:(?:(?<=[{_L}])[.:\xb7](?=[{_L}])|(?<=[0-9])[.,;](?=[0-9]))[{_LNE}]+)*|\S")


def uax29(text: str, ignore_punctuation: bool = False, ignore_whitespace: bool = True) -> list[str]:
    """Words by Unicode's default boundaries (UAX #29)."""
    if ignore_whitespace and _LATIN.fullmatch(text):
        found = _LATIN_WORDS.findall(text)
        return [w for w in found if w[0].isalnum()] if ignore_punctuation else found
    boundary, space = _boundary()
    if ignore_whitespace:
        return [w for w in boundary.split(text) if w and w[0].isalnum()] if ignore_punctuation else [w for w in boundary.split(text) if w.strip()]
    out: list[str] = []
    for token in boundary.split(text):
        if not token:
            continue
        for w in list(token) if space.match(token) else [token]:
            if not ignore_punctuation or w[0].isalnum() or w[0].isspace():
                out.append(w)
    return out


def split_sentences(text: str) -> list[str]:
    """Sentences by end marks, but not after abbreviations, initials or numbers before a lower-case word."""
    out, begin = [], 0
    for m in _STOP.finditer(text):
        before = text[begin : m.start()].rsplit(None, 1)
        last = before[-1].lower() if before else ""
        if m.group(1)[0] == "." and (last.strip("\"'(“‘") in ABBREVIATIONS or len(last) == 1 and last.isalpha() or text[m.end()].islower()):
            continue
        out.append(text[begin : m.end(1)].strip())
        begin = m.end()
    rest = text[begin:].strip()
    return [s for s in [*out, rest] if s]


def _map(function, kind: str):
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else function(t) for t in texts.to_pylist()], pa.int32() if kind == "int" else pa.list_(pa.string()))

    return F.arrow_udf(run, "int" if kind == "int" else "array<string>")


def words(c: Column, model: str = "split", ignore_punctuation: bool = False, ignore_whitespace: bool = True) -> Column:
    """Words of a text as an array. `split` and `fasttext` stay in the JVM; `uniseg` (UAX #29) is an Arrow function."""
    if model == "uniseg":
        return _map(lambda t: uax29(t, ignore_punctuation, ignore_whitespace), "list")(c)
    if model not in ("split", "fasttext"):
        raise ValueError(f"unknown word model: {model}")
    found = tx.words(c) if model == "split" else tx.fasttext_tokens(c)
    return F.filter(found, lambda w: w.rlike(r"\A[\p{L}\p{N}]")) if ignore_punctuation else found


def word_count(c: Column, model: str = "split", ignore_punctuation: bool = False, ignore_whitespace: bool = True) -> Column:
    if model == "uniseg":
        return _map(lambda t: len(uax29(t, ignore_punctuation, ignore_whitespace)), "int")(c)
    return F.size(words(c, model, ignore_punctuation, ignore_whitespace))


def sentences(c: Column) -> Column:
    return _map(split_sentences, "list")(c)


def sentence_count(c: Column) -> Column:
    return _map(lambda t: len(split_sentences(t)), "int")(c)
