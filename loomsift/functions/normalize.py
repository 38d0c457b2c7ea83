"""Normalisers for deduplication keys."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as tx

#: Punctuation beyond ASCII and its ASCII form.
PUNCTUATION = {
    **dict.fromkeys("，、", ","), "。": ".", "．": ". ", "…": "...", **dict.fromkeys("„“”«»「」《》１", '"'), **dict.fromkeys("´’", "'"),
    **dict.fromkeys("：∶", ":"), "；": ";", "？": "?", "！": "!", "％": "%", "～": "~", "（": "(", "）": ")", "【": "[", "】": "]", "〈": "<", "〉": ">",
    **dict.fromkeys("–━►", "-"), "—": " - ",
}
CONTROL = r"\x{00}-\x{1f}\x{7f}-\x{9f}"
_EXTRA = str.maketrans({"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L", "þ": "th", "ð": "d", "ı": "i", "€": "EUR", "£": "PS", "©": "(c)", "®": "(r)"})


def url(c: Column) -> Column:
    """Without scheme, www., tracking parameters and final slashes."""
    out = F.regexp_replace(c, r"https?://(?:www\.)?", "")
    out = F.regexp_replace(out, r"(?s)\?(?:utm_|ref|feed).*", "")
    return F.regexp_replace(out, r"/+\z", "")


def whitespace_and_case(c: Column) -> Column:
    return F.lower(tx.strip(c))


def timestamp(c: Column) -> Column:
    """Seconds since 1970 (UTC) of a time like 2019-04-18T10:00:00Z, -1 for anything else."""
    exact = c.rlike(r"\A\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ\z")
    return F.coalesce(F.when(exact, F.unix_timestamp(F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")))).cast("double"), F.lit(-1.0))


def text_hash(c: Column) -> Column:
    return F.md5(c)


def replace_punctuation(c: Column) -> Column:
    single = {k: v for k, v in PUNCTUATION.items() if len(v) == 1}
    out = F.translate(c, "".join(single), "".join(single.values()))
    for k, v in PUNCTUATION.items():
        if len(v) > 1:
            out = F.replace(out, F.lit(k), F.lit(v))
    return out


def remove_punctuation(c: Column) -> Column:
    return F.translate(c, "".join(PUNCTUATION), "")


def remove_control(c: Column) -> Column:
    return F.regexp_replace(c, f"[{CONTROL}]", "")


def _fold(function):
    return F.arrow_udf(lambda a: pa.array([None if t is None else function(t) for t in a.to_pylist()], pa.string()), "string")


def strip_accents(c: Column) -> Column:
    return _fold(lambda t: "".join(x for x in unicodedata.normalize("NFD", t) if unicodedata.category(x) != "Mn"))(c)


def transliterate(t: str) -> str:
    """ASCII for Latin text; scripts that need a dictionary lose their letters."""
    return unicodedata.normalize("NFKD", t.translate(_EXTRA)).encode("ascii", "ignore").decode()


def dedup_key(c: Column) -> Column:
    """Lower case, digits as 0, no punctuation beyond ASCII or control characters, and ASCII letters."""
    out = F.regexp_replace(F.lower(tx.strip(c)), r"\p{Nd}", "0")
    return _fold(transliterate)(remove_control(remove_punctuation(out)))


def language_model_line(c: Column, accents: bool = False, case: bool = True, numbers: bool = True, punctuation: int = 1) -> Column:
    """The normalisation before n-gram scoring. accents: strip them; punctuation: 1 replaces it by ASCII, 2 deletes it."""
    out = tx.strip(c)
    out = F.lower(out) if case else out
    out = strip_accents(out) if accents else out
    out = F.regexp_replace(out, r"\p{Nd}", "0") if numbers else out
    out = {0: lambda x: x, 1: replace_punctuation, 2: remove_punctuation}[punctuation](out)
    return remove_control(out)


#: By name, for pipeline files. An unknown name is an error.
BY_NAME = {"normalize_url": url, "normalize_whitespace_and_lowercase": whitespace_and_case, "normalize_timestamps": timestamp, "hash_text": text_hash, "ccnet_dedup_normalizer": dedup_key}
