"""Numbers about texts, for whole Arrow columns at once.

A column of strings is one run of UTF-8 bytes and offsets into it. Words, lines
and characters are found in the bytes by numpy, so that no Python code runs per
word; the rules of the content filters are then comparisons of numbers. All
filters of a plan that look at the same text share one evaluation, since they
refer to the same function of the same column.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

FIELDS = ("words", "word_chars", "wordless", "stop_words", "distinct_stop_words", "symbols", "segments", "bullets", "ellipses")
STOP_WORDS = ("and", "be", "have", "of", "that", "the", "to", "with")
_SCHEMA = "struct<" + ", ".join(f"{f}: bigint" for f in FIELDS) + ">"
_ASCII_SPACE = np.zeros(256, bool)
_ASCII_SPACE[[*range(9, 14), *range(28, 33)]] = True
_PRIME = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    out = np.zeros(0x110000, bool)
    for block in (range(0x32400), range(0xE0000, 0xE0200)):
        out[block.start : block.stop] = [chr(c).isalpha() for c in block]
    return out


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, null as empty, and n + 1 offsets."""
    column = column.fill_null("") if column.null_count else column
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def spaces(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to white space, as str.isspace() has it."""
    out = _ASCII_SPACE[data]
    at = np.flatnonzero((data == 0xC2) | (data == 0xE1) | (data == 0xE2) | (data == 0xE3))
    if len(at):
        pad = np.concatenate([data, np.zeros(2, np.uint8)])
        a, b, c = pad[at], pad[at + 1], pad[at + 2]
        two = at[(a == 0xC2) & ((b == 0x85) | (b == 0xA0))]
        wide = (a == 0xE1) & (b == 0x9A) & (c == 0x80) | (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)) | (a == 0xE2) & (b == 0x81) & (c == 0x9F) | (a == 0xE3) & (b == 0x80) & (c == 0x80)
        out[two] = out[two + 1] = True
        for k in range(3):
            out[at[wide] + k] = True
    return out


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begins and ends of the words of str.split(), and for each text the number of its first one (n + 1 entries)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    gap = spaces(data)
    change = np.empty(len(data) + 1, bool)
    change[0] = change[-1] = True
    np.not_equal(gap[1:], gap[:-1], out=change[1:-1])
    change[off] = True
    edges = np.flatnonzero(change)
    real = ~gap[edges[:-1]]
    begin, end = edges[:-1][real], edges[1:][real]
    return begin, end, np.searchsorted(begin, off)


def _sum(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]


def _is_letter(data: np.ndarray) -> np.ndarray:
    """Which bytes begin a letter."""
    out = np.zeros(len(data), bool)
    out[((data | 32) >= 97) & ((data | 32) <= 122)] = True
    at = np.flatnonzero(data >= 0xC2)
    if len(at):
        pad = np.concatenate([data, np.zeros(3, np.uint8)])
        lead = data[at].astype(np.int64)
        one, two, three = ((pad[at + k] & 0x3F).astype(np.int64) for k in (1, 2, 3))
        code = np.where(lead < 0xE0, (lead & 0x1F) << 6 | one, np.where(lead < 0xF0, (lead & 0x0F) << 12 | one << 6 | two, (lead & 7) << 18 | one << 12 | two << 6 | three))
        out[at] = _letters()[np.minimum(code, 0x10FFFF)]
    return out


def _runs_of_three(at: np.ndarray, step: int, first: np.ndarray) -> np.ndarray:
    """For each text how many times three marks follow each other at the given distance, without overlap."""
    if not len(at):
        return np.zeros(len(first) - 1, np.int64)
    text = np.searchsorted(first, at, "right") - 1
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != step) | (text[1:] != text[:-1])
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, len(at)))
    return np.bincount(text[begin], size // 3, len(first) - 1).astype(np.int64)


def _ends_with(data: np.ndarray, begin: np.ndarray, end: np.ndarray, mark: bytes) -> np.ndarray:
    ok = end - begin >= len(mark)
    for k, byte in enumerate(reversed(mark), 1):
        ok &= data[np.maximum(end - k, 0)] == byte
    return ok


def measure(texts: pa.Array) -> pa.StructArray:
    """The struct of FIELDS for each text."""
    data, off = utf8(texts)
    begin, end, first = word_spans(data, off)
    n = len(off) - 1
    starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)])
    letters = np.concatenate([[0], np.cumsum(_is_letter(data), dtype=np.int64)])
    text = np.repeat(np.arange(n), np.diff(first))
    stop, distinct = np.zeros(n, np.int64), np.zeros(n, np.int64)
    low = np.where((data >= 65) & (data <= 90), data | 32, data)
    padded = np.concatenate([low, np.zeros(8, np.uint8)])
    for word in STOP_WORDS:
        hit = end - begin == len(word)
        for k, byte in enumerate(word.encode()):
            hit &= padded[begin + k] == byte
        found = np.bincount(text[hit], minlength=n)
        stop += found
        distinct += found > 0
    dots = np.flatnonzero(data == 0x2E)
    chain = dots[np.isin(dots - 2, dots) & (data[np.maximum(dots - 1, 0)] == 32) | np.isin(dots + 2, dots) & (data[np.minimum(dots + 1, max(len(data) - 1, 0))] == 32)] if len(dots) else dots
    ellipsis = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x80) & (data[2:] == 0xA6)) if len(data) > 2 else np.zeros(0, np.int64)
    count = lambda at: np.bincount(np.searchsorted(off, at, "right") - 1, minlength=n)
    symbols = count(np.flatnonzero(data == 0x23)) + _runs_of_three(dots, 1, off) + _spaced(data, chain, off) + count(ellipsis)
    # a segment is what lies between newlines, if it has a word
    line = np.concatenate([[0], np.cumsum(data == 10, dtype=np.int64)])[begin]
    opens = np.ones(len(begin), bool)
    opens[1:] = (line[1:] != line[:-1]) | (text[1:] != text[:-1])
    heads = np.flatnonzero(opens)
    s_begin, s_end, s_text = begin[heads], end[np.append(heads[1:], len(begin)) - 1] if len(begin) else end, text[heads]
    wide = np.concatenate([data, np.zeros(3, np.uint8)])
    a, b, c = wide[s_begin], wide[s_begin + 1], wide[s_begin + 2]
    bullet = (a == 0x2A) | (a == 0x2D) | (a == 0xE2) & ((b == 0x97) & (c == 0x8F) | (b == 0x80) & (c == 0xA2))
    trails = _ends_with(data, s_begin, s_end, b"...") | _ends_with(data, s_begin, s_end, b". . .") | _ends_with(data, s_begin, s_end, "…".encode()) if len(heads) else np.zeros(0, bool)
    values = (
        np.diff(first), _sum(starts[end] - starts[begin], first), _sum(letters[end] == letters[begin], first), stop, distinct, symbols,
        np.bincount(s_text, minlength=n), np.bincount(s_text[bullet], minlength=n), np.bincount(s_text[trails], minlength=n),
    )
    mask = texts.is_null() if texts.null_count else None
    return pa.StructArray.from_arrays([pa.array(np.asarray(v), pa.int64()) for v in values], list(FIELDS), mask=mask)


def _spaced(data: np.ndarray, dots: np.ndarray, off: np.ndarray) -> np.ndarray:
    """How often ". . ." occurs in each text, without overlap. dots: those with a space and another dot on one side."""
    if not len(dots):
        return np.zeros(len(off) - 1, np.int64)
    text = np.searchsorted(off, dots, "right") - 1
    new = np.ones(len(dots), bool)
    new[1:] = (np.diff(dots) != 2) | (text[1:] != text[:-1]) | (data[dots[1:] - 1] != 32)
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, len(dots)))
    return np.bincount(text[begin], size // 3, len(off) - 1).astype(np.int64)


@lru_cache(maxsize=4)
def _function(application: str):
    @F.arrow_udf(_SCHEMA)
    def text_features(texts: pa.Array) -> pa.Array:
        out, at = [], 0
        _, off = utf8(texts)
        while at < len(texts):  # a few MB at a time
            to = max(at + 1, int(np.searchsorted(off, off[at] + (4 << 20), "right")) - 1)
            out.append(measure(texts.slice(at, to - at)))
            at = to
        return pa.concat_arrays(out) if out else measure(texts)

    return text_features


def of(text: Column) -> Column:
    """The struct of FIELDS; null for a null text."""
    return _function(SparkSession.active().sparkContext.applicationId)(text)


def ngram_verdicts(words: list[list[str]], rules: dict[int, tuple[str, float]]) -> np.ndarray:
    """Whether, for every n, the share of characters in repeated n-grams stays within its limit, for each text's words.

    rules: n -> (rule, limit). `most_common` counts the most frequent n-gram
    (the longest of those tied), `all` every word that some repeated n-gram
    covers. n-grams are told apart by 64-bit hashes of their words' numbers.
    """
    counts = np.fromiter(map(len, words), np.int64, len(words))
    ok = np.ones(len(words), bool)
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for ws in words for w in ws), np.uint64, counts.sum())
    lengths = np.fromiter((len(w) for ws in words for w in ws), np.int64, counts.sum())
    text = np.repeat(np.arange(len(words)), counts)
    sizes = np.concatenate([[0], np.cumsum(lengths)])
    first = np.concatenate([[0], np.cumsum(counts)])
    total = np.maximum(sizes[first[1:]] - sizes[first[:-1]], 1)
    h = ids * _PRIME
    h ^= h >> np.uint64(29)
    gram, n = h + text.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), 1
    for want in sorted(rules):
        while n < want:
            gram = gram[:-1] * np.uint64(0x9FB21C651E98DF25) + h[n:] if len(gram) > 1 else gram[:0]
            n += 1
        if want < 1 or not len(gram):
            continue
        at = np.flatnonzero(text[: len(gram)] == text[len(text) - len(gram) :])  # those within one text
        if not len(at):
            continue
        g = gram[at] ^ (gram[at] >> np.uint64(31))
        order = np.argsort(g)
        new = np.ones(len(g), bool)
        new[1:] = g[order][1:] != g[order][:-1]
        run = np.cumsum(new) - 1
        times = np.empty(len(g), np.int64)
        times[order] = np.bincount(run)[run]
        rule, limit = rules[want]
        if rule == "most_common":
            own = text[at]
            begin = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            most = np.maximum.reduceat(times, begin)
            size = np.where(times == np.repeat(most, np.diff(np.r_[begin, len(own)])), sizes[at + want] - sizes[at], 0)
            share = np.where(most > 1, np.maximum.reduceat(size, begin) * most, 0)
            ok[own[begin]] &= share / total[own[begin]] <= limit
        else:
            hit = np.zeros(len(text) + 1, np.int64)
            again = at[times > 1]
            np.add.at(hit, again, 1)
            np.add.at(hit, again + want, -1)
            covered = np.concatenate([[0], np.cumsum(np.where(np.cumsum(hit[:-1]) > 0, lengths, 0))])
            ok &= (covered[first[1:]] - covered[first[:-1]]) / total <= limit
    return ok
