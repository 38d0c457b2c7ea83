"""Vectorised tokenising and hashing of whole Arrow text columns.

A column of strings is one run of UTF-8 bytes and an array of offsets. Token
boundaries come from a 256-entry table of byte classes, and 64-bit token
hashes from differences of a prefix polynomial, so that no Python code runs
per token or per character. Nulls count as empty texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SPACE, WORD, PUNCT = 0, 1, 2
PIECE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

#: White space ends a token; everything else is part of one.
BY_SPACE = np.full(256, WORD, np.uint8)
BY_SPACE[[9, 10, 11, 12, 13, 32]] = SPACE
#: As BY_SPACE, and runs of ASCII punctuation are tokens of their own.
BY_CLASS = BY_SPACE.copy()
BY_CLASS[[c for c in range(33, 127) if not chr(c).isalnum()]] = PUNCT
#: ASCII lower case.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        out = []
        for base in (_BASE, _INVERSE):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, and n + 1 offsets into them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have about limit bytes at most (or are one row)."""
    _, off = utf8(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def spans(data: np.ndarray, off: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of tokens, and for each text the index of its first token (n + 1 entries)."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    kind = classes[data]
    change = np.empty(len(data) + 1, bool)
    change[0] = change[-1] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:-1])
    change[off] = True
    edges = np.flatnonzero(change)
    real = kind[edges[:-1]] != SPACE
    starts, ends = edges[:-1][real], edges[1:][real]
    return starts, ends, np.searchsorted(starts, off)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hashes of the byte spans; equal bytes give equal hashes wherever they stand."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = 1 << max(21, int(len(data)).bit_length())
    power, inverse = _powers(size)
    values = (LOWER[data] if lower else data).astype(np.uint64)
    values += np.uint64(1)
    values *= power[: len(data)]
    prefix = np.empty(len(data) + 1, np.uint64)
    prefix[0] = 0
    np.cumsum(values, out=prefix[1:])
    h = (prefix[ends] - prefix[starts]) * inverse[starts]
    h += (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mix(h)


def ngrams(h: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams that lie within one text, and the index of each text's first one (as `first`)."""
    counts = np.diff(first)
    out = np.maximum(counts - n + 1, 0)
    begin = np.zeros(len(first), np.int64)
    np.cumsum(out, out=begin[1:])
    if not begin[-1]:
        return np.zeros(0, np.uint64), begin
    total = h[: len(h) - n + 1].copy() if n > 1 else h.copy()
    for k in range(1, n):
        total *= np.uint64(0x9FB21C651E98DF25)
        total += h[k : len(h) - n + 1 + k]
    inside = np.repeat(np.arange(len(counts)), counts)[: len(total)]
    keep = inside == np.repeat(np.arange(len(counts)), counts)[n - 1 :] if n > 1 else slice(None)
    return mix(total[keep] ^ np.uint64(n * 0x2545F4914F6CDD1D & (1 << 64) - 1)), begin


def text_hashes(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each whole text."""
    return hashes(data, off[:-1], off[1:], lower=False) if len(off) > 1 else np.zeros(0, np.uint64)
