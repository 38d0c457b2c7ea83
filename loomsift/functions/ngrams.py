"""Word n-grams of whole Arrow columns: cut, hashed, counted and looked up as arrays, so that no Python code runs per word.

A chunk is some TOKENS words of texts. Its distinct n-grams are 64-bit hashes in
order, cut by their first bits into slices (key: the order of the n-gram and
these bits). All that is shuffled are slices, of some 6 bytes an n-gram.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words of a chunk at least, if there are so many; texts aren't cut.
TOKENS = 1 << 20
#: Bytes of text whose n-grams of one order share a key, at most.
KEY_BYTES = 16 << 20
_PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_A, _B, _C, _D, _E = (np.uint64(x) for x in (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(size, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def _mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def word_hashes(words: pa.StringArray) -> np.ndarray:
    """A 64-bit hash of each word, by differences of a prefix polynomial over the bytes."""
    n = len(words)
    at = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    out = np.empty(n, np.uint64)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + _PIECE, "right")) - 1)
        size = int(at[j] - at[i])
        up, down = _powers(max(_PIECE, 1 << max(size - 1, 1).bit_length()))
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum((data[at[i] : at[j]].astype(np.uint64) + np.uint64(1)) * up[:size], out=sums[1:])
        k = at[i : j + 1] - at[i]
        out[i:j] = (sums[k[1:]] - sums[k[:-1]]) * down[np.minimum(k[:-1], len(down) - 1)]
        i = j
    return _mix(out)


START, END = word_hashes(pa.array(["<s>", "</s>"]))


def cut(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, starts, sizes): hashes of the words of all lines, with two marks before and one behind those of a line; where lines start; words and end marks of each text. Words are those of str.split(), lines without any don't count."""
    lines = pc.split_pattern(pc.fill_null(texts.cast(pa.string()), ""), "\n")
    text = np.repeat(np.arange(len(texts)), np.diff(lines.offsets.to_numpy()))
    words = pc.utf8_split_whitespace(lines.flatten())
    flat = words.flatten()
    some = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    n = np.diff(np.concatenate(([0], np.cumsum(some)))[words.offsets.to_numpy()])
    text, n = text[n > 0], n[n > 0]
    starts = np.cumsum(n + 3) - (n + 3)
    h = np.full(int((n + 3).sum()), START, np.uint64)
    h[starts + n + 2] = END
    h[np.arange(int(n.sum())) + np.repeat(2 + 3 * np.arange(len(n)), n)] = word_hashes(flat)[some]
    return h, starts, np.bincount(text, n + 1, len(texts)).astype(np.int64)


def join(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same of several columns, one after the other."""
    before = np.cumsum([0, *(len(h) for h, _, _ in parts)])
    return np.concatenate([h for h, _, _ in parts]), np.concatenate([s + b for (_, s, _), b in zip(parts, before)]), np.concatenate([n for _, _, n in parts])


def ends(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where n-grams end: at all words and marks but the first two of a line."""
    keep = np.ones(len(h), bool)
    keep[starts] = keep[starts + 1] = False
    return np.flatnonzero(keep)


def grams(h: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
    """Hashes of the n-grams of 1, 2 and 3 words that end at these places."""
    c = h[at]
    yield c
    b = h[at - 1]
    yield _mix(b * _A + c * _B)
    yield _mix(h[at - 2] * _C + b * _D + c * _E)


def asked(h: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
    """The same, and at the end of those of 1 and 2 words the marks before the first word of a line, as what comes before it."""
    for k, g in enumerate(grams(np.append(h, [START, START]), np.append(at, len(h) + 1))):
        yield g if k < 2 else g[:-1]


def distinct(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """g's values in order, and how often each is there."""
    s = np.sort(g)
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(s)), bool), s[1:] != s[:-1])))
    return s[first], np.diff(first, append=len(s))


def ranks(g: np.ndarray) -> tuple[np.ndarray, int]:
    """For each of g, the place of its value among the distinct ones in order; how many there are."""
    low = np.uint64((1 << len(g).bit_length()) - 1)
    # numbers sort faster than they argsort: the first bits of the hash, then the place
    order = g & ~low
    order |= np.arange(len(g), dtype=np.uint64)
    order.sort()
    order &= low
    order = order.view(np.int64)
    s = g[order]
    if (s[1:] < s[:-1]).any():
        order = np.argsort(g)
        s = g[order]
    new = np.concatenate((np.zeros(min(1, len(s)), bool), s[1:] != s[:-1]))
    out = np.empty(len(g), np.int64)
    out[order] = rank = np.cumsum(new, dtype=np.int64)
    return out, int(rank[-1]) + 1 if len(g) else 0


def slices(g: np.ndarray, bits: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(first bits, from, to, bytes) of distinct hashes in order: the first one, then the steps between them in as many bytes as the largest takes."""
    top = (g >> np.uint64(64 - bits)).astype(np.int64)
    bounds = np.concatenate(([0], np.flatnonzero(top[1:] != top[:-1]) + 1, [len(g)])).tolist() if len(g) else [0]
    steps = np.diff(g)
    for i, j in zip(bounds, bounds[1:]):
        d = steps[i : j - 1]
        wide = (int(d.max()).bit_length() + 7) // 8 if len(d) else 1
        yield int(top[i]), i, j, bytes([wide]) + g[i : i + 1].tobytes() + d.view(np.uint8).reshape(-1, 8)[:, :wide].tobytes()


def hashes(data: bytes) -> np.ndarray:
    """The hashes of a slice."""
    steps = np.frombuffer(data, np.uint8, offset=9).reshape(-1, data[0])
    out = np.zeros((len(steps) + 1, 8), np.uint8)
    out[0] = np.frombuffer(data, np.uint8, 8, 1)
    out[1:, : data[0]] = steps
    return np.cumsum(out.view(np.uint64).ravel(), dtype=np.uint64)


def small(n: np.ndarray) -> bytes:
    """Whole numbers from 0 in as few bytes as the largest takes."""
    n = n.astype(np.min_scalar_type(int(n.max())))
    return bytes([n.itemsize]) + n.tobytes()


def numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"u{data[0]}", offset=1).astype(np.int64)


def pack(arrays: list[np.ndarray]) -> bytes:
    """Arrays of 64-bit numbers as compressed bytes; byte by byte of the numbers, since most are small."""
    raw = np.array([len(arrays), *map(len, arrays)], np.int64).tobytes() + b"".join(a.view(np.uint8).reshape(-1, 8).T.tobytes() for a in arrays)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpack(data: bytes) -> list[np.ndarray]:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
    count = int(np.frombuffer(raw, np.int64, 1)[0])
    out, at = [], 8 * (count + 1)
    for n in np.frombuffer(raw, np.int64, count, 8).tolist():
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, 8 * n, at).reshape(8, n).T).view(np.uint64).ravel())
        at += 8 * n
    return out
