"""Banded alignment of word sequences: whether an edit distance stays within a bound.

The band starts narrow and widens until the distance fits into it or the
bound is passed, so that near copies cost their length times their few edits.
Pairs of like length are aligned together, one matrix row at a time.
"""

from __future__ import annotations

import numpy as np

_FAR = np.int32(1 << 29)


def _trim(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sequences without their common beginning and end."""
    n = min(len(a), len(b))
    differ = a[:n] != b[:n]
    at = int(differ.argmax()) if differ.any() else n
    a, b = a[at:], b[at:]
    n = min(len(a), len(b))
    if n:
        differ = a[len(a) - n :][::-1] != b[len(b) - n :][::-1]
        at = int(differ.argmax()) if differ.any() else n
        a, b = a[: len(a) - at], b[: len(b) - at]
    return a, b


def _bag_bound(a: np.ndarray, b: np.ndarray) -> int:
    """No fewer edits than this: words that one side has more often than the other."""
    both = np.concatenate([a, b])
    order = np.argsort(both, kind="stable")
    sign = np.where(order < len(a), 1, -1)
    s = both[order]
    begin = np.flatnonzero(np.r_[True, s[1:] != s[:-1]]) if len(s) else np.zeros(0, int)
    net = np.add.reduceat(sign, begin) if len(begin) else np.zeros(0, int)
    return int(max(net[net > 0].sum(), -net[net < 0].sum()))


def banded(pairs: list[tuple[np.ndarray, np.ndarray]], k: int) -> np.ndarray:
    """Edit distances of the pairs, right where they are k at most, and larger than k elsewhere."""
    la, lb = np.array([len(a) for a, _ in pairs]), np.array([len(b) for _, b in pairs])
    width, rows = 2 * k + 1, int(la.max())
    a_all = np.zeros((rows, len(pairs), 1), np.int64)
    b_all = np.full((len(pairs), max(int(lb.max()), rows) + 2 * k + 2), -1, np.int64)
    for p, (a, b) in enumerate(pairs):
        a_all[: len(a), p, 0] = a
        b_all[p, k : k + len(b)] = b
    step = np.arange(width, dtype=np.int32)
    row = np.full((len(pairs), width + 1), _FAR, np.int32)
    row[:, k:width] = np.arange(k + 1)
    out = np.full(len(pairs), _FAR, np.int64)
    fits = np.abs(lb - la) <= k
    ends: dict[int, list[int]] = {}
    for p in np.flatnonzero(fits):
        ends.setdefault(int(la[p]), []).append(int(p))
    for i in range(rows + 1):
        if i:
            new = (b_all[:, i - 1 : i - 1 + width] != a_all[i - 1]).astype(np.int32)
            new += row[:, :width]
            np.minimum(new, row[:, 1:] + 1, out=new)
            new -= step
            np.minimum.accumulate(new, axis=1, out=new)
            new += step
            row[:, :width] = new
            if not i % 64 and new.min() > k:
                break
        for p in ends.get(i, ()):
            out[p] = row[p, lb[p] - la[p] + k]
    return out


def within(pairs: list[tuple[np.ndarray, np.ndarray]], similarity: float) -> np.ndarray:
    """Whether 1 - edits / longer length reaches the given similarity; two empty sequences don't count as alike."""
    ok = np.zeros(len(pairs), bool)
    todo: list[tuple[int, np.ndarray, np.ndarray, int]] = []
    for n, (a, b) in enumerate(pairs):
        bound = int((1 - similarity) * max(len(a), len(b)) + 1e-9)
        if not len(a) or not len(b) or abs(len(a) - len(b)) > bound:
            continue
        a, b = _trim(a, b)
        if max(len(a), len(b)) <= bound:
            ok[n] = True
        elif len(a) and len(b) and _bag_bound(a, b) <= bound:
            todo.append((n, a.astype(np.int64), b.astype(np.int64), bound))
    k = 8
    while todo:
        todo.sort(key=lambda x: len(x[1]))
        again, at = [], 0
        while at < len(todo):
            take = max(1, min(256, 40_000 // (2 * k + 1)))
            part = todo[at : at + take]
            limit = max(len(part[0][1]) * 1.3, len(part[0][1]) + 64)
            part = [x for x in part if len(x[1]) <= limit]
            at += len(part)
            for x, d in zip(part, banded([(x[1], x[2]) for x in part], k)):
                if d <= min(k, x[3]):
                    ok[x[0]] = True
                elif k < x[3]:
                    again.append(x)
        todo, k = again, k * 3
    return ok
