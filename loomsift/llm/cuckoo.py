"""A cuckoo filter over 64-bit hashes whose bulk operations are vectorised."""

from __future__ import annotations

import numpy as np

from .tokens import mix

SLOTS = 4
_MAGIC = b"LSCF1"


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; each key has two buckets. Deletions are exact for keys that were inserted."""

    def __init__(self, capacity: int):
        self.buckets = 1 << max(2, int(np.ceil(capacity / (SLOTS * 0.85))) - 1).bit_length()
        self.table = np.zeros((self.buckets, SLOTS), np.uint16)
        self.count = 0

    def _places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        fp = (h >> np.uint64(48)).astype(np.uint16)
        fp[fp == 0] = 1
        return fp, (h & np.uint64(self.buckets - 1)).astype(np.int64)

    def _other(self, fp: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        return bucket ^ (mix(fp.astype(np.uint64)) & np.uint64(self.buckets - 1)).astype(np.int64)

    def contains(self, h: np.ndarray) -> np.ndarray:
        fp, i = self._places(h)
        return (self.table[i] == fp[:, None]).any(1) | (self.table[self._other(fp, i)] == fp[:, None]).any(1)

    def _place(self, fp: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Puts what fits into bucket i; returns which did."""
        order = np.argsort(i, kind="stable")
        b = i[order]
        begin = np.r_[True, b[1:] != b[:-1]]
        rank = np.arange(len(b)) - np.maximum.accumulate(np.where(begin, np.arange(len(b)), 0))
        empty = self.table[b] == 0
        fits = rank < empty.sum(1)
        # the rank-th empty slot of the bucket
        slot = (np.cumsum(empty, 1) == (rank + 1)[:, None]).argmax(1)
        self.table[b[fits], slot[fits]] = fp[order][fits]
        done = np.zeros(len(i), bool)
        done[order] = fits
        return done

    def insert(self, h: np.ndarray, rounds: int = 400) -> bool:
        """Adds the keys (once per occurrence); False if they don't fit, and the filter is then to be rebuilt larger."""
        if not len(h):
            return True
        self.count += len(h)
        fp, i = self._places(h)
        rng = np.random.default_rng(len(h))
        left = ~self._place(fp, i)
        fp, i = fp[left], self._other(fp[left], i[left])
        for _ in range(rounds):
            if not len(fp):
                return True
            left = ~self._place(fp, i)
            fp, i = fp[left], i[left]
            # one newcomer for each full bucket throws out a resident, who moves to the other bucket
            _, first = np.unique(i, return_index=True)
            slot = rng.integers(0, SLOTS, len(first))
            fp[first], self.table[i[first], slot] = self.table[i[first], slot].copy(), fp[first].copy()
            i[first] = self._other(fp[first], i[first])
        return not len(fp)

    def delete(self, h: np.ndarray) -> None:
        """Takes out one fingerprint for each key; keys that are absent change nothing."""
        fp, i = self._places(h)
        left = self._take(fp, i)
        self._take(fp[left], self._other(fp[left], i[left]))

    def _take(self, fp: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Empties a slot of each key's bucket that holds its fingerprint; returns which keys found none."""
        missed = np.zeros(len(fp), bool)
        todo = np.arange(len(fp))
        while len(todo):
            _, first = np.unique(bucket[todo], return_index=True)
            now = todo[first]
            match = self.table[bucket[now]] == fp[now][:, None]
            hit = match.any(1)
            self.table[bucket[now][hit], match.argmax(1)[hit]] = 0
            self.count -= int(hit.sum())
            missed[now[~hit]] = True
            todo = np.delete(todo, first)
        return missed

    @classmethod
    def of(cls, h: np.ndarray, room: int = 0) -> CuckooFilter:
        """A filter that holds h and has room for more keys."""
        capacity = max(64, len(h) + room)
        while not (made := cls(capacity)).insert(h):
            capacity *= 2
        return made

    def to_bytes(self) -> bytes:
        return _MAGIC + np.array([self.buckets, self.count], "<i8").tobytes() + self.table.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> CuckooFilter:
        if raw[: len(_MAGIC)] != _MAGIC:
            raise ValueError("not a cuckoo filter")
        made = cls.__new__(cls)
        made.buckets, made.count = (int(x) for x in np.frombuffer(raw, "<i8", 2, len(_MAGIC)))
        made.table = np.frombuffer(raw, np.uint16, offset=len(_MAGIC) + 16).reshape(made.buckets, SLOTS).copy()
        return made
