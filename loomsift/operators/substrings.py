"""Cuts of `dedup.sequential` in its substring mode, as a distributed plan.

The rule goes through a shard in order, with a set of n-grams that grows. Only
an n-gram that several rows of a shard have can ever be found in that set, so
these are looked up first, in buckets of hashes over all tasks, and numbered
within their shard. What goes in order after that are positions and numbers, as
a stream of rows with one byte for each number: what a task holds is a batch and
these bytes, not a shard's texts or n-grams. Rows are sent between tasks as
packed arrays. Equal 64-bit hashes are taken as equal n-grams.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import words as wd
from ..session import checkpoints, release

#: Bytes of text for each bucket, and n-grams that a task packs at once.
BUCKET_BYTES, PACK = 8 << 20, 300_000


class WordIds(dict):
    """The hash of each word, for as many as fit a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 1 << 17:
            self.clear()
        self[word] = out = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return out


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


@lru_cache(maxsize=4)
def _factors(size: int) -> np.ndarray:
    rng = random.Random(11)
    return np.array([rng.getrandbits(64) for _ in range(size)], np.uint64)


def grams(words: np.ndarray, size: int, shard: int = 0) -> np.ndarray:
    """Hashes of all runs of `size` words: sums of products, which tell their order, mixed with the shard's hash."""
    out = np.full(len(words) - size + 1, shard & (1 << 64) - 1, np.uint64)
    for i, c in enumerate(_factors(size)):
        out += words[i : i + len(out)] * c
    return _mixed(out)


def _planes(a: np.ndarray) -> bytes:
    """Bytes of a column by significance, so that the high ones of small numbers compress."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def _unplanes(data: bytes | pa.Buffer, kind: type) -> np.ndarray:
    n = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(n, -1).T).view(kind).ravel()


def _firsts(counts: np.ndarray) -> np.ndarray:
    """Where each run begins."""
    return np.cumsum(counts, dtype=np.int64) - counts


def _steps(at: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions within runs as differences; the first of a run as it is."""
    out = np.diff(at, prepend=np.zeros(1, at.dtype))
    first = _firsts(counts)
    out[first] = at[first]
    return out


def _unsteps(steps: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = np.cumsum(steps.astype(np.int64))
    first = _firsts(counts)
    return total - np.repeat(total[first] - steps[first], counts)


def _slices(where: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, from, to) of the runs of equal values in a sorted array."""
    edges = np.flatnonzero(np.diff(where)) + 1
    edges = np.concatenate(([0], edges, [len(where)]))
    for a, z in zip(edges[:-1].tolist(), edges[1:].tolist()):
        yield int(where[a]), a, z


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where a run of rows with equal values begins."""
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _packed(df: DataFrame, text: str, size: int, buckets: int) -> DataFrame:
    """(bucket, rows, tags, counts, at, hashes): the n-grams of rows (_row, _tag), by buckets of hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, got, have = WordIds(), [], 0

        def flush() -> pa.RecordBatch:
            counts = np.array([len(h) for _, _, h in got])
            hashes = np.concatenate([h for _, _, h in got])
            of = np.repeat(np.arange(len(got)), counts)
            at = np.arange(len(hashes)) - np.repeat(_firsts(counts), counts)
            rows, tags = np.array([r for r, _, _ in got], np.int64), np.array([t for _, t, _ in got], np.int32)
            bucket = (hashes % np.uint64(buckets)).astype(np.uint32)
            order = np.argsort(bucket, kind="stable")
            out = []
            for b, a, z in _slices(bucket[order]):
                o = order[a:z]
                first = _runs(of[o])
                n = np.diff(first, append=len(o)).astype(np.uint32)
                steps = _steps(at[o].astype(np.uint32), n)
                d = of[o][first]
                out.append((b, rows[d].tobytes(), tags[d].tobytes(), _planes(n), _planes(steps), hashes[o].tobytes()))
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), *(pa.array(x, pa.binary()) for x in list(zip(*out))[1:])], names=["bucket", "rows", "tags", "counts", "at", "hashes"])

        for b in batches:
            for row, shard, t in zip(b.column("_row").to_pylist(), b.column("_shard").to_pylist(), b.column(text).to_pylist()):
                words = wd.uax29(t)
                if len(words) < size:
                    continue
                h = grams(np.fromiter(map(ids.__getitem__, words), np.uint64, len(words)), size, shard)
                got.append((row, np.int64(shard).astype(np.int32), h))
                have += len(h)
                if have >= PACK:
                    yield flush()
                    got, have = [], 0
        if got:
            yield flush()

    return df.select("_row", "_shard", text).mapInArrow(run, "bucket int, rows binary, tags binary, counts binary, at binary, hashes binary")


def _shared(key: tuple[pa.Scalar, ...], t: pa.Table, buckets: int) -> pa.Table:
    """(part, rows, counts, at, ids): the n-grams of a bucket that its shard has more than once in different rows, or in copies of a row, with numbers from 0 within bucket and shard; by parts of rows."""
    unpack = lambda name, kind: np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in t.column(name)])
    hashes = unpack("hashes", np.uint64)
    order = np.argsort(hashes)
    h = hashes[order]
    del hashes
    several = np.zeros(len(h), bool)
    several[1:] = h[1:] == h[:-1]
    several[:-1] |= several[1:]
    order, h = order[several], h[several]
    group = np.cumsum(np.concatenate((np.zeros(1, bool), h[1:] != h[:-1]))[: len(h)], dtype=np.int64)
    counts = [_unplanes(x.as_buffer(), np.uint32) for x in t.column("counts")]
    at = np.concatenate([_unsteps(_unplanes(x.as_buffer(), np.uint32), n).astype(np.uint32) for x, n in zip(t.column("at"), counts)])[order]
    n = np.concatenate(counts)
    run = np.repeat(np.arange(len(n), dtype=np.int32), n)[order]
    rows, tags = unpack("rows", np.int64), unpack("tags", np.int32)
    row = rows[run]
    # another row, or the same place of a row again
    by = np.lexsort((at, row, group))
    run, at, row, group = run[by], at[by], row[by], group[by]
    same = group[1:] == group[:-1]
    good = np.zeros(group[-1] + 1 if len(group) else 0, bool)
    good[group[1:][same & ((row[1:] != row[:-1]) | (at[1:] == at[:-1]))]] = True
    keep = good[group]
    run, at, row, group = run[keep], at[keep], row[keep], group[keep]
    names = ["part", "rows", "counts", "at", "ids"]
    kinds = [pa.int32(), *[pa.binary()] * 4]
    if not len(row):
        return pa.Table.from_arrays([pa.array([], k) for k in kinds], names=names)
    tag = tags[run]
    by = np.argsort(tag, kind="stable")
    g, s = group[by], tag[by]
    new = np.concatenate(([True], g[1:] != g[:-1]))
    number = np.cumsum(new) - 1
    edge = _runs(s)
    number -= np.repeat(number[edge], np.diff(edge, append=len(s)))
    ids = np.empty(len(g), np.uint64)
    ids[by] = number.astype(np.uint64) * np.uint64(buckets) + np.uint64(key[0].as_py())
    part = (row.view(np.uint64) % np.uint64(buckets)).astype(np.int32)
    order = np.lexsort((at, row, part))
    row, at, ids = row[order], at[order], ids[order]
    out = []
    for p, a, z in _slices(part[order]):
        first = _runs(row[a:z])
        n = np.diff(first, append=z - a).astype(np.uint32)
        out.append((p, row[a:z][first].tobytes(), _planes(n), _planes(_steps(at[a:z].astype(np.uint32), n)), _planes(ids[a:z])))
    return pa.Table.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names=names)


def _by_row(t: pa.Table) -> pa.Table:
    """(_row, copies, at, ids) of a part: the places of each row in order, with their numbers."""
    counts = [_unplanes(x, np.uint32) for x in t.column("counts").to_pylist()]
    at = np.concatenate([_unsteps(_unplanes(x, np.uint32), n) for x, n in zip(t.column("at").to_pylist(), counts)])
    ids = np.concatenate([_unplanes(x, np.uint64) for x in t.column("ids").to_pylist()])
    row = np.repeat(np.concatenate([np.frombuffer(x, np.int64) for x in t.column("rows").to_pylist()]), np.concatenate(counts))
    order = np.lexsort((at, row))
    row, at, ids = row[order], at[order], ids[order]
    place = _runs(row, at)
    copies = np.diff(place, append=len(row))
    row, at, ids = row[place], at[place], ids[place]
    first = _runs(row)
    ends = np.append(first, len(row))
    lists = lambda a, planes: pa.array([planes(a[x:y]) for x, y in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.binary())
    steps = _steps(at.astype(np.uint32), np.diff(ends))
    return pa.table({"_row": pa.array(row[first]), "copies": pa.array(copies[first].astype(np.int32)), "at": lists(steps, _planes), "ids": lists(ids, _planes)})


def _merged(at: np.ndarray, size: int) -> list[tuple[int, int]]:
    """The union of the intervals of `size` tokens that begin at sorted places; touching ones become one."""
    gap = np.flatnonzero(np.diff(at) > size)
    return list(zip(at[np.concatenate(([0], gap + 1))].tolist(), (at[np.concatenate((gap, [len(at) - 1]))] + size).tolist()))


def _in_order(batches: Iterator[pa.RecordBatch], size: int, threshold: float, least: int) -> Iterator[pa.RecordBatch]:
    """(_row, cuts): for each copy of a row the tokens to cut, going through sorted shards."""
    from . import dedup as dd

    now, seen = ..., np.zeros(0, bool)
    for b in batches:
        found, cuts = [], []
        for tag, row, copies, at, ids in zip(*(b.column(x).to_pylist() for x in ("_shard", "_row", "copies", "at", "ids"))):
            at, ids = np.cumsum(_unplanes(at, np.uint32).astype(np.int64)), _unplanes(ids, np.uint64).astype(np.int64)
            if tag != now:
                now, seen = tag, np.zeros(0, bool)
            top = int(ids.max())
            if top >= len(seen):
                seen = np.concatenate((seen, np.zeros(max(top + 1 - len(seen), len(seen)), bool)))
            mine = []
            for _ in range(copies):
                hit = at[seen[ids]]
                spans = _merged(hit, size) if len(hit) else []
                if threshold < 1:
                    spans = dd.bridge_spans(spans, threshold)
                cut = [(a, z) for a, z in spans if z - a >= least]
                mine.append([x for s in cut for x in s])
                if cut:
                    begin, end = np.array(cut).T
                    k = np.searchsorted(end, at, "right")
                    seen[ids[np.append(begin, 1 << 62)[k] >= at + size]] = True
                else:
                    seen[ids] = True
            if any(mine):
                found.append(row)
                cuts.append(mine)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(cuts, pa.list_(pa.list_(pa.int32())))], names=["_row", "cuts"])


def _spans(texts: pa.Array, cuts: pa.Array) -> pa.Array:
    """(out, spans) of texts with cuts in tokens: what is left, and the byte offsets of the cuts. Null where nothing is cut."""
    boundary, _ = wd._boundary()
    out = []
    for t, cut in zip(texts.to_pylist(), cuts.to_pylist()):
        if not cut:
            out.append(None)
            continue
        if wd._LATIN.fullmatch(t):
            where = [m.span() for m in wd._LATIN_WORDS.finditer(t)]
        else:
            where, at = [], 0
            for piece in boundary.split(t):
                if piece.strip():
                    where.append((at, at + len(piece)))
                at += len(piece)
        chars = [(where[a][0], where[z - 1][1]) for a, z in zip(cut[::2], cut[1::2])]
        left = "".join(t[a:z] for a, z in zip([0] + [z for _, z in chars], [a for a, _ in chars] + [len(t)]))
        spans, byte, last = [], 0, 0
        for a, z in chars:
            byte += len(t[last:a].encode())
            begin = byte
            byte += len(t[a:z].encode())
            spans.append({"s": begin, "e": byte})
            last = z
        out.append({"out": left, "spans": spans})
    return pa.array(out, pa.struct([("out", pa.string()), ("spans", pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())])))]))


def cuts(df: DataFrame, key: str, text: str, size: int, threshold: float, least: int) -> DataFrame:
    """(_row, cuts) of rows (_row, _shard, key, text) in which something is cut."""
    octets = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = max(1, octets // BUCKET_BYTES)
    packed = _packed(df, text, size, buckets)
    shared = packed.groupBy("bucket").applyInArrow(lambda k, t: _shared(k, t, buckets), "part int, rows binary, counts binary, at binary, ids binary")
    by_row = shared.groupBy("part").applyInArrow(_by_row, "_row long, copies int, at binary, ids binary")
    places = df.select("_row", "_shard", key).dropDuplicates(["_row"])
    ordered = by_row.join(places, "_row").repartition("_shard").sortWithinPartitions("_shard", F.col(key).asc_nulls_last(), "_row")
    return ordered.select("_row", "_shard", "copies", "at", "ids").mapInArrow(lambda b: _in_order(b, size, threshold, least), "_row long, cuts array<array<int>>")


def dedup(df: DataFrame, shard: str, key: str, text: str, size: int, threshold: float, least: int, annotate: bool) -> DataFrame:
    """`dedup.sequential` in its substring mode. Equal rows (shard, key and text) follow each other."""
    ids = lambda *names: F.xxhash64(*[x for n in names for x in (F.col(n).isNull(), F.col(n))])
    checkpoints(df.sparkSession)
    rows = df.where(tx.filled(F.col(text))).select(F.col(key), F.col(text), ids(shard).alias("_shard"), ids(shard, key, text).alias("_row"))
    found = cuts(rows, key, text, size, threshold, least).checkpoint()
    release(df.sparkSession)  # n-grams leave the disk before texts are shuffled
    copy = F.row_number().over(Window.partitionBy("_row").orderBy(F.lit(1)))
    joined = rows.withColumn("_copy", copy).join(found, "_row", "left").withColumn("_cut", F.get("cuts", F.col("_copy") - 1))
    told = joined.withColumn("_told", F.arrow_udf(_spans, "out string, spans array<struct<s:bigint,e:bigint>>")(F.when(F.size("_cut") > 0, F.col(text)), F.col("_cut")))
    left = F.col(text) if annotate else F.coalesce("_told.out", text)
    none = F.array().cast("array<struct<s:bigint,e:bigint>>")
    out = told.select(F.col(key), left.alias(text), F.coalesce("_told.spans", none).alias("spans"))
    return out if annotate else out.where(tx.filled(F.col(text)))
