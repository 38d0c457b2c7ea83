"""Approximate nearest neighbours by a hash-prefix forest.

Each tree gives a vector a long string of symbols. A symbol is the
cross-polytope hash of a random rotation, or of a quarter of one: the axis that
the vector is nearest to, and the side. The first two symbols are of whole
rotations, the next ones of quarters of further rotations; in all some 50 to 62
bits. A tree is its strings in sorted order, where the vectors that share a
prefix with a query are one run.

Every vector is indexed; the queries are those that are asked for. A query
descends in each tree to where its string would stand: binary searches give
the length of every run around it, for each length of prefix. It begins at the
longest prefix at which the runs of all trees together hold `enough` vectors,
and ascends in all trees at once, a symbol at a time, until it is done. When
that is follows from probability: with p(s) the chance that two vectors of
similarity s share a prefix, a neighbour at s was met with probability
1 - (1 - p(s)) ** trees. A query stops when this, averaged over its neighbours
so far, reaches `sure`. Queries that ascend past the first symbol are compared
with every vector: nothing is cut off.

Strings and ids are what is shuffled; candidates are lists of ids for each
block of vectors, and a block and its candidates meet in one task. Equal
vectors are one node of the index, with the k + 1 least of their ids (more
can't be among k neighbours), so that a vector that a third of the rows repeat
costs no more than another. Vectors that are close but not equal share ever
longer prefixes, and are told apart there.

Defined results:
* Similarity is the cosine. A null vector or one with a null, NaN or infinite
  entry, a vector of zeros, one whose length isn't the most common, and a null
  id take no part. Rows that repeat an id are one (the least vector).
* A vector isn't its own neighbour; equal vectors of other ids are. Ties (of
  similarities to 6 places) go to the lesser id. With fewer than k others, there
  are fewer neighbours. An empty table gives no rows.
* Ids may have any type that can be ordered; other columns aren't looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import ExitStack
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .state import cut, small_batches, table
from .tokens import mix

TREES, SURE, BLOCK, CHUNK = 40, 0.94, 8192, 2048
_FOUND = "node long, near array<long>, sim array<float>"
_WHOLE = ("tinyint", "smallint", "int", "bigint")


@dataclass(frozen=True)
class Shape:
    """How strings are made: for each symbol the rotation, the slice of it, and its bits."""

    dim: int
    trees: int
    symbols: tuple[tuple[int, int, int, int], ...]

    @classmethod
    def of(cls, dim: int, trees: int) -> Shape:
        width = min(dim, 64)
        cell = max(1, width // 4)
        parts = [(0, 0, width), (1, 0, width)] + [(r, at, at + cell) for r in (2, 3) for at in range(0, width - cell + 1, cell)][:8]
        out, bits = [], 0
        for r, a, b in parts:
            own = max(1, math.ceil(math.log2(2 * (b - a))))
            if bits + own <= 62:
                out.append((r, a, b, own))
                bits += own
        return cls(dim, trees, tuple(out))

    @property
    def ends(self) -> list[int]:
        """Bits of the prefixes of 0, 1, ... symbols."""
        return [0, *np.cumsum([s[3] for s in self.symbols]).tolist()]

    def spread(self, length: int) -> int:
        """How many prefixes of so many symbols there may be."""
        return math.prod(2 * (b - a) for _, a, b, _ in self.symbols[:length])


@lru_cache(maxsize=2)
def rotations(dim: int, trees: int, seed: int = 5) -> np.ndarray:
    """Four sets of orthonormal columns for each tree."""
    rng = np.random.default_rng(seed)
    return np.stack([[np.linalg.qr(rng.standard_normal((dim, min(dim, 64))))[0] for _ in range(4)] for _ in range(trees)]).astype(np.float32)


def _symbol(y: np.ndarray) -> np.ndarray:
    axis = np.abs(y).argmax(1)
    return axis * 2 + (y[np.arange(len(y)), axis] > 0)


def strings(x: np.ndarray, shape: Shape) -> np.ndarray:
    """The strings of all trees (n x trees), the first symbol in the highest bits."""
    out = np.zeros((len(x), shape.trees), np.int64)
    for t, of_tree in enumerate(rotations(shape.dim, shape.trees)):
        code, last, y = np.zeros(len(x), np.int64), -1, None
        for r, a, b, bits in shape.symbols:
            if r != last:
                y, last = x @ of_tree[r], r
            code = (code << bits) | _symbol(y[:, a:b])
        out[:, t] = code
    return out


def chances(shape: Shape, samples: int = 4000, seed: int = 6) -> np.ndarray:
    """For prefixes of 0, 1, ... symbols and similarities 0, 0.01, ... 1 the probability that some tree shares the prefix; by simulation of each kind of symbol."""
    rng = np.random.default_rng(seed)
    x, z = rng.standard_normal((2, samples, shape.dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)
    kinds = {}
    for m in {b - a for _, a, b, _ in shape.symbols}:
        one = _symbol(x[:, :m])
        kinds[m] = np.maximum.accumulate([(_symbol((s * x + math.sqrt(max(0, 1 - s * s)) * z)[:, :m]) == one).mean() for s in np.arange(101) / 100])
    each = np.cumprod([np.ones(101), *[kinds[b - a] for _, a, b, _ in shape.symbols]], axis=0)
    return 1 - (1 - each) ** shape.trees


def _unpack(raw: list[bytes], kind: str = "<f4") -> np.ndarray:
    return np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1)


def _group(prefix: np.ndarray, tree: int) -> np.ndarray:
    """A number for each tree's prefix; should two have the same, there are more candidates and no fewer."""
    return mix(prefix.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(tree)).view(np.int64)


def _routed(shape: Shape, lengths: list[int], query: bool):
    """A row for each tree (and length of prefix, for members): group, node, string; queries have a row each at the length in `length`."""
    total = shape.ends[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = _unpack(batch.column("codes").to_pylist(), "<i8")
            for t in range(shape.trees):
                code = np.ascontiguousarray(codes[:, t])
                for n in lengths:
                    g = pa.array(_group(code >> (total - shape.ends[n]), t))
                    got = pa.RecordBatch.from_arrays([g, batch.column("node"), pa.array(code), *([batch.column("level")] if query else [])], names=["g", "node", "code", *(["level"] if query else [])])
                    yield got.filter(pa.array(batch.column("length").to_numpy() == n)) if query else got

    return run


def _runs(shape: Shape, least: int):
    """For each query how many vectors share its prefixes of `least` and more symbols, over the trees of a partition. Queries come first."""
    ends, total = shape.ends, shape.ends[-1]
    low = total - ends[least]
    levels = range(least, len(ends))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, ready = [], None
        for batch in batches:
            q = batch.column("query").to_numpy(zero_copy_only=False)
            g, node, code = (batch.column(c).to_numpy() for c in ("g", "node", "code"))
            if q.any():
                asked.append((g[q], node[q], code[q]))
            if not q.all() and asked:
                if ready is None:
                    qg, qn, qc = (np.concatenate(x) for x in zip(*asked))
                    names, own = np.unique(qg, return_inverse=True)
                    where = (own.astype(np.int64) << low) | (qc & ((1 << low) - 1))
                    ready = np.zeros((len(qn), len(levels)), np.int64)
                g, code = g[~q], code[~q]
                at = np.minimum(np.searchsorted(names, g), len(names) - 1)
                hit = names[at] == g
                run_of = np.sort((at[hit].astype(np.int64) << low) | (code[hit] & ((1 << low) - 1)))
                for j, s in enumerate(levels):
                    rest = total - ends[s]
                    begin = (where >> rest) << rest
                    ready[:, j] += np.searchsorted(run_of, begin + (1 << rest)) - np.searchsorted(run_of, begin)
        if ready is not None:
            nodes, back = np.unique(qn, return_inverse=True)
            sums = np.zeros((len(nodes), len(levels)), np.int64)
            np.add.at(sums, back, ready)
            for at in range(0, len(nodes), 1 << 16):
                part = sums[at : at + (1 << 16)]
                yield pa.record_batch({"node": pa.array(nodes[at : at + (1 << 16)]), **{f"c{s}": pa.array(part[:, j]) for j, s in enumerate(levels)}})

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, node, members): pairs (block, node, member) as lists."""
    held: list[pa.RecordBatch] = []

    def flush() -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        block, node, member = (t.column(c).to_numpy() for c in ("block", "node", "member"))
        order = np.lexsort((member, node, block))
        block, node, member = block[order], node[order], member[order]
        new = np.ones(len(node), bool)
        new[1:] = (block[1:] != block[:-1]) | (node[1:] != node[:-1])
        fresh = new.copy()
        fresh[1:] |= member[1:] != member[:-1]
        block, node, member, new = block[fresh], node[fresh], member[fresh], new[fresh]
        first = np.flatnonzero(new)
        return pa.record_batch({"block": pa.array(block[first]), "node": pa.array(node[first]), "members": pa.ListArray.from_arrays(pa.array(np.r_[first, len(node)].astype(np.int32)), pa.array(member))})

    for b in batches:
        if b.num_rows:
            held.append(b)
        if sum(x.num_rows for x in held) > 2_000_000:
            yield flush()
            held = []
    if held:
        yield flush()


def _best(ids: np.ndarray, near: np.ndarray, sim: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k most similar distinct neighbours of each id, in order."""
    order = np.lexsort((near, -sim, ids))
    ids, near, sim = ids[order], near[order], sim[order]
    if len(ids):
        # the same neighbour has the same similarity up to rounding, so it is looked for among all of the id's
        pair = np.lexsort((np.arange(len(ids)), near, ids))
        again = np.zeros(len(ids), bool)
        again[pair[1:]] = (ids[pair[1:]] == ids[pair[:-1]]) & (near[pair[1:]] == near[pair[:-1]])
        ids, near, sim = ids[~again], near[~again], sim[~again]
        begin = np.r_[True, ids[1:] != ids[:-1]]
        rank = np.arange(len(ids)) - np.maximum.accumulate(np.where(begin, np.arange(len(ids)), 0))
        ids, near, sim = ids[rank < k], near[rank < k], sim[rank < k]
    return ids, near, sim


def _lists(ids: np.ndarray, near: np.ndarray, sim: np.ndarray) -> pa.RecordBatch:
    first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]]) if len(ids) else np.zeros(0, int)
    off = pa.array(np.r_[first, len(ids)].astype(np.int32))
    return pa.RecordBatch.from_arrays([pa.array(ids[first], pa.int64()), pa.ListArray.from_arrays(off, pa.array(near, pa.int64())), pa.ListArray.from_arrays(off, pa.array(sim.astype(np.float32)))], names=["node", "near", "sim"])


def _compared(k: int):
    """The best of each query's candidates in one block; all of the block's vectors are candidates where `members` is null."""

    def run(_: tuple[pa.Scalar, ...], candidates: pa.Table, vectors: pa.Table) -> pa.Table:
        empty = _lists(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32))
        is_query = vectors.column("query").to_numpy().astype(bool)
        nodes = vectors.column("node").to_numpy()
        x = _unpack([v for c in vectors.column("vec").chunks for v in c.to_pylist()]) if len(nodes) else np.zeros((0, 1), np.float32)
        there, asked = np.flatnonzero(~is_query), np.flatnonzero(is_query)
        there, asked = there[np.argsort(nodes[there], kind="stable")], asked[np.argsort(nodes[asked], kind="stable")]
        ids, names = nodes[there], nodes[asked]
        if not len(ids) or not len(names) or not candidates.num_rows:
            return pa.Table.from_batches([empty])
        members = candidates.column("members").combine_chunks()
        row = np.searchsorted(names, candidates.column("node").to_numpy())
        whole = members.is_null().to_numpy(zero_copy_only=False)
        lengths = members.value_lengths().fill_null(0).to_numpy()
        q = np.repeat(row, lengths)
        m = np.searchsorted(ids, members.flatten().to_numpy())
        order = np.argsort(q, kind="stable")
        q, m = q[order], m[order]
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32))]
        everything = np.zeros(len(names), bool)
        everything[row[whole]] = True
        size = max(1, (1 << 21) // len(ids))
        for at in range(0, len(names), size):
            a, b = np.searchsorted(q, [at, at + size])
            part = asked[at : at + size]
            if (b - a) * 16 > len(part) * len(ids) or everything[at : at + size].any():
                s = np.round(np.minimum(x[part] @ x[there].T, 1), 6)
                open_ = np.repeat(everything[at : at + size, None], len(ids), 1)
                open_[q[a:b] - at, m[a:b]] = True
                open_ &= names[at : at + size, None] != ids
                s[~open_] = -np.inf
                if len(ids) > k:
                    floor = -np.partition(-s, k - 1, axis=1)[:, k - 1]
                    i, j = np.nonzero((s >= floor[:, None]) & open_)
                else:
                    i, j = np.nonzero(open_)
                out.append(_best(names[at + i], ids[j], s[i, j], k))
            else:
                for c in range(a, b, 1 << 18):
                    i, j = q[c : min(b, c + (1 << 18))], m[c : min(b, c + (1 << 18))]
                    s = np.round(np.minimum(np.einsum("ij,ij->i", x[asked[i]], x[there[j]]), 1), 6)
                    ok = names[i] != ids[j]
                    out.append(_best(names[i[ok]], ids[j[ok]], s[ok], k))
        return pa.Table.from_batches([_lists(*_best(*[np.concatenate(c) for c in zip(*out)], k))])

    return run


def _merge(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)]
        for b in batches:
            ids = np.repeat(b.column("node").to_numpy(), b.column("near").value_lengths().to_numpy())
            new = (ids, b.column("near").flatten().to_numpy(), b.column("sim").flatten().to_numpy())
            kept = list(_best(*[np.concatenate(c) for c in zip(kept, new)], k))
        if len(kept[0]):
            yield _lists(*kept)

    return run


def _unsure(chance: np.ndarray, slots: int, sure: float):
    """(node, level) of the queries that go on, one symbol shorter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            level = b.column("level").to_numpy()
            lengths = b.column("sim").value_lengths().fill_null(0).to_numpy()
            sims = b.column("sim").flatten().to_numpy()
            row = np.repeat(np.arange(b.num_rows), lengths)
            met = np.bincount(row, chance[level[row], np.clip(sims * 100, 0, 100).astype(int)], b.num_rows) / slots
            on = (met < sure) & (level > 0)
            yield pa.RecordBatch.from_arrays([b.column("node").filter(pa.array(on)), pa.array((level[on] - 1).astype(np.int32))], names=["node", "level"])

    return run


def _indexed(vectors: DataFrame, k: int, shape: Shape, id_column: str, column: str, asked: Column | None, open_tables: ExitStack) -> tuple[DataFrame, DataFrame]:
    """The nodes (node, ids, vec, asked, codes), and the queries (id, node)."""

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, shape.dim)
            norm = np.linalg.norm(x, axis=1)
            some = pa.array(norm > 0)
            x = (x[norm > 0] / norm[norm > 0, None]).astype("<f4")
            yield pa.RecordBatch.from_arrays([b.column("id").filter(some), b.column("asked").filter(some), pa.array([r.tobytes() for r in x + np.float32(0)], pa.binary())], names=["id", "asked", "vec"])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                codes = strings(_unpack(b.column("vec").to_pylist()), shape)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array([r.tobytes() for r in codes], pa.binary())], names=[*b.schema.names, "codes"])

    kind = dict(vectors.dtypes)[id_column]
    plain = vectors.select(F.col(id_column).alias("id"), F.col(column).cast("array<double>").alias("v"), (F.lit(True) if asked is None else F.coalesce(asked, F.lit(False))).alias("asked"))
    one = plain.where(_valid("v")).where(F.size("v") == shape.dim).where("id is not null").groupBy("id").agg(F.min("v").alias("v"), F.max("asked").alias("asked"))
    hashed = one.mapInArrow(normal, f"id {kind}, asked boolean, vec binary").select("*", F.xxhash64("vec").alias("h"), F.xxhash64(F.lit(0x5EED), "vec").alias("l"))
    unit = open_tables.enter_context(table(hashed))
    from pyspark.sql import Window

    first = unit.withColumn("rank", F.row_number().over(Window.partitionBy("h", "l").orderBy("id"))).where(F.col("rank") <= k + 1)
    nodes = first.groupBy("h", "l").agg(F.array_sort(F.collect_list("id")).alias("ids"), F.first("vec").alias("vec"))
    which = unit.where("asked").groupBy("h", "l").agg(F.lit(True).alias("asked"))
    nodes = nodes.join(which, ["h", "l"], "left").withColumn("asked", F.coalesce("asked", F.lit(False)))
    nodes = nodes.withColumn("node", F.col("ids")[0].cast("long")) if kind in _WHOLE else nodes.orderBy(F.col("ids")[0]).withColumn("node", F.monotonically_increasing_id())
    base = open_tables.enter_context(table(nodes.select("node", "ids", "h", "l", "asked", "vec").mapInArrow(coded, f"node long, ids array<{kind}>, h long, l long, asked boolean, vec binary, codes binary")))
    return base, unit.where("asked").select("id", "h", "l").join(base.select("node", "h", "l"), ["h", "l"]).select("id", "node")


def _valid(v: str) -> Column:
    return F.col(v).isNotNull() & (F.size(v) > 0) & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < 1e18))


def neighbours(vectors: DataFrame, k: int = 10, trees: int = TREES, sure: float = SURE, id_column: str = "vec_id", column: str = "embedding", asked: Column | None = None, group: int = 16, enough: int = 8) -> DataFrame:
    """(vec_id, rank, neighbour_id, similarity): the k nearest others, from rank 1, of each vector for which the condition `asked` holds (of all, if none is given)."""
    spark = vectors.sparkSession
    small_batches(spark)
    kind = dict(vectors.dtypes)[id_column]
    common = vectors.where(F.col(id_column).isNotNull()).select(F.col(column).cast("array<double>").alias("v")).where(_valid("v")).groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if common is None:
        return spark.createDataFrame([], f"{id_column} {kind}, rank int, neighbour_id {kind}, similarity double")
    shape = Shape.of(common.d, trees)
    ends, symbols = shape.ends, len(shape.symbols)
    with ExitStack() as open_tables:
        base, questions = _indexed(vectors, k, shape, id_column, column, asked, open_tables)
        n = base.count()
        least = next((s for s in range(1, symbols) if n <= group * shape.spread(s)), symbols)
        blocks, width = max(1, -(-n // BLOCK)), max(spark.sparkContext.defaultParallelism * 2, n * trees // 500_000)
        chance = chances(shape)
        coded = base.select("node", "codes")

        member = coded.mapInArrow(_routed(shape, [least], False), "g long, node long, code long").withColumn("query", F.lit(False))
        query = base.where("asked").select("node", "codes", F.lit(least).alias("level"), F.lit(least).alias("length")).mapInArrow(_routed(shape, [least], True), "g long, node long, code long, level int").drop("level").withColumn("query", F.lit(True))
        counted = "node long, " + ", ".join(f"c{s} long" for s in range(least, symbols + 1))
        runs = member.unionByName(query).repartition(width, "g").sortWithinPartitions(F.desc("query")).mapInArrow(_runs(shape, least), counted)
        runs = runs.groupBy("node").agg(*[F.sum(f"c{s}").alias(f"c{s}") for s in range(least, symbols + 1)])
        level = F.lit(least)
        for s in range(least + 1, symbols + 1):
            level = F.when(F.col(f"c{s}") - trees >= enough * k, s).otherwise(level)
        asking = cut(runs.select("node", level.cast("int").alias("level")))

        found = spark.createDataFrame([], _FOUND)
        while not asking.isEmpty():
            levels = sorted(r.level for r in asking.select("level").distinct().collect())  # as many as a string has symbols, at most
            met = []
            if levels[-1]:
                lengths = sorted({min(s, least) for s in levels if s})
                ask = coded.join(asking.where("level > 0"), "node").withColumn("length", F.least("level", F.lit(least))).mapInArrow(_routed(shape, lengths, True), "g long, node long, code long, level int")
                have = coded.mapInArrow(_routed(shape, lengths, False), "g long, node long, code long").select("g", F.col("node").alias("member"), F.col("code").alias("other"))
                if levels[-1] > least:
                    rest = F.element_at(F.array(*[F.lit(ends[-1] - e) for e in ends]), F.col("level") + 1)
                    pairs = ask.withColumn("rest", rest).join(have, "g").where("shiftright(code, rest) = shiftright(other, rest)")
                else:
                    pairs = ask.drop("code", "level").join(have.drop("other"), "g")
                pairs = pairs.where("node <> member").select(F.pmod(F.xxhash64("member"), F.lit(blocks)).alias("block"), "node", "member")
                met.append(pairs.mapInArrow(_packed, "block long, node long, members array<long>"))
            if not levels[0]:
                met.append(asking.where("level = 0").select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), "node", F.lit(None).cast("array<long>").alias("members")))
            chunks = max(1, asking.count() // CHUNK)
            listed = met[0] if len(met) == 1 else met[0].unionByName(met[1])
            with table(listed.withColumn("chunk", F.pmod(F.xxhash64("node"), F.lit(chunks)))) as candidates:
                place = ["block", "chunk"]
                named = candidates.select(F.col("block").alias("b"), F.col("chunk").alias("c"), F.col("node").alias("q"))
                of_block = base.select(F.pmod(F.xxhash64("node"), F.lit(blocks)).alias("b"), "node", "vec").join(named.select("b", "c").distinct(), "b").select("b", "c", "node", "vec", F.lit(False).alias("query"))
                of_query = named.distinct().join(base.where("asked").select(F.col("node").alias("q"), "vec"), "q").select("b", "c", F.col("q").alias("node"), "vec", F.lit(True).alias("query"))
                got = candidates.groupBy(*place).cogroup(of_block.unionByName(of_query).groupBy("b", "c")).applyInArrow(_compared(k), _FOUND)
                found = cut(found.unionByName(got).repartition(max(spark.sparkContext.defaultParallelism, n // 100_000), "node").mapInArrow(_merge(k), _FOUND))
            slots = min(k, max(1, n - 1))
            asking = cut(asking.join(found, "node", "left").select("node", "level", "sim").mapInArrow(_unsure(chance, slots, sure), "node long, level int"))

        ids = base.select("node", "ids")
        near = found.select("node", F.explode(F.arrays_zip("near", "sim")).alias("x")).select("node", F.col("x.near").alias("near"), F.col("x.sim").alias("sim"))
        rows = near.join(ids.withColumnRenamed("node", "near"), "near").select("node", "sim", "ids").unionByName(base.where("asked").select("node", F.lit(1.0).cast("float").alias("sim"), "ids"))
        order = F.array_sort(F.flatten(F.collect_list(F.transform("ids", lambda i: F.struct((-F.col("sim")).alias("s"), i.alias("i"))))))
        told = questions.join(rows.groupBy("node").agg(order.alias("all")), "node").select("id", F.slice(F.filter("all", lambda x: x["i"] != F.col("id")), 1, k).alias("all"))
        out = told.select(F.col("id").alias(id_column), F.posexplode("all").alias("rank", "x"))
        return cut(out.select(id_column, (F.col("rank") + 1).alias("rank"), F.col("x.i").alias("neighbour_id"), F.round(-F.col("x.s").cast("double"), 5).alias("similarity")))
