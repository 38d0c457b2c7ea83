"""Near duplicates by Order MinHash.

A text is its sequence of lower-cased words. Each of `sketches` hash functions
picks the `order` least k-mers of the text, each k-mer labelled with its
occurrence number so that repeats count; their values in text order make the
sketch. Equal sketches need the same k-mers in the same order, which bounds
edit similarity and not only overlap. Short texts have too few k-mers that a
change leaves alone, and get as many sketches of single words besides. Texts
that share a sketch are candidates,
and a banded alignment decides: they are alike where 1 - edits / longer length
reaches `similarity`. Groups are the connected components of that.

Groups of thousands cost no quadratic work. Equal texts are one node. In each
sketch's bucket every node is first aligned with the bucket's least node only,
and what is connected then needs no further test. Only buckets that still hold
several components go on: their pairs across components are thinned by exact
bounds (length and folded word counts, which never exceed the edit distance)
in blocks, and the rest is aligned. No bucket is cut off.

Defined results:
* A null text, or one without words, is nobody's duplicate, and stays.
* Of a group stays the row of least doc_id (null last), then of least text
  hash; of rows that repeat both, the first by the remaining columns.
* Texts that differ in white space or ASCII case alone are duplicates.
* A text shorter than the k-mer length is one k-mer. Of a long text all words
  count; its alignment takes its length times the edits allowed.
* Texts are told apart by 128 bits of hashes. Ids may have any atomic type.
* An empty table gives no rows. Other columns pass through untouched, whatever
  their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import ExitStack
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import align
from . import tokens as tk
from .graph import components
from .linededup import WHO, _fresh, _who
from .state import cut, release, small_batches, table


@dataclass(frozen=True)
class Params:
    kmer: int = 2
    order: int = 3
    sketches: int = 32
    short: int = 32  # texts of so many words also have `short_sketches` of `short_order` single words
    short_order: int = 3
    short_sketches: int = 32
    similarity: float = 0.8
    bins: int = 128
    block: int = 1024
    hash_bits: int = 64  # of the first hash of a text; fewer only to test what happens to texts whose first hashes are equal


def _occurrence(kmers: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """For each k-mer how often it came earlier in its text."""
    rows = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    order = np.lexsort((kmers, rows)) if len(begin) > 2 else np.argsort(kmers, kind="stable")
    k, r = kmers[order], rows[order]
    fresh = np.r_[True, (k[1:] != k[:-1]) | (r[1:] != r[:-1])]
    place = np.arange(len(k))
    out = np.empty(len(k), np.uint64)
    out[order] = place - np.maximum.accumulate(np.where(fresh, place, 0))
    return out


def _kmers(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """k-mer hashes, begin of each text's, and the number of words; short texts are one k-mer."""
    data, off = tk.utf8(texts)
    starts, ends, first = tk.spans(data, off, tk.BY_SPACE)
    words = tk.hashes(data, starts, ends)
    grams, begin = tk.ngrams(words, first, k)
    n = np.diff(first)
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        whole = []
        for s in short:
            h = np.uint64(n[s])
            with np.errstate(over="ignore"):
                for w in words[first[s] : first[s + 1]]:
                    h = h * np.uint64(0x9FB21C651E98DF25) + w
            whole.append(h)
        grams = np.insert(grams, begin[short], tk.mix(np.array(whole, np.uint64)))
        counts = np.diff(begin)
        counts[short] = 1
        begin = np.r_[0, np.cumsum(counts)]
    return grams, begin, n


def order_minhash(texts: pa.Array, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """A sketch for each hash function and text (n x sketches), and the numbers of words. Without words a row has no meaning."""
    grams, begin, n = _kmers(texts, p.kmer)
    out = np.zeros((len(n), p.sketches), np.uint64)
    some = np.flatnonzero(np.diff(begin) > 0)
    if not len(some):
        return out, n
    counts = np.diff(begin)[some]
    base = tk.mix(grams ^ (_occurrence(grams, begin) * np.uint64(0xD1B54A32D192ED03)))
    owner = np.repeat(np.arange(len(some)), counts)
    # of each text, k-mers below this are looked at: some 8 times as many as are picked, or all of a short text's
    share = np.minimum(1.0, 8.0 * (p.order + 1) / counts)
    roof = np.where(share < 1, share * 2.0**64, 0).astype(np.uint64)
    roof = np.repeat(np.where(share < 1, roof, np.uint64((1 << 64) - 1)), counts)
    rng = np.random.default_rng(7)
    for j in range(p.sketches):
        flip, one, two = rng.integers(1 << 62, 1 << 63, 3, np.uint64) | np.uint64(1)
        value = (base ^ flip) * one
        value ^= value >> np.uint64(32)
        value *= two
        hits = np.flatnonzero(value <= roof)
        few = np.bincount(owner[hits], minlength=len(some)) < np.minimum(counts, p.order)
        if few.any():
            hits = np.flatnonzero((value <= roof) | few[owner])
        own, v = owner[hits], value[hits]
        order = np.lexsort((v, own))  # stable: the first of equal values
        hits, own = hits[order], own[order]
        first = np.r_[True, own[1:] != own[:-1]]
        rank = np.arange(len(own)) - np.maximum.accumulate(np.where(first, np.arange(len(own)), 0))
        hits, own = hits[rank < p.order], own[rank < p.order]
        hits = np.sort(hits)  # texts stand one behind another, so this is text order within each
        own = owner[hits]
        first = np.r_[True, own[1:] != own[:-1]]
        rank = np.arange(len(own)) - np.maximum.accumulate(np.where(first, np.arange(len(own)), 0))
        h = np.full(len(some), flip, np.uint64)
        for r in range(p.order):
            here = hits[rank == r]
            h[owner[here]] = h[owner[here]] * np.uint64(0x9FB21C651E98DF25) + grams[here]
        out[some, j] = tk.mix(h)
    return out, n


def keys(texts: pa.Array, p: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sketches of all texts, where each text's begin (n + 1 entries), and the numbers of words."""
    most, n = order_minhash(texts, p)
    short = np.flatnonzero((n > 0) & (n <= p.short))
    counts = np.full(len(n), p.sketches)
    counts[short] += p.short_sketches
    begin = np.r_[0, np.cumsum(counts)]
    out = np.empty(begin[-1], np.uint64)
    out[(begin[:-1, None] + np.arange(p.sketches)).ravel()] = most.ravel()
    if len(short):
        single, _ = order_minhash(texts.take(pa.array(short)), replace(p, kmer=1, order=p.short_order, sketches=p.short_sketches))
        out[(begin[short, None] + p.sketches + np.arange(p.short_sketches)).ravel()] = single.ravel()
    return out, begin, n


def _sketch(p: Params):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tk.pieces(batch, "text"):
                found, begin, n = keys(part.column("text"), p)
                keep = n > 0
                if not keep.any():
                    continue
                lists = pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(found.view(np.int64))).filter(pa.array(keep))
                own = part.select([*WHO, "doc_id", "t1", "t2"]).filter(pa.array(keep))
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(n[keep]), lists], names=[*own.schema.names, "n", "keys"])

    return run


def _sequences(p: Params):
    """Each text's words as 31-bit integers, and how many fall into each bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tk.pieces(batch, "text"):
                data, off = tk.utf8(part.column("text"))
                starts, ends, first = tk.spans(data, off, tk.BY_SPACE)
                words = (tk.hashes(data, starts, ends) >> np.uint64(33)).astype(np.int32)
                rows = np.repeat(np.arange(part.num_rows), np.diff(first))
                bins = np.bincount(rows * p.bins + words % p.bins, minlength=part.num_rows * p.bins)
                bins = np.minimum(bins, 255).astype(np.uint8).reshape(-1, p.bins)  # capped counts differ by no more than whole ones
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), pa.array([words[a:b].tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary()), pa.array([x.tobytes() for x in bins], pa.binary())],
                    names=["node", "seq", "bins"],
                )

    return run


def _verify(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                pairs = [(np.frombuffer(x, np.int32), np.frombuffer(y, np.int32)) for x, y in zip(part.column("x").to_pylist(), part.column("y").to_pylist())]
                yield part.select(["a", "b"]).filter(pa.array(align.within(pairs, similarity)))

    return run


def _bounded(similarity: float):
    """Pairs whose numbers of words, as a whole and in each bin, don't rule out that they are alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1).astype(np.int16) for c in ("x", "y"))
                n, m = batch.column("n").to_numpy(), batch.column("m").to_numpy()
                bound = ((1 - similarity) * np.maximum(n, m) + 1e-9).astype(np.int64)
                more = x - y
                over = np.maximum(more, 0).sum(1, dtype=np.int64)
                near = (np.abs(n - m) <= bound) & (np.maximum(over, over - more.sum(1, dtype=np.int64)) <= bound)
                yield batch.select(["a", "b"]).filter(pa.array(near))

    return run


def _near(pairs: DataFrame, sequences: DataFrame, p: Params) -> DataFrame:
    """Those of the pairs (a, b) that are worth an alignment."""
    size = F.octet_length("seq") / 4
    x = sequences.select(F.col("node").alias("a"), F.col("bins").alias("x"), size.cast("long").alias("n"))
    y = sequences.select(F.col("node").alias("b"), F.col("bins").alias("y"), size.cast("long").alias("m"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y", "n", "m").mapInArrow(_bounded(p.similarity), "a long, b long")


def _aligned(pairs: DataFrame, sequences: DataFrame, p: Params) -> DataFrame:
    """Those of the pairs (a, b) that are alike."""
    x = sequences.select(F.col("node").alias("a"), F.col("seq").alias("x"))
    y = sequences.select(F.col("node").alias("b"), F.col("seq").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_verify(p.similarity), "a long, b long")


def _across(p: Params):
    """Pairs of different components in one block pair of a bucket that the exact bounds don't rule out."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        left, right = key[1].as_py(), key[2].as_py()
        block = rows.column("block").to_numpy()
        node, root, n = (rows.column(c).to_numpy() for c in ("node", "root", "n"))
        bins = np.stack([np.frombuffer(x, np.uint8) for x in rows.column("bins").to_pylist()]).astype(np.int32) if len(node) else np.zeros((0, p.bins), np.int32)
        coarse = bins.reshape(len(node), 16, -1).sum(2)
        one, two = np.flatnonzero(block == left), np.flatnonzero(block == right)
        a_out, b_out = [], []
        for i in one:
            j = two[(root[two] != root[i]) & ((node[two] > node[i]) if left == right else True)]
            bound = ((1 - p.similarity) * np.maximum(n[j], n[i]) + 1e-9).astype(np.int64)
            near = np.abs(n[j] - n[i]) <= bound
            for counts in (coarse, bins):
                j, bound = j[near], bound[near]
                more = counts[j] - counts[i]
                over = np.maximum(more, 0).sum(1)
                near = np.maximum(over, over - more.sum(1)) <= bound
            j = j[near]
            a_out.append(np.full(len(j), node[i]))
            b_out.append(node[j])
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a_out, b_out))
        return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})

    return run


def _nodes(rows: DataFrame, clashes: DataFrame | None) -> DataFrame:
    """rows with the column `node`: the first hash, and where texts of different second hashes share it, one of both hashes for all but the least."""
    if clashes is None:
        return rows.withColumn("node", F.col("t1"))
    told = rows.join(clashes, "t1", "left")
    return told.withColumn("node", F.when(F.col("least").isNull() | (F.col("t2") == F.col("least")), F.col("t1")).otherwise(F.xxhash64("t1", "t2"))).drop("least")


def groups(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """(none, doc, th, doc_id, keep_none, keep_doc, keep_th, keep_id, size) for each row of a group of two or more rows; keep_* is the row that stays."""
    small_batches(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]
    with ExitStack() as open_tables:
        one = F.xxhash64("text") if p.hash_bits == 64 else F.pmod(F.xxhash64("text"), F.lit(1 << p.hash_bits))
        texts = docs.select(*_who(docs), docs["doc_id"], docs["text"]).where("text is not null").withColumns({"t1": one, "t2": F.xxhash64(F.lit(0x5EED), "text")})
        sketched = open_tables.enter_context(table(texts.mapInArrow(_sketch(p), f"none boolean, doc {kind}, th long, doc_id {kind}, t1 long, t2 long, n long, keys array<long>")))
        clashes = sketched.groupBy("t1").agg(F.min("t2").alias("least"), F.max("t2").alias("most")).where("least <> most").select("t1", "least")
        clashes = None if clashes.isEmpty() else open_tables.enter_context(table(clashes))
        sketched = _nodes(sketched, clashes)
        nodes = open_tables.enter_context(table(sketched.groupBy("node").agg(F.first("keys").alias("keys"), F.first("n").alias("n"))))
        spread_out = nodes.select("node", "n", F.posexplode("keys").alias("place", "key")).select("node", "n", F.xxhash64("place", "key").alias("key"))
        sizes = spread_out.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("size")).where("size > 1")
        buckets = open_tables.enter_context(table(spread_out.join(sizes, "key")))
        star = cut(buckets.where("hub <> node").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct())
        wanted = buckets.select("node").distinct()
        sequences = open_tables.enter_context(table(
            _nodes(texts.select("t1", "t2", "text"), clashes).join(wanted, "node", "left_semi").select("node", "text").mapInArrow(_sequences(p), "node long, seq binary, bins binary").dropDuplicates(["node"])
        ))
        edges = cut(_aligned(cut(_near(star, sequences, p)), sequences, p))
        release(docs.sparkSession)
        rooted = buckets.select("key", "node", "n").join(components(edges), "node", "left").withColumn("root", F.coalesce("root", "node"))
        mixed = rooted.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("key")
        # several buckets of the same nodes need one look only
        named = rooted.join(mixed, "key").groupBy("key").agg(F.sum(F.xxhash64("node") % (1 << 40)).alias("s"), F.sum(F.xxhash64("node", F.lit(1)) % (1 << 40)).alias("t"), F.count("*").alias("size"))
        named = named.groupBy("s", "t", "size").agg(F.min("key").alias("key")).select("key", "size")
        spread = (
            rooted.join(named, "key")
            .withColumn("blocks", F.ceil(F.col("size") / p.block).cast("int"))
            .withColumn("block", F.pmod(F.xxhash64("node", "key"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("key", F.least("block", "other").alias("l"), F.greatest("block", "other").alias("r"), "block", "node", "root", "n")
        )
        pairs = (
            spread.join(sequences.select("node", "bins"), "node")
            .groupBy("key", "l", "r").applyInArrow(_across(p), "a long, b long").distinct()
            .join(star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
        )
        more = cut(_aligned(cut(pairs), sequences, p))
        roots = components(edges.union(more))
        rows = sketched.drop("keys", "n").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        kept = rows.groupBy("root").agg(F.min(F.struct("none", "doc", "th", "doc_id")).alias("k"), F.count("*").alias("size")).where("size > 1")
        return cut(rows.join(kept, "root").select(*WHO, "doc_id", *[F.col(f"k.{c}").alias(f"keep_{c.replace('doc_id', 'id')}") for c in (*WHO, "doc_id")], "size"))


def duplicates(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """(doc_id, duplicate_of) for each document that goes, and the document of its group that stays."""
    found = groups(docs, p).where("none <> keep_none or doc <> keep_doc or th <> keep_th")
    return found.select("doc_id", F.col("keep_id").alias("duplicate_of"))


def drop_duplicates(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """docs with one row of each group."""
    found = groups(docs, p)
    none, doc, th, row, gone = _fresh(docs, "nd_none", "nd_doc", "nd_th", "nd_row", "nd_gone")
    names = dict(zip(WHO, (none, doc, th)))
    marks = found.groupBy(*[F.col(c).alias(n) for c, n in names.items()]).agg(F.max(F.expr("none <> keep_none or doc <> keep_doc or th <> keep_th")).alias(gone))
    keyed = docs.select("*", *[c.alias(names[w]) for w, c in zip(WHO, _who(docs))])
    kinds = dict(docs.dtypes)
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text") and not kinds[c].startswith(("map", "variant"))]
    joined = keyed.join(marks, [none, doc, th], "left").withColumn(row, F.row_number().over(Window.partitionBy(none, doc, th).orderBy(*others, F.lit(0))))
    return joined.where(F.col(gone).isNull() | (~F.col(gone) & (F.col(row) == 1))).select(*[F.col(f"`{c}`") for c in docs.columns])
