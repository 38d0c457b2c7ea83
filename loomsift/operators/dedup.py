"""Exact and n-gram deduplication as deterministic distributed plans."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import words as wd
from ..sources import jsonl


def exact(df: DataFrame, key: Column, order: list[Column]) -> DataFrame:
    """The first row in the given order of each key, for scalar keys; rows without a key all stay. Spark limits each partition to one row per key before the shuffle."""
    # rows without a key get one of their own; a union with them would compute df twice
    w = Window.partitionBy("_key", "_own").orderBy(*order)
    keyed = df.withColumn("_key", F.md5(key.cast("string"))).withColumn("_own", F.when(F.col("_key").isNull(), F.monotonically_increasing_id()))
    return keyed.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank", "_key", "_own")


def exact_units(df: DataFrame, units: str, normalize, order: list[Column], row_key: str) -> DataFrame:
    """Takes repeated units (say, lines) out of an array column across all rows; rows without units left go.

    The first place of each unit is found by an aggregate that combines before
    the shuffle, so that a unit found in a billion pages is no hot task; only
    places of units found more than once are joined back.
    """
    place = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.col(row_key).alias("row"), F.col("pos"))
    rows = df.select("*", F.posexplode(units).alias("pos", "unit")).select(place.alias("place"), F.col(row_key).alias("row"), "pos", F.md5(normalize(F.col("unit"))).alias("uid"))
    first = rows.groupBy("uid").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    gone = rows.join(first, "uid").where("not place <=> first").groupBy("row").agg(F.collect_set("pos").alias("gone"))
    joined = df.join(gone, df[row_key].eqNullSafe(gone["row"]), "left").drop("row")
    kept = F.filter(units, lambda u, i: F.col("gone").isNull() | ~F.array_contains("gone", i))
    return joined.withColumn(units, kept).drop("gone").where((F.size(units) > 0))


def _tokens(texts: pa.Array) -> list[list[str]]:
    return [[] if t is None else wd.uax29(t) for t in texts.to_pylist()]


def _hashes(tokens: list[str], n: int) -> list[int]:
    """Signed 64-bit hashes of all runs of n tokens, which are slices of the joined tokens."""
    import xxhash

    raw = [w.encode() for w in tokens]
    data, ends = b"\x00".join(raw), list(accumulate(len(w) + 1 for w in raw))
    h = xxhash.xxh3_64_intdigest
    found = [h(data[a : z - 1]) for a, z in zip([0, *ends], ends[n - 1 :])]
    return [x - (1 << 64) if x >> 63 else x for x in found]


def units_of(df: DataFrame, key: str, text: str, by: str = "paragraph") -> DataFrame:
    """(key, unit, piece): the whole text, or the windows between newlines, each beginning with its newline."""
    if by == "document":
        return df.select(key, F.lit(0).alias("unit"), F.col(text).alias("piece")).where(tx.filled(F.col("piece")))
    pieces = F.transform(F.split(text, "\n"), lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.lit("\n"), p)))
    return df.where(tx.filled(F.col(text))).select(key, F.posexplode(pieces).alias("unit", "piece"))


def unit_ngrams(units: DataFrame, key: str, size: int = 13, least: int | None = None) -> DataFrame:
    """(key, unit, hash, times): distinct n-grams of each unit's words (UAX #29). A unit of fewer than `size` but at least `least` words is one n-gram."""
    least = size if least is None else least
    key_type = dict(units.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, hashes, times = [], [], []
            for i, tokens in enumerate(_tokens(b.column("piece"))):
                if not tokens or len(tokens) < min(size, least):
                    continue
                count = Counter(_hashes(tokens, min(size, len(tokens))))
                row += [i] * len(count)
                hashes += count
                times += count.values()
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(key).take(at), b.column("unit").take(at), pa.array(hashes, pa.int64()), pa.array(times, pa.int32())], names=[key, "unit", "hash", "times"])

    return units.select(key, "unit", "piece").mapInArrow(run, f"{key} {key_type}, unit int, hash long, times int")


def seen_before(grams: DataFrame, key: str, primer: DataFrame | None = None) -> DataFrame:
    """(key, unit, share): the share of each unit's n-grams that an earlier unit (by key, then unit) has at all, or that `primer` (hash) has."""
    at = F.struct(key, "unit")
    if primer is None:
        known = grams.groupBy("hash").agg(F.min(at).alias("first"))
        hit = grams.join(known, "hash").withColumn("hit", F.col("first") < at)
    else:
        hit = grams.join(primer.select("hash").distinct().withColumn("hit", F.lit(True)), "hash", "left").withColumn("hit", F.coalesce("hit", F.lit(False)))
    return hit.groupBy(key, "unit").agg(F.try_divide(F.sum(F.when(F.col("hit"), F.col("times")).otherwise(0)), F.sum("times")).alias("share"))


def fuzzy(grams: DataFrame, key: str, threshold: float = 0.8, or_equal: bool = False, rounds: int = 50, primer: DataFrame | None = None) -> DataFrame:
    """(key, unit, share, kept) by the sequential rule: units come in order, one goes if more than `threshold` of its n-grams were put in by kept units before it, and only kept units put theirs in.

    The rule is a recursion on the order with one solution. Each round takes
    the kept units of the last and finds every n-gram's first holder among
    them; the kept set is right up to ever later units, and when a round
    changes nothing it is the solution. No filter that errs, no order of
    threads: the same rows on every run. primer (hash): n-grams that count as
    put in before the first unit. What is written down are totals and the
    n-grams that several units have; n-grams of one unit never reach the disk.
    """
    return _fuzzy(grams, key, threshold, or_equal, rounds, primer).drop("n")


def _fuzzy(grams: DataFrame, key: str, threshold: float, or_equal: bool = False, rounds: int = 50, primer: DataFrame | None = None) -> DataFrame:
    """The result of `fuzzy`, and n: how many n-grams the unit has."""
    at = F.struct(key, "unit")
    total = grams.groupBy(key, "unit").agg(F.sum("times").alias("n")).checkpoint()
    always = None
    if primer is not None:
        known = grams.join(primer.select("hash"), "hash", "left_semi").checkpoint()
        always = known.groupBy(key, "unit").agg(F.sum("times").alias("always")).checkpoint()
        grams = grams.join(known.select("hash").distinct(), "hash", "left_anti")
    shared = _shared(grams, at)
    gone = None
    for _ in range(rounds):
        held = shared if gone is None else shared.join(gone, [key, "unit"], "left_anti")
        first = held.groupBy("hash").agg(F.min(at).alias("first"))
        hits = shared.join(first, "hash").where(F.col("first") < at).groupBy(key, "unit").agg(F.sum("times").alias("hits"))
        if always is not None:
            hits = hits.join(always, [key, "unit"], "full").select(key, "unit", (F.coalesce("hits", F.lit(0)) + F.coalesce("always", F.lit(0))).alias("hits"))
        hits = hits.join(total, [key, "unit"])
        share = F.col("hits") / F.col("n")
        now = hits.withColumn("share", share).withColumn("kept", ~((share >= threshold) if or_equal else (share > threshold))).select(key, "unit", "share", "kept").checkpoint()
        left = now.where("not kept").select(key, "unit")
        if _same(gone, left, [key, "unit"]):
            told = total.join(now, [key, "unit"], "left")
            return told.select(key, "unit", "n", F.coalesce("share", F.lit(0.0)).alias("share"), F.coalesce("kept", F.lit(0.0) < threshold if or_equal else F.lit(0.0) <= threshold).alias("kept"))
        gone = left
    raise RuntimeError("the order of duplicates is deeper than the number of rounds")


def save_ngrams(grams: DataFrame, path: str, mode: str = "append") -> None:
    """Adds the distinct n-gram hashes of grams to a stored set, for later runs to be held against. Appending needs no rewriting; `load_ngrams` drops what was added twice."""
    grams.select("hash").distinct().write.mode(mode).parquet(path)


def load_ngrams(spark: SparkSession, path: str) -> DataFrame:
    """(hash): a stored set; an empty one where nothing is stored yet."""
    if not jsonl.exists(spark, path):
        return spark.createDataFrame([], "hash long")
    return spark.read.schema("hash long").parquet(path).distinct()


def fuzzy_incremental(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", size: int = 13, threshold: float = 0.8, by: str = "paragraph", least: int | None = None, update: bool = True) -> DataFrame:
    """df against what earlier runs have kept, and against itself: the sequential rule with all of the stored set first. The n-grams of what stays join the set, unless update is off.

    Units whose share of stored n-grams alone exceeds the threshold go at
    once; the rule among the others then counts stored n-grams as hits.
    """
    spark = df.sparkSession
    grams = unit_ngrams(units_of(df, key, text, by), key, size, least).checkpoint()
    verdict = fuzzy(grams, key, threshold, primer=load_ngrams(spark, path)).checkpoint()
    if update:
        save_ngrams(grams.join(verdict.where("kept").select(key, "unit"), [key, "unit"], "left_semi"), path)
    if by == "document":
        return df.where(tx.filled(F.col(text))).join(verdict.where(~F.col("kept")).select(key), key, "left_anti")
    return rebuild(df, key, text, verdict)


def annotated(df: DataFrame, verdict: DataFrame, grams: DataFrame, key: str = "doc_id") -> DataFrame:
    """df with `duplicates`: for each unit of the row that has n-grams its number, how many n-grams it has, how many of them came before, and whether it would stay; the text is left alone."""
    n = grams.groupBy(key, "unit").agg(F.sum("times").alias("ngrams"))
    told = verdict.join(n, [key, "unit"]).select(key, F.struct("unit", "ngrams", F.round(F.col("share") * F.col("ngrams")).cast("long").alias("seen"), "kept").alias("u"))
    return df.join(told.groupBy(key).agg(F.array_sort(F.collect_list("u")).alias("duplicates")), key, "left")


def _shared(grams: DataFrame, at: Column) -> DataFrame:
    """The n-grams that several units have: the others only count in the totals, and needn't be joined in each round."""
    same = Window.partitionBy("hash")
    bounds = grams.withColumns({"_lo": F.min(at).over(same), "_hi": F.max(at).over(same)})
    return bounds.where("_lo < _hi").drop("_lo", "_hi").checkpoint()


def _same(before: DataFrame | None, now: DataFrame, by: list[str]) -> bool:
    if before is None:
        return now.isEmpty()
    return before.count() == now.count() and now.join(before, by, "left_anti").isEmpty()


def document_ngrams(df: DataFrame, key: str, text: str, size: int = 13, least: int | None = None) -> DataFrame:
    """(key, lo, hi, hash, times): distinct n-grams of the whole text, each with the first and last paragraph (between newlines) that it touches. A text of fewer than `size` but at least `least` words is one n-gram."""
    least = size if least is None else least
    key_type = dict(df.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, lo, hi, hashes, times = [], [], [], [], []
            for i, t in enumerate(b.column(text).to_pylist()):
                parts = [wd.uax29(p) for p in (t or "").split("\n")]
                tokens = [w for p in parts for w in p]
                of = [n for n, p in enumerate(parts) for _ in p]
                n = size if len(tokens) >= size else len(tokens)
                if not tokens or n < min(size, least):
                    continue
                count = Counter(zip(of, of[n - 1 :], _hashes(tokens, n)))
                for (a, z, h), c in count.items():
                    row.append(i), lo.append(a), hi.append(z), hashes.append(h), times.append(c)
            yield pa.RecordBatch.from_arrays([b.column(key).take(pa.array(row, pa.int64())), pa.array(lo, pa.int32()), pa.array(hi, pa.int32()), pa.array(hashes, pa.int64()), pa.array(times, pa.int32())], names=[key, "lo", "hi", "hash", "times"])

    return df.select(key, text).mapInArrow(run, f"{key} {key_type}, lo int, hi int, hash long, times int")


def both(grams: DataFrame, key: str, threshold: float = 0.8, rounds: int = 50) -> tuple[DataFrame, DataFrame]:
    """(documents that go, paragraphs (key, unit) that go of the others), by the sequential rule on whole documents.

    Documents come in order. One goes, and puts nothing in, if at least
    `threshold` of all its n-grams were put in by earlier documents; of the
    others each paragraph goes by the same share of the n-grams within it, and
    the n-grams that touch no paragraph that went are put in. Solved by rounds
    as in `fuzzy`.
    """
    inside = F.when(F.col("lo") == F.col("hi"), F.col("lo"))
    sizes = grams.groupBy(key, inside.alias("unit")).agg(F.sum("times").alias("n")).checkpoint()
    totals = sizes.groupBy(key).agg(F.sum("n").alias("n"))
    parts = sizes.where("unit is not null")
    shared = _shared(grams, F.col(key))
    gone = cut_of = None
    for _ in range(rounds):
        held = shared
        if gone is not None:
            held = shared.join(gone, key, "left_anti").join(cut_of.groupBy(key).agg(F.collect_set("unit").alias("cut")), key, "left")
            held = held.where(F.col("cut").isNull() | ~F.exists("cut", lambda u: (u >= F.col("lo")) & (u <= F.col("hi"))))
        first = held.groupBy("hash").agg(F.min(key).alias("first"))
        hits = shared.join(first, "hash").where(F.col("first") < F.col(key)).groupBy(key, inside.alias("unit")).agg(F.sum("times").alias("hits")).checkpoint()
        now = hits.groupBy(key).agg(F.sum("hits").alias("hits")).join(totals, key).where(F.col("hits") / F.col("n") >= threshold).select(key).checkpoint()
        cut_now = hits.where("unit is not null").join(parts, [key, "unit"]).where(F.col("hits") / F.col("n") >= threshold).join(now, key, "left_anti").select(key, "unit").checkpoint()
        if gone is not None and _same(gone, now, [key]) and _same(cut_of, cut_now, [key, "unit"]):
            return now, cut_now
        gone, cut_of = now, cut_now
    raise RuntimeError("the order of duplicates is deeper than the number of rounds")


def rebuild(df: DataFrame, key: str, text: str, verdict: DataFrame) -> DataFrame:
    """df with the text of its kept units; units without n-grams stay, and texts that are blank then go."""
    gone = verdict.where(~F.col("kept")).groupBy(key).agg(F.collect_set("unit").alias("_gone"))
    return _without(df.join(gone, key, "left"), text)


def _without(df: DataFrame, text: str) -> DataFrame:
    """df without the pieces of its text whose numbers are in `_gone`; texts that are blank then go."""
    pieces = F.transform(F.split(text, "\n"), lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.lit("\n"), p)))
    left = F.array_join(F.filter(pieces, lambda p, i: ~F.array_contains("_gone", i)), "")
    out = df.withColumn(text, F.when(F.coalesce(F.size("_gone"), F.lit(0)) <= 0, F.col(text)).otherwise(left)).drop("_gone")
    return out.where(tx.filled(F.col(text)))


def fuzzy_paragraphs(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 13, threshold: float = 0.8) -> DataFrame:
    return rebuild(df, key, text, fuzzy(unit_ngrams(units_of(df, key, text), key, size), key, threshold))


def fuzzy_documents(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 13, threshold: float = 0.8) -> DataFrame:
    """Documents most of whose n-grams came before go."""
    verdict = fuzzy(unit_ngrams(units_of(df, key, text, "document"), key, size), key, threshold)
    return df.where(tx.filled(F.col(text))).join(verdict.where(~F.col("kept")).select(key), key, "left_anti")


def fuzzy_both(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 13, threshold: float = 0.8, rule: str = "old") -> DataFrame:
    """Paragraphs and documents.

    old: paragraphs go by the paragraph rule, and the document goes too where
    more than `threshold` of all its n-grams came before; its kept paragraphs
    still count for later ones. both: see `both`; n-grams cross paragraphs, and
    a document that goes puts nothing in. naive: documents first, then
    paragraphs of those that stay.
    """
    if rule == "both":
        whole, parts = both(document_ngrams(df, key, text, size), key, threshold)
        return rebuild(df.join(whole, key, "left_anti"), key, text, parts.withColumn("kept", F.lit(False)))
    if rule == "naive":
        return fuzzy_paragraphs(fuzzy_documents(df, key, text, size, threshold), key, text, size, threshold)
    grams = unit_ngrams(units_of(df, key, text), key, size)
    verdict = _fuzzy(grams, key, threshold)
    share = verdict.groupBy(key).agg((F.sum(F.col("share") * F.col("n")) / F.sum("n")).alias("all"))
    whole = share.where(F.col("all") > threshold).select(key)
    return rebuild(df.join(whole, key, "left_anti"), key, text, verdict)


def sequential(df: DataFrame, shard: str, key: str, text: str, mode: str = "substring", size: int = 13, threshold: float = 0.8, least_tokens: int = 50, annotate: bool = False) -> DataFrame:
    """Dedup in order within each shard, with a set of n-grams that grows as documents come.

    substring: runs of tokens covered by n-grams seen before, joined where at
    least `threshold` of the tokens between are covered, are cut if they have
    `least_tokens`. exact: a text equal to an earlier one goes; blank texts and
    null are texts like others. annotate leaves the text and adds `spans` (byte
    offsets) instead.
    """
    if mode == "exact":
        same = Window.partitionBy(shard, "_h").orderBy(F.col(key).asc_nulls_last())
        ranked = df.select(shard, key, text, F.md5(text).alias("_h")).withColumn("_rank", F.row_number().over(same))
        whole = F.array(F.struct(F.lit(0).cast("long").alias("s"), F.octet_length(F.coalesce(text, F.lit(""))).cast("long").alias("e")))
        if not annotate:
            return ranked.where("_rank = 1").select(key, text, F.slice(whole, 1, 0).alias("spans"))
        return ranked.select(key, text, F.when(F.col("_rank") == 1, F.slice(whole, 1, 0)).otherwise(whole).alias("spans"))

    from . import substrings

    return substrings.dedup(df.select(shard, key, text), shard, key, text, size, threshold, least_tokens, annotate)


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of intervals; touching ones become one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def invert_spans(spans: list[tuple[int, int]], size: int) -> list[tuple[int, int]]:
    edges = [0, *[x for s in merge_spans(spans) for x in s], size]
    return [(a, b) for a, b in zip(edges[::2], edges[1::2]) if a < b]


def bridge_spans(spans: list[tuple[int, int]], threshold: float) -> list[tuple[int, int]]:
    """Joins neighbouring intervals, from the left and from the right, while the covered share of the whole stays at the threshold or above."""

    def sweep(items: list[tuple[int, int]]) -> list[tuple[int, int]]:
        out: list[tuple[int, int, int]] = []
        for a, b in items:
            if out and (out[-1][2] + b - a) >= threshold * (b - out[-1][0]):
                out[-1] = (out[-1][0], b, out[-1][2] + b - a)
            else:
                out.append((a, b, b - a))
        return [(a, b) for a, b, _ in out]

    forward = sweep(spans)
    backward = [(-b, -a) for a, b in sweep([(-b, -a) for a, b in reversed(spans)])]
    return merge_spans(forward + backward)


def substring_cuts(text: str, seen: set, size: int, threshold: float, least_tokens: int) -> list[tuple[int, int]]:
    """Character spans to cut from a text; its other n-grams are added to seen."""
    boundary, _ = wd._boundary()
    where, at = [], 0
    for piece in boundary.split(text):
        if piece.strip():
            where.append((at, at + len(piece)))
        at += len(piece)
    tokens = [text[a:b] for a, b in where]
    grams = [tuple(tokens[i : i + size]) for i in range(len(tokens) - size + 1)]
    hits = merge_spans([(i, i + size) for i, g in enumerate(grams) if g in seen])
    if threshold < 1:
        hits = bridge_spans(hits, threshold)
    cut = [(a, b) for a, b in hits if b - a >= least_tokens]
    for a, b in invert_spans(cut, len(tokens)):
        seen.update(tuple(tokens[i : i + size]) for i in range(a, b - size + 1))
    return [(where[a][0], where[b - 1][1]) for a, b in cut]


def contaminated(items: DataFrame, docs: DataFrame, item_key: str = "item_id", key: str = "doc_id", size: int = 13) -> DataFrame:
    """(item_key, share): the share of each benchmark item's n-grams that some document has. Only distinct hashes of the documents meet the items'."""
    mine = unit_ngrams(units_of(items, item_key, "text", "document"), item_key, size, least=1)
    theirs = unit_ngrams(units_of(docs, key, "text", "document"), key, size).select("hash")
    primer = theirs.join(mine.select("hash").distinct(), "hash", "left_semi").distinct()
    return seen_before(mine, item_key, primer).drop("unit")


#: As many n-grams of a benchmark are sent to all executors; if it has more, the documents' n-grams are joined with them.
PROBED = 4_000_000


def decontaminate(docs: DataFrame, items: DataFrame, key: str = "doc_id", item_key: str = "item_id", size: int = 13, threshold: float = 0.8, by: str = "paragraph") -> DataFrame:
    """Paragraphs (or documents) go if more than `threshold` of their n-grams are in the benchmark; documents add nothing to what is probed."""
    primer = unit_ngrams(units_of(items, item_key, "text", "document"), item_key, size).select("hash").distinct()
    if primer.limit(PROBED + 1).count() <= PROBED:
        return _probed(docs, "text", items, size, threshold, by)
    share = seen_before(unit_ngrams(units_of(docs, key, "text", by), key, size), key, primer).withColumn("kept", F.coalesce(F.col("share") <= threshold, F.lit(True)))
    if by == "document":
        return docs.join(share.where(~F.col("kept")).select(key), key, "left_anti")
    return rebuild(docs, key, "text", share)


def _probed(docs: DataFrame, text: str, items: DataFrame, size: int, threshold: float, by: str) -> DataFrame:
    """`decontaminate` in one pass without a shuffle: the benchmark's n-grams are a sorted array of hashes that all tasks have."""
    from . import substrings

    def hashes(texts: list[list[str]], ids: dict) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the n-grams within each list of tokens, and the number of the list."""
        n = np.array([len(t) for t in texts], np.int64)
        if n.sum() < size:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        of = np.repeat(np.arange(len(texts)), n)
        h = substrings.grams(np.fromiter((ids[w] for t in texts for w in t), np.uint64, int(n.sum())), size)
        inside = of[: len(h)] == of[size - 1 :]
        return h[inside], of[: len(h)][inside]

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = substrings.WordIds()
        for b in batches:
            yield pa.record_batch({"hash": pa.array(np.unique(hashes(_tokens(b.column(0)), ids)[0]).view(np.int64))})

    found = items.select("text").mapInArrow(probe, "hash long").distinct().toArrow().column("hash").to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(np.sort(found.view(np.uint64)))

    def gone(texts: pa.Array) -> pa.Array:
        """For each text the numbers of the units that go."""
        known, out, at, units = shared.value, [[] for _ in range(len(texts))], [], []
        for i, t in enumerate(texts.to_pylist()):
            parts = [] if t is None else [t] if by == "document" else t.split("\n")
            at += [(i, j) for j in range(len(parts))]
            units += map(wd.uax29, parts)
        h, of = hashes(units, gone.ids)
        if len(known) and len(h):
            hit = known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h
            n, hits = np.bincount(of, minlength=len(units)), np.bincount(of[hit], minlength=len(units))
            for u in np.flatnonzero(hits):
                if hits[u] / n[u] > threshold:
                    i, j = at[u]
                    out[i].append(j)
        return pa.array(out, pa.list_(pa.int32()))

    gone.ids = substrings.WordIds()
    told = docs.withColumn("_gone", F.arrow_udf(gone, "array<int>")(F.col(text)))
    if by == "document":
        return told.where(F.size("_gone") == 0).drop("_gone")
    return _without(told, text)


def bloom_bits(n: int, error: float) -> tuple[int, int]:
    """Bits and hash functions of a Bloom filter for n keys, for planning a migration; the plans here use exact sets."""
    import math

    bits = math.ceil(-n * math.log(error) / math.log(2) ** 2)
    return bits, max(1, math.ceil(bits / max(n, 1) * math.log(2)))
