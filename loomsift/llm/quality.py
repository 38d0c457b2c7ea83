"""Quality classifier by importance resampling.

Two bag-of-n-gram models over hashed unigrams and bigrams are estimated, one
from a bounded sample of labelled target documents and one from every raw
document. The logarithm of their ratio, summed over a document, is its log
importance weight; with Gumbel noise added, the top k documents are a sample
without replacement in proportion to the weights.

A log ratio counts only as far as it exceeds `caution` standard errors: rare
n-grams say nothing, and what they would add up to over a long document
doesn't drown the few that do.

Defined results:
* A null text is rejected; an empty text has weight 0. Of a text of any length
  all n-grams count.
* A null doc_id is an id like any other; rows with equal id and text share
  their noise, and are kept or rejected together (ties at the limit are kept).
* No labelled target document, or an empty table: there is no evidence, all
  rows with a text are kept with weight 0.
* k of 0 keeps nothing, and k beyond the rows with a text keeps those.
* A document that several label rows cover is a target only if all agree.
* Other columns pass through untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tokens as tk
from .state import cut, release, small_batches


@dataclass(frozen=True)
class Params:
    buckets: int = 1 << 20
    #: Labelled rows that fitting reads at most: half for the target model, half for the limit.
    max_labelled: int = 40_000
    caution: float = 4.0
    #: Share of held-out clean documents that the limit may reject.
    clean_loss: float = 0.015
    noise: float = 1.0
    seed: int = 17


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # float32, a value for each bucket
    limit: float


def _grams(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each unigram and bigram, and the row it is in."""
    data, off = tk.utf8(texts)
    starts, ends, first = tk.spans(data, off, tk.BY_CLASS)
    one = tk.hashes(data, starts, ends)
    two, second = tk.ngrams(one, first, 2)
    rows = np.arange(len(off) - 1)
    both = np.concatenate([one, two])
    return (both & np.uint64(buckets - 1)).astype(np.int64), np.concatenate([np.repeat(rows, np.diff(first)), np.repeat(rows, np.diff(second))])


def _count(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            for part in tk.pieces(batch, "text"):
                bucket, row = _grams(part.column("text"), buckets)
                np.add.at(raw, bucket, 1)
                chosen = part.column("target").fill_null(False).to_numpy(zero_copy_only=False)
                if chosen.any():
                    np.add.at(target, bucket[chosen[row]], 1)
        at = np.flatnonzero(raw)
        for i in range(0, len(at), 1 << 17):
            b = at[i : i + (1 << 17)]
            yield pa.record_batch({"bucket": pa.array(b.astype(np.int32)), "raw": pa.array(raw[b]), "target": pa.array(target[b])})

    return run


def _weights(raw: np.ndarray, target: np.ndarray, caution: float) -> np.ndarray:
    """Log ratios of target to raw, as far as they exceed `caution` standard errors."""
    r, t = raw.sum(), target.sum()
    if not t or not r:
        return np.zeros(len(raw), np.float32)
    expected = raw * (t / r)
    ratio = np.log((target + 0.5) / (expected + 0.5))
    error = np.sqrt(1 / (np.maximum(target, expected) + 0.5) + 1 / (raw + 0.5))
    return (np.sign(ratio) * np.maximum(0, np.abs(ratio) - caution * error)).astype(np.float32)


def _scorer(weights, buckets: int):
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        values, out, at = weights.value, np.zeros(len(texts)), 0
        for part in tk.pieces(pa.record_batch({"text": texts}), "text"):
            bucket, row = _grams(part.column("text"), buckets)
            out[at : at + part.num_rows] = np.bincount(row, weights=values[bucket], minlength=part.num_rows)
            at += part.num_rows
        return pa.array(out, mask=texts.is_null().to_numpy(zero_copy_only=False))

    return score


def _gumbel(doc_id: Column, seed: int) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(doc_id, F.lit(seed)), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(u))


def fit(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> tuple[Model, Column]:
    """The model, and the column of log weights to apply to docs."""
    spark = docs.sparkSession
    small_batches(spark)
    clean = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.min("quality") >= 1).alias("q"), (F.max(F.coalesce("toxic", F.lit(0))) == 0).alias("t"))
    sample = (
        clean.select("doc_id", (F.col("q") & F.col("t")).alias("clean"), F.xxhash64("doc_id", F.lit(p.seed)).alias("h"))
        .orderBy("h", "doc_id").limit(p.max_labelled)
        .select("doc_id", "clean", (F.pmod("h", F.lit(2)) == 0).alias("fits"))
    )
    sample = F.broadcast(sample)  # max_labelled rows at most
    own = docs.select("doc_id", "text")
    counted = (
        own.join(sample, "doc_id", "left")
        .select("text", (F.col("clean") & F.col("fits")).alias("target"))
        .mapInArrow(_count(p.buckets), "bucket int, raw long, target long")
        .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    )
    raw, target = np.zeros(p.buckets), np.zeros(p.buckets)
    at = counted.column("bucket").to_numpy()
    raw[at], target[at] = counted.column("raw").to_numpy(), counted.column("target").to_numpy()
    weights = _weights(raw, target, p.caution)
    score = _scorer(spark.sparkContext.broadcast(weights), p.buckets)
    held = own.join(sample.where("clean and not fits"), "doc_id").select(score("text").alias("s")).where("s is not null").toArrow().column("s").to_numpy()
    release(spark)
    limit = float(np.quantile(held, p.clean_loss)) if len(held) and target.any() else -np.inf
    return Model(weights, limit), score(docs["text"])


def kth_largest(values: DataFrame, k: int) -> float:
    """The k-th largest of a column of doubles, by counting in ever narrower bins."""
    name = values.columns[0]
    low, high = values.agg(F.min(name), F.max(name)).first()
    while True:
        if low >= high or k < 1:
            return high
        width = (high - low) / 4096
        inside = values.where(F.col(name).between(low, high))
        bins = inside.groupBy(F.least(F.floor((F.col(name) - low) / width), F.lit(4095)).alias("b")).agg(F.count("*").alias("n"), F.min(name).alias("lo"), F.max(name).alias("hi")).collect()
        for r in sorted(bins, key=lambda r: -r.b):
            if k <= r.n:
                break
            k -= r.n
        low, high = r.lo, r.hi
        if r.n <= 10_000:
            return sorted((x[0] for x in inside.where(F.col(name).between(low, high)).collect()), reverse=True)[k - 1]


def resample(docs: DataFrame, labels: DataFrame, p: Params = Params(), scored: bool = False, k: int | None = None, fraction: float | None = None) -> DataFrame:
    """The rows of docs that importance resampling keeps; with `scored`, doc_id, log_weight and gumbel_key instead of docs' columns.

    k is the size of the sample, or a fraction of the rows with a text. By
    default it is the number of rows whose weight reaches the limit that loses
    `clean_loss` of the held-out clean documents, so that the size of the
    sample follows what the table holds. Rows that tie with the k-th are kept.
    """
    model, weight = fit(docs, labels, p)
    key = weight + p.noise * _gumbel(docs["doc_id"], p.seed + 1)
    if np.isinf(model.limit) and k is None and fraction is None:
        kept = docs.where(docs["text"].isNotNull())
    else:
        both = cut(docs.select(weight.alias("w"), key.alias("key")).where("w is not null"))
        if fraction is not None:
            k = round(fraction * both.count())
        elif k is None:
            k = both.where(F.col("w") >= model.limit).count()
        k = min(k, both.count())
        kept = docs.where(key >= F.lit(kth_largest(both.select("key"), k))) if k else docs.limit(0)
    return kept.select("doc_id", weight.alias("log_weight"), key.alias("gumbel_key")) if scored else kept
