"""Models that operators can be given: language, quality and perplexity. Trained here, on the data at hand; others can be plugged in as any function of a column."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoints, release
from . import ngrams as ng
from . import text as tx


def char_ngrams(text: str, sizes: tuple[int, ...] = (1, 2, 3)) -> set[str]:
    """Distinct character n-grams of the lower-cased letters, with single spaces for all else."""
    low = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
    return {low[i : i + n] for n in sizes for i in range(len(low) - n + 1)}


class _Letters(dict):
    """For str.translate: letters stay, all else is a space."""

    def __missing__(self, code: int) -> int:
        self[code] = code if chr(code).isalpha() else 32
        return self[code]


class _Buckets(dict):
    """The bucket of each n-gram, a tuple of characters, for as many as fit a bound."""

    def __init__(self, n: int):
        self.n = n

    def __missing__(self, gram: tuple[str, ...]) -> int:
        if len(self) >= 1 << 18:
            self.clear()
        self[gram] = out = zlib.crc32("".join(gram).encode("utf-8", "surrogatepass")) % self.n
        return out


_LETTERS = _Letters()
_known_buckets = lru_cache(maxsize=2)(_Buckets)


def _buckets(text: str, n: int) -> np.ndarray:
    """The distinct buckets of a text's `char_ngrams`, in order. An n-gram is hashed once, not in each text."""
    low = " " + " ".join(text.lower().translate(_LETTERS).split()) + " "
    grams = {*zip(low), *zip(low, low[1:]), *zip(low, low[1:], low[2:])}
    found = set(map(_known_buckets(n).__getitem__, grams))
    out = np.fromiter(found, np.int64, len(found))
    out.sort()
    return out


class LanguageModel:
    """Naive Bayes over hashed character n-grams, from labelled texts. logs: a row for each bucket, a column for each language. No n-gram is left out, and its size is that of the table alone."""

    def __init__(self, logs: np.ndarray, languages: list[str], prior: list[float], known: np.ndarray):
        self.logs, self.languages, self.prior, self.known = logs, languages, prior, known

    @classmethod
    def train(cls, df: DataFrame, text: str = "text", label: str = "lang", buckets: int = 1 << 17) -> LanguageModel:
        """Counts, for each language, the texts that have an n-gram; they are added up on executors, and `buckets` numbers a language reach the driver."""

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: dict[str, np.ndarray] = {}
            for b in batches:
                for lang, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    if lang not in seen:
                        seen[lang] = np.zeros(buckets, np.int64)
                    seen[lang][_buckets(t, buckets)] += 1
            for lang, n in seen.items():
                at = np.flatnonzero(n)
                yield pa.record_batch({"lang": pa.array([lang] * len(at), pa.string()), "b": pa.array(at, pa.int32()), "n": pa.array(n[at])})

        labelled = df.where(F.col(label).isNotNull() & F.col(text).isNotNull())
        total = {r[label]: r.n for r in labelled.groupBy(label).agg(F.count("*").alias("n")).collect()}
        languages = sorted(total)
        counts = np.zeros((buckets, len(languages)))
        found = labelled.select(label, text).mapInArrow(count, "lang string, b int, n long").groupBy("lang", "b").agg(F.sum("n").alias("n")).toArrow()
        place = {x: i for i, x in enumerate(languages)}
        counts[found.column("b").to_numpy(), [place[x] for x in found.column("lang").to_pylist()]] = found.column("n").to_numpy()
        n = np.array([total[x] for x in languages], float)
        return cls(np.log((counts + 0.5) / (n + 1)).astype(np.float32), languages, np.log(n / n.sum()).tolist(), counts.any(1))

    def probabilities(self, text: str) -> dict[str, float]:
        found = _buckets(text, len(self.logs)) if self.languages else []
        found = found[self.known[found]] if len(found) else found
        if not len(found):
            return {}
        score = np.array(self.prior) + self.logs[found].sum(0, dtype=np.float64)
        p = np.exp(score - score.max())
        p /= p.sum()
        return {x: float(v) for x, v in zip(self.languages, p)}

    def __call__(self, text: Column) -> Column:
        shared = SparkSession.getActiveSession().sparkContext.broadcast(self)

        def run(a: pa.Array) -> pa.Array:
            m = shared.value
            return pa.array([None if t is None else list(m.probabilities(t).items()) for t in a.to_pylist()], pa.map_(pa.string(), pa.float64()))

        return F.arrow_udf(run, "map<string,double>")(text)


class QualityModel:
    """Logistic regression over hashed words and word pairs, fitted by Spark ML on executors. Texts are stripped and put on one line."""

    def __init__(self, pipeline):
        self.pipeline = pipeline

    @classmethod
    def train(cls, df: DataFrame, text: str = "text", label: str = "label", width: int = 1 << 16, rounds: int = 20) -> QualityModel:
        from pyspark.ml import PipelineModel
        from pyspark.ml.classification import LogisticRegression
        from pyspark.ml.feature import HashingTF, NGram, RegexTokenizer, VectorAssembler

        features = [
            RegexTokenizer(inputCol="_t", outputCol="_w", pattern=r"\s+"), NGram(n=2, inputCol="_w", outputCol="_b"),
            HashingTF(inputCol="_w", outputCol="_f1", numFeatures=width, binary=True), HashingTF(inputCol="_b", outputCol="_f2", numFeatures=width, binary=True),
            VectorAssembler(inputCols=["_f1", "_f2"], outputCol="_f"),
        ]
        regression = LogisticRegression(featuresCol="_f", labelCol=label, predictionCol="predicted", regParam=0.01, maxIter=rounds)
        spark = df.sparkSession
        checkpoints(spark)
        # texts are cut into words once, and each round adds up a gradient for each core, not for each part of the table
        ready = PipelineModel(stages=features).transform(cls._ready(df, F.col(text)).where(F.col(label).isNotNull()))
        rows = ready.select(label, "_f").coalesce(spark.sparkContext.defaultParallelism).checkpoint()
        fitted = PipelineModel(stages=[*features, regression.fit(rows)])
        # the summary holds the session, which can't be sent to executors once it has observed rows
        fitted.stages[-1]._java_obj.setSummary(df.sparkSession._jvm.scala.Option.empty())
        return cls(fitted)

    @staticmethod
    def _ready(df: DataFrame, text: Column) -> DataFrame:
        return df.withColumn("_t", F.coalesce(F.replace(tx.strip(text), F.lit("\n"), F.lit(" ")), F.lit("")))

    def score(self, df: DataFrame, text: Column | None = None, name: str = "quality_prob") -> DataFrame:
        """df with the probability of label 1, and the guess as `predicted`. A null text counts as empty."""
        from pyspark.ml.functions import vector_to_array

        out = self.pipeline.transform(self._ready(df, F.col("text") if text is None else text))
        return out.withColumn(name, vector_to_array("probability")[1]).drop("_t", "_w", "_b", "_f1", "_f2", "_f", "rawPrediction", "probability")


def holdout(df: DataFrame, key: str, share: float = 0.1, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Rows to fit on and rows to test on, by a seeded hash of the key."""
    test = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1_000_000)) < int(share * 1_000_000)
    return df.where(~test), df.where(test)


def _chunks(batches: Iterator[pa.RecordBatch], tokens: int) -> Iterator[tuple[np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Of batches (key, text): the keys and the cut texts of each chunk."""
    keys, parts = [], []
    for b in batches:
        keys.append(b.column(0).to_numpy(zero_copy_only=False))
        parts.append(ng.cut(b.column(1)))
        if sum(len(h) for h, _, _ in parts) >= tokens:
            yield np.concatenate(keys), ng.join(parts)
            keys, parts = [], []
    if parts:
        yield np.concatenate(keys), ng.join(parts)


class NgramModel:
    """An interpolated word trigram model of all n-grams that occur often enough; rare words share one class.

    It is a table of slices (key, g, n), see `ngrams`: the hashes of kept n-grams
    and how often each occurs; `table` has them one by one. A longer n-gram that is
    kept has its shorter ones kept, so a word's probability is that of the longest
    kept n-gram which ends there. Words and n-grams are told apart by 64-bit hashes.
    """

    def __init__(self, slices: DataFrame, bits: int, row_bytes: float, below: int, weights: tuple[float, float, float]):
        self.slices, self.bits, self.row_bytes, self.below, self.weights = slices, bits, row_bytes, below, weights

    @staticmethod
    def _bits(size: float) -> int:
        """Bits of a key, for so many bytes of text."""
        return max(1, math.ceil(math.log2(max(size, 1) / ng.KEY_BYTES)))

    @classmethod
    def train(cls, df: DataFrame, text: str = "text", least: int = 2, weights: tuple[float, float, float] = (0.2, 0.3, 0.5)) -> NgramModel:
        """Counts all n-grams of 1 to 3 words and keeps those that occur `least` times, on executors. Needs a checkpoint folder."""
        rows, size = df.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()
        bits, tokens = cls._bits(size), ng.TOKENS
        three = [("key", pa.int32()), ("g", pa.binary()), ("n", pa.binary())]

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, (h, starts, _) in _chunks(batches, tokens):
                for k, g in enumerate(ng.grams(h, ng.ends(h, starts))):
                    g, n = ng.distinct(g)
                    out = [(k << bits | top, data, ng.small(n[i:j])) for top, i, j, data in ng.slices(g, bits)]
                    yield pa.record_batch(list(zip(*out)) or [[]] * 3, pa.schema(three))

        def add(key: tuple, t: pa.Table) -> pa.Table:
            g = np.concatenate([ng.hashes(x) for x in t["g"].to_pylist()])
            n = np.concatenate([ng.numbers(x) for x in t["n"].to_pylist()])
            place, words = ng.ranks(g)
            value, total = np.empty(words, np.uint64), np.bincount(place, n, words).astype(np.int64)
            value[place] = g
            keep = total >= least
            kept = [data for *_, data in ng.slices(value[keep], bits)] or [None]
            counts = [ng.small(total[keep]) if keep.any() else None]
            return pa.table([[key[0].as_py()], kept, counts, [int(total.sum())], [words]], pa.schema([*three, ("total", pa.int64()), ("words", pa.int64())]))

        parts = df.select(F.lit(0).alias("key"), text).mapInArrow(count, "key int, g binary, n binary")
        slices = parts.groupBy("key").applyInArrow(add, "key int, g binary, n binary, total long, words long").checkpoint()
        total, words = slices.where(F.col("key") < 1 << bits).agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
        del parts
        release(df.sparkSession)
        return cls(slices.where("g is not null").select("key", "g", "n"), bits, size / max(rows, 1), total + words + 1, weights)

    @property
    def table(self) -> DataFrame:
        """(k, g, n): how often the n-gram of k words with hash g occurs."""
        bits = self.bits

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for key, g, n in zip(*(c.to_pylist() for c in b.columns)):
                    g = ng.hashes(g)
                    yield pa.record_batch({"k": np.full(len(g), (key >> bits) + 1, np.int32), "g": g.view(np.int64), "n": ng.numbers(n)})

        return self.slices.mapInArrow(each, "k int, g long, n long")

    def score(self, df: DataFrame, text: Column, name: str, by: Column | None = None) -> DataFrame:
        """df with a struct (log10_prob, tokens) of the text; null where it has no word. by: what equal texts have equal, if that is cheaper than the text itself.

        A chunk of texts asks each key for the counts of its distinct n-grams, and has them back in the order of the hashes. Texts go in two
        halves, by a hash, so that what the first shuffles is deleted before the second. Needs a checkpoint folder.
        """
        key, by = f"{name}_key", F.xxhash64(text if by is None else by)
        below, weights, own, tokens = self.below, self.weights, self.bits, ng.TOKENS
        bits = max(own, self._bits(df.count() * self.row_bytes))
        schema = pa.schema([("key", pa.int32()), ("chunk", pa.string()), ("g", pa.binary()), ("n", pa.binary()), ("body", pa.binary())])
        ddl = "key int, chunk string, g binary, n binary, body binary"

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for no, (keys, (h, starts, sizes)) in enumerate(_chunks(batches, tokens)):
                if not len(h):
                    continue
                part = TaskContext.get().partitionId()
                chunk = f"{part}-{no}"
                coded = pa.array(h).dictionary_encode()
                body = ng.pack([keys, starts, sizes, coded.dictionary.to_numpy(), coded.indices.to_numpy().astype(np.int64)])
                # it goes by way of any key to where the counts go
                yield pa.record_batch([[zlib.crc32(chunk.encode()) % (3 << bits)], [chunk], [None], [None], [body]], schema)
                for k, g in enumerate(ng.asked(h, ng.ends(h, starts))):
                    out = [(k << bits | top, chunk, data, None, None) for top, _, _, data in ng.slices(ng.distinct(g)[0], bits)]
                    yield pa.record_batch(list(zip(*out)), schema)

        def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for at, g, n in zip(*(c.to_pylist() for c in b.columns)):
                    n = ng.numbers(n)
                    out = [(at >> own << bits | top, None, data, ng.small(n[i:j]), None) for top, i, j, data in ng.slices(ng.hashes(g), bits)]
                    yield pa.record_batch(list(zip(*out)), schema)

        def answer(at: tuple, t: pa.Table) -> pa.Table:
            rows = list(zip(*(t[c].to_pylist() for c in ("chunk", "g", "n", "body"))))
            known, count = next(((ng.hashes(g), ng.numbers(n)) for chunk, g, n, _ in rows if chunk is None), (np.zeros(1, np.uint64), np.zeros(1, np.int64)))
            out = []
            for chunk, g, _, body in rows:
                if body is not None:
                    out.append((-1, chunk, None, None, body))
                elif chunk is not None:
                    g = ng.hashes(g)
                    place = np.minimum(np.searchsorted(known, g), len(known) - 1)
                    out.append((at[0].as_py(), chunk, None, ng.small(np.where(known[place] == g, count[place], 0)), None))
            return pa.Table.from_batches([pa.record_batch(list(zip(*out)) or [[]] * 5, schema)])

        def finish(t: pa.Table) -> pa.Table:
            t = t.sort_by("key")
            keys, starts, sizes, words, codes = ng.unpack(t["body"][0].as_py())
            h, starts, sizes = words[codes.astype(np.int64)], starts.astype(np.int64), sizes.astype(np.int64)
            at = ng.ends(h, starts)
            n, counts, used = [], np.concatenate([ng.numbers(x) for x in t["n"].to_pylist()[1:]]), 0
            for g in ng.asked(h, at):
                place, more = ng.ranks(g)
                n.append(counts[used : used + more][place])
                used += more
            if used != len(counts):
                raise RuntimeError(f"{len(counts)} counts for {used} n-grams")
            # before the first word of a line are marks, before the others what ends one place earlier
            first = np.append(True, np.diff(at) > 1)[: len(at)]
            p = weights[0] * (n[0][:-1] + 1) / below
            for weight, these, those in ((weights[1], n[1][:-1], n[0]), (weights[2], n[2], n[1])):
                before = np.where(first, those[-1], np.append(0, those[:-2]))
                p += np.where(before > 0, weight * these / np.maximum(before, 1), 0.0)
            some = sizes > 0
            sums = np.add.reduceat(np.log10(p), (np.cumsum(sizes) - sizes)[some])
            return pa.table({key: keys.view(np.int64)[some], "log10_prob": sums, "tokens": sizes[some].astype(np.int32)})

        def half(which: int) -> DataFrame:
            texts = df.where(F.pmod(by, F.lit(2)) == which).select(by.alias("key"), text.alias("_t"))
            asked = texts.mapInArrow(ask, ddl).union(self.slices.mapInArrow(split, ddl))
            scores = asked.groupBy("key").applyInArrow(answer, ddl).groupBy("chunk").applyInArrow(finish, f"`{key}` long, log10_prob double, tokens int")
            return scores.groupBy(key).agg(F.first(F.struct("log10_prob", "tokens")).alias(name)).checkpoint()

        first = half(0)
        release(df.sparkSession)
        return df.withColumn(key, by).join(first.union(half(1)), key, "left").drop(key)
