"""Scoring text with a log-bilinear language model trained by noise-contrastive estimation.

The model predicts a word from the two before it: each context word's vector
goes through a matrix of its place, their sum is the predicted vector, and a
word's score is its product with the word's own vector, and a bias. Training
tells words of the corpus from words drawn from the unigram distribution, which
needs no sum over the vocabulary.

The vocabulary grows with the corpus: its size is `growth` times the root of the
number of distinct words, counted over all documents. The most common words are
classes of their own, the others are in bands of about equal frequency, and a
word's probability is that of its class times that within the class. Scoring
normalises both exactly, by matrix products with the classes and with one band.
A token out of the vocabulary is <unk>, and is spelled: its bytes have the
probabilities of an interpolated byte trigram model of all such tokens.

Every document trains the model once: partitions start from the same parameters,
learn from all their trigrams with their counts, and send the vectors that they
changed, which are averaged by how often each partition saw the word; this is
done for an eighth of the documents and then, from there, for the rest.

Defined results:
* A null or empty text, or one of white space, has 0 tokens, log_prob 0 and a
  null mean.
* Tokens are lower-cased words and runs of punctuation. Equal counts are ordered
  by hash. An empty table has no model and gives no rows.
* Repeated rows are each scored, and count each in training. A null doc_id is
  an id like any other; ids may have any type. Texts of any length are learnt
  from and scored as a whole. Other columns play no part, whatever their names.
* How the table is partitioned sets the order of training, and so moves scores
  a little; the same partitions give the same scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens as tk
from .state import cut, small_batches

UNK, BOS = 0, 1
LARGE = 4 << 20  # bytes of text that are learnt from, or scored, together


@dataclass(frozen=True)
class Params:
    vocabulary: int | None = None  # None: grows with the corpus
    growth: int = 32
    least: int = 1024
    head: int = 128
    width: int = 32
    noise: int = 48
    inner: int = 4
    batch: int = 8192
    rate: float = 0.14
    seed: int = 23


@dataclass
class Model:
    """words: hashes of the words 2, 3, ...; unigram: probabilities of all; head: how many ids are classes of their own; band: the size of the others' classes."""

    words: np.ndarray
    unigram: np.ndarray
    head: int
    band: int
    context: np.ndarray  # vocabulary x width
    target: np.ndarray  # vocabulary x width
    bias: np.ndarray
    group: np.ndarray  # classes x width
    group_bias: np.ndarray
    place: np.ndarray  # 2 x width x width
    spelling: tuple[np.ndarray, np.ndarray] | None = None  # byte trigrams and their counts

    def of(self, ids: np.ndarray) -> np.ndarray:
        """The class of each id."""
        return np.where(ids < self.head, ids, self.head + (ids - self.head) // self.band)

    def flat(self) -> np.ndarray:
        """A row for each word, class and row of the matrices, as wide as a word's."""
        v, c, d = len(self.bias), len(self.group), self.place.shape[-1]
        out = np.zeros((v + c + 2 * d, 2 * d + 1), np.float32)
        out[:v, :d], out[:v, d:-1], out[:v, -1] = self.context, self.target, self.bias
        out[v : v + c, :d], out[v : v + c, -1] = self.group, self.group_bias
        out[v + c :, :d] = self.place.reshape(-1, d)
        return out

    def filled(self, flat: np.ndarray) -> Model:
        v, c, d = len(self.bias), len(self.group), self.place.shape[-1]
        parts = flat[:v, :d], flat[:v, d:-1], flat[:v, -1], flat[v : v + c, :d], flat[v : v + c, -1], flat[v + c :, :d].reshape(2, d, d)
        return Model(self.words, self.unigram, self.head, self.band, *(x.astype(np.float32, order="C") for x in parts), self.spelling)


def fresh(words: np.ndarray, unigram: np.ndarray, p: Params) -> Model:
    rng = np.random.default_rng(p.seed)
    v, d = len(unigram), p.width
    head = min(v, p.head)
    band = max(1, int(np.ceil(np.sqrt(v - head))))
    place = np.stack([np.eye(d), 0.5 * np.eye(d)]).astype(np.float32)
    vectors = lambda n: rng.standard_normal((n, d)).astype(np.float32) * 0.1
    m = Model(words, unigram, head, band, vectors(v), vectors(v), np.zeros(v, np.float32), np.zeros((0, d), np.float32), np.zeros(0, np.float32), place)
    of = m.of(np.arange(v))
    mass = np.bincount(of, weights=unigram)
    m.group, m.group_bias = vectors(len(mass)), np.log(mass).astype(np.float32)
    m.bias = np.log(unigram / mass[of]).astype(np.float32)
    return m


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data, off = tk.utf8(texts)
    return data, *tk.spans(data, off, tk.BY_CLASS)


def _token_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, starts, ends, first = _tokens(texts)
    return tk.hashes(data, starts, ends), first


class _Index:
    """Looks words up by the leading bits of their hashes: a table says where in the sorted hashes those with the same bits begin."""

    def __init__(self, words: np.ndarray):
        self.words, order = words, np.argsort(words)
        self.sorted = np.r_[words[order], np.uint64((1 << 64) - 1)]
        self.id = np.r_[order + 2, UNK].astype(np.int32)
        bits = max(1, int(len(words)).bit_length() + 2)
        self.shift = np.uint64(64 - bits)
        self.begin = np.searchsorted(words[order], np.arange(1 << bits).astype(np.uint64) << self.shift).astype(np.int32)

    def ids(self, h: np.ndarray) -> np.ndarray:
        at = self.begin[(h >> self.shift).view(np.int64)]
        there = self.sorted[at]
        left = np.flatnonzero(there < h)
        while len(left):
            at[left] += 1
            left = left[self.sorted[at[left]] < h[left]]
        return np.where(self.sorted[at] == h, self.id[at], np.int32(UNK))


_last: list[_Index] = []


def _ids(h: np.ndarray, words: np.ndarray) -> np.ndarray:
    if not _last or _last[0].words is not words:
        _last[:] = [_Index(words)]
    return _last[0].ids(h)


def encode(texts: pa.Array, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word ids, the ids one and two places before, and each text's first token (n + 1 entries)."""
    h, first = _token_hashes(texts)
    ids = _ids(h, words)
    return ids, *_before(ids, first), first


def _before(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    one, two = np.empty_like(ids), np.empty_like(ids)
    one[1:], two[2:] = ids[:-1], ids[:-2]
    begin = first[:-1][np.diff(first) > 0]
    one[begin] = two[begin] = BOS
    second = first[:-1][np.diff(first) > 1] + 1
    two[second] = BOS
    return one, two


START, END = 0xFE, 0xFF  # in no UTF-8 text


def _trigrams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The byte trigrams of tokens, lower-cased and with an end, and where each token's begin (n + 1 entries)."""
    begin = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts + 1, out=begin[1:])
    if not len(starts):
        return np.zeros(0, np.int64), begin
    at = np.arange(begin[-1]) + np.repeat(starts - begin[:-1], np.diff(begin))
    byte = tk.LOWER[data[np.minimum(at, len(data) - 1)]]
    byte[begin[1:] - 1] = END
    one, two = np.full_like(byte, START), np.full_like(byte, START)
    one[1:], two[2:] = byte[:-1], byte[:-2]
    one[begin[:-1]] = two[begin[:-1]] = START
    two[begin[:-1] + 1] = START
    return (two.astype(np.int64) << 16) | (one.astype(np.int64) << 8) | byte, begin


def _spell(shared):
    """Counts of the byte trigrams of tokens out of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 24, np.int64)
        for batch in batches:
            for part in tk.pieces(batch, "text"):
                data, starts, ends, _ = _tokens(part.column("text"))
                out = np.flatnonzero(_ids(tk.hashes(data, starts, ends), shared.value) == UNK)
                codes, n = np.unique(_trigrams(data, starts[out], ends[out])[0].astype(np.int32), return_counts=True)
                total[codes] += n
        codes = np.flatnonzero(total)
        yield pa.record_batch({"code": pa.array(codes.astype(np.int32)), "n": pa.array(total[codes])})

    return run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of word hashes, added up over a million entries at a time."""
    h, n = [], []

    def compact() -> Iterator[pa.RecordBatch]:
        words, back = np.unique(np.concatenate(h), return_inverse=True)
        sums = np.bincount(back.ravel(), weights=np.concatenate(n)).astype(np.int64)
        h.clear()
        n.clear()
        for at in range(0, len(words), 1 << 17):
            yield pa.record_batch({"word": pa.array(words[at : at + (1 << 17)].view(np.int64)), "n": pa.array(sums[at : at + (1 << 17)])})

    for batch in batches:
        for part in tk.pieces(batch, "text"):
            words, counts = np.unique(_token_hashes(part.column("text"))[0], return_counts=True)
            h.append(words)
            n.append(counts)
            if sum(map(len, h)) > 1_000_000:
                yield from compact()
    if h:
        yield from compact()


def vocabulary(docs: DataFrame, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """The most common words' hashes, and the unigram probabilities of all ids."""
    counts = docs.select("text").mapInArrow(_count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = cut(counts)
    total, distinct = counts.agg(F.sum("n"), F.count("*")).first()
    size = p.vocabulary or max(p.least, int(p.growth * distinct**0.5))
    top = counts.orderBy(F.desc("n"), "word").limit(size - 2).toArrow()
    words = top.column("word").to_numpy().astype(np.int64).view(np.uint64)
    often = top.column("n").to_numpy()
    n = np.concatenate([[(total or 0) - often.sum(), 0], often]).astype(float) + 0.5
    return words, n / n.sum()


def _sums(keys: np.ndarray, order: np.ndarray, values: np.ndarray, most: int = 6, sorted_keys: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, and the sums of their rows of values. `order` sorts the keys (unless they are), and says where each one's row is; runs are mostly short, and are added up place by place."""
    by = keys if sorted_keys else keys[order]
    begin = np.flatnonzero(np.r_[True, by[1:] != by[:-1]])
    size = np.diff(np.r_[begin, len(by)])
    out = values.take(order[begin], 0)
    left = np.flatnonzero(size > 1)
    for k in range(1, most):
        if not len(left):
            break
        out[left] += values.take(order[begin[left] + k], 0)
        left = left[size[left] > k + 1]
    if len(left):
        rest = size[left] - most
        first = np.r_[0, np.cumsum(rest)[:-1]]
        at = np.arange(rest.sum()) + np.repeat(begin[left] + most - first, rest)
        out[left] += np.add.reduceat(values[order[at]], first, axis=0)
    return by[begin], out


def _ascend(values: np.ndarray, square: np.ndarray, rows: np.ndarray, g: np.ndarray, rate: float) -> None:
    """AdaGrad on distinct rows, with a step size for each row: `square` adds up the mean squares of its gradients."""
    new = square.take(rows)
    new += np.einsum("ij,ij->i", g, g) / g.shape[1]
    square[rows] = new
    g *= (rate / np.sqrt(new))[:, None]
    g += values.take(rows, 0)
    values[rows] = g


def _scatter(values: np.ndarray, square: np.ndarray, at: np.ndarray, gradient: np.ndarray, rate: float) -> None:
    """AdaGrad on the rows `at`, which may repeat."""
    _ascend(values, square, *_sums(at, np.argsort(at), gradient), rate)


def _below_one(x: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """weight / (1 + e^x), in the place of x."""
    np.clip(x, -30, 30, out=x)
    np.exp(x, out=x)
    x += 1
    return np.divide(weight, x, out=x)


class Trainer:
    """Noise-contrastive steps on batches of distinct trigrams, weighted by their counts: a class against other classes, a word against others of its band. Vectors and biases of a class or word are one row."""

    def __init__(self, model: Model, p: Params, seed: int):
        self.p, self.rng, self.model = p, np.random.default_rng(seed), model
        m = model
        self.context, self.place = m.context.copy(), m.place.copy()
        self.target, self.group = np.column_stack([m.target, m.bias]), np.column_stack([m.group, m.group_bias])
        self.squares = [np.full(len(x), 1e-4, np.float32) for x in (self.context, self.target, self.group)] + [np.full(self.place.shape, 1e-4, np.float32)]
        self.seen, self.tokens = np.zeros(len(m.bias), np.int64), 0
        self.of = m.of(np.arange(len(m.bias)))
        mass = np.bincount(self.of, weights=model.unigram)
        self.cumulative, self.words_cumulative = np.cumsum(mass), np.cumsum(model.unigram)
        self.log_noise = np.log(p.noise * mass).astype(np.float32)
        self.log_inner = np.log(p.inner * model.unigram / mass[self.of]).astype(np.float32)

    @property
    def m(self) -> Model:
        old = self.model
        return Model(old.words, old.unigram, old.head, old.band, self.context, self.target[:, :-1], self.target[:, -1], self.group[:, :-1], self.group[:, -1], self.place, old.spelling)

    def step(self, w: np.ndarray, at: np.ndarray, c1: np.ndarray, c2: np.ndarray, weight: np.ndarray) -> None:
        """Words w after the contexts (c1, c2)[at], where `at` ascends and names each context. The noise is the same for all, so it is met once for each context."""
        weight = (weight / weight.sum()).astype(np.float32)
        begin = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        of_context = np.add.reduceat(weight, begin)
        order = np.argsort(w)  # and so by class
        w, by, weight = w[order], at[order], weight[order]
        k, rate = self.p.noise, self.p.rate
        noise = np.minimum(np.searchsorted(self.cumulative, self.rng.random(k)), len(self.group) - 1)
        g = self.of[w]
        e1, e2 = self.context.take(c1, 0), self.context.take(c2, 0)
        q = np.ones((len(c1), e1.shape[1] + 1), np.float32)  # the last column is for the bias
        np.matmul(e1, self.place[0], out=q[:, :-1])
        q[:, :-1] += e2 @ self.place[1]
        others = self.group[noise]
        d_bad = _below_one(self.log_noise[noise] - q @ others.T, -of_context[:, None])
        mine, own = q.take(by, 0), self.group.take(g, 0)
        good = np.einsum("ij,ij->i", mine, own)
        good -= self.log_noise[g]
        d_good = _below_one(good, weight)
        own *= d_good[:, None]
        d_rows = own[:, :-1]
        self.within(w, g, mine, weight, d_rows)
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        d_q = _sums(at, back, d_rows, sorted_keys=True)[1]
        d_q += d_bad @ others[:, :-1]
        d_place = np.stack([e1.T @ d_q, e2.T @ d_q])
        first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        classes, sums = g[first], np.add.reduceat(d_good[:, None] * mine, first, axis=0)
        _scatter(self.group, self.squares[2], np.concatenate([classes, noise]), np.concatenate([sums, d_bad.T @ q]), rate)
        for c, place in ((c1, self.place[0]), (c2, self.place[1])):
            rows, sums = _sums(c, np.argsort(c), d_q)
            _ascend(self.context, self.squares[0], rows, sums @ place.T, rate)
        self.squares[3] += d_place * d_place
        self.place += 0.2 * rate * d_place / np.sqrt(self.squares[3])

    def within(self, w: np.ndarray, g: np.ndarray, q: np.ndarray, weight: np.ndarray, d_q: np.ndarray) -> None:
        """The same within bands, each band of the batch with noise words of its own; w ascends. Adds to d_q."""
        m, k, rate = self.model, self.p.inner, self.p.rate
        at = int(np.searchsorted(w, m.head))
        if at == len(w):
            return
        w, g, q, weight, d_q = w[at:], g[at:], q[at:], weight[at:], d_q[at:]
        bands, begin = np.unique(g, return_index=True)
        low = m.head + (bands - m.head) * m.band
        high = np.minimum(low + m.band, len(m.bias))
        floor = self.words_cumulative[low - 1]
        spot = floor[:, None] + self.rng.random((len(bands), k)) * (self.words_cumulative[high - 1] - floor)[:, None]
        noise = np.clip(np.searchsorted(self.words_cumulative, spot), low[:, None], high[:, None] - 1)
        others = self.target[noise]
        offset = self.log_inner[noise]
        own = self.target.take(w, 0)
        good = np.einsum("ij,ij->i", q, own)
        good -= self.log_inner[w]
        d_good = _below_one(good, weight)
        own *= d_good[:, None]
        d_q += own[:, :-1]
        spread = np.empty((len(bands), k, q.shape[1]), np.float32)
        which = np.repeat(np.arange(len(bands)), np.diff(np.r_[begin, len(w)]))
        for j in range(k):
            mine = others[:, j].take(which, 0)
            d_bad = _below_one(offset[which, j] - np.einsum("ij,ij->i", q, mine), -weight)
            mine *= d_bad[:, None]
            d_q += mine[:, :-1]
            spread[:, j] = np.add.reduceat(d_bad[:, None] * q, begin, axis=0)
        words, sums = _sums(w, np.arange(len(w)), d_good[:, None] * q)
        _scatter(self.target, self.squares[1], np.concatenate([words, noise.ravel()]), np.concatenate([sums, spread.reshape(-1, q.shape[1])]), rate)

    def learn(self, ids: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        """All trigrams, each distinct one once with its count, by contexts in random order; a step takes some `batch` tokens' worth."""
        v = len(self.seen)
        for x in (ids, one, two):
            self.seen += np.bincount(x, minlength=v)
        self.tokens += len(ids)
        triple, n = np.unique((two.astype(np.int64) * v + one) * v + ids, return_counts=True)
        context = triple // v
        fresh = np.r_[True, context[1:] != context[:-1]]
        pair, of_pair = context[fresh], np.cumsum(fresh) - 1
        shuffled = self.rng.permutation(len(pair))  # the place of each context
        order = np.argsort(shuffled[of_pair])
        triple, n, of_pair = triple[order], n[order], of_pair[order]
        batch = (np.cumsum(n) - 1) // self.p.batch
        for part in np.split(np.arange(len(triple)), np.flatnonzero(np.diff(batch)) + 1):
            c = of_pair[part]
            new = np.r_[True, c[1:] != c[:-1]]
            code = pair[c[new]]
            self.step(triple[part] % v, np.cumsum(new) - 1, code % v, code // v, n[part].astype(np.float32))


def _train(shared, p: Params):
    """Learns from a partition; the rows of the model that changed, and their weight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = None
        for batch in batches:
            for part in tk.pieces(batch, "text", LARGE):
                ids, one, two, _ = encode(part.column("text"), shared.value.words)
                if len(ids):
                    trainer = trainer or Trainer(shared.value, p, p.seed)
                    trainer.learn(ids, one, two)
        if trainer:
            flat = trainer.m.flat()
            weight = np.full(len(flat), trainer.tokens, np.int64)
            weight[: len(trainer.seen)] = trainer.seen
            rows = np.flatnonzero(weight)
            for at in range(0, len(rows), 4096):
                r = rows[at : at + 4096]
                yield pa.record_batch({"i": pa.array(r.astype(np.int32)), "x": pa.array([x.tobytes() for x in flat[r]], pa.binary()), "n": pa.array(weight[r])})

    return run


def _mean(width: int):
    """The weighted means of the rows of one partition, where all of a row's copies are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place: dict[int, int] = {}
        total, weight = np.zeros((1024, width)), np.zeros(1024)
        for batch in batches:
            if not batch.num_rows:
                continue
            at = np.array([place.setdefault(i, len(place)) for i in batch.column("i").to_pylist()])
            while len(place) > len(total):
                total, weight = np.concatenate([total, np.zeros_like(total)]), np.concatenate([weight, np.zeros_like(weight)])
            n = batch.column("n").to_numpy().astype(float)
            x = np.frombuffer(b"".join(batch.column("x").to_pylist()), np.float32).reshape(-1, width)
            np.add.at(total, at, x * n[:, None])
            np.add.at(weight, at, n)
        if place:
            mean = (total[: len(place)] / weight[: len(place), None]).astype(np.float32)
            yield pa.record_batch({"i": pa.array(list(place), pa.int32()), "x": pa.array([x.tobytes() for x in mean], pa.binary())})

    return run


def fit(docs: DataFrame, p: Params = Params()) -> Model | None:
    """The model, trained on all documents; None if they have no word."""
    small_batches(docs.sparkSession)
    words, unigram = vocabulary(docs, p)
    if not len(words):
        return None
    model = fresh(words, unigram, p)
    known = docs.sparkSession.sparkContext.broadcast(words)
    spelled = docs.select("text").mapInArrow(_spell(known), "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    model.spelling = spelled.column("code").to_numpy(), spelled.column("n").to_numpy()
    early = F.pmod(F.xxhash64("doc_id", "text"), F.lit(8)) == 0
    for part in (early, ~early):
        shared = docs.sparkSession.sparkContext.broadcast(model)
        flat = model.flat()
        learnt = docs.where(part).select("text").mapInArrow(_train(shared, p), "i int, x binary, n long")
        mean = learnt.repartition("i").mapInArrow(_mean(flat.shape[1]), "i int, x binary").toArrow()
        if mean.num_rows:
            flat[mean.column("i").to_numpy()] = np.frombuffer(b"".join(mean.column("x").to_pylist()), np.float32).reshape(-1, flat.shape[1])
            model = model.filled(flat)
    return model


def _spelling(codes: np.ndarray, n: np.ndarray, weight: float = 4.0) -> np.ndarray:
    """Log-probabilities of all byte trigrams: counts, backed by those of bigrams, single bytes and an even spread."""
    three = np.zeros((256, 256, 256), np.float32)
    three.ravel()[codes] = n
    two = three.sum(0, dtype=np.float64)
    one = two.sum(0)
    p = (one + 1) / (one.sum() + 256)
    p = (two + weight * p) / (two.sum(1, keepdims=True) + weight)
    below = three.sum(2, keepdims=True) + np.float32(weight)
    three += (weight * p).astype(np.float32)
    three /= below
    return np.log(three, out=three).ravel()


class Scorer:
    """Log-probabilities, normalised by matrix products over the classes for each distinct context, and over one band for each word of a band."""

    def __init__(self, model: Model):
        self.m, self.v = model, len(model.bias)
        self.q1, self.q2 = model.context @ model.place[0], model.context @ model.place[1]
        self.spelling = None

    @staticmethod
    def _chosen(q: np.ndarray, target: np.ndarray, bias: np.ndarray, row: np.ndarray, column: np.ndarray, size: int = 256) -> np.ndarray:
        """Log-probabilities of the targets `column` given the rows `row` of q, which ascend; in slices of q whose scores stay in the processor's cache."""
        roof = np.sqrt((q * q).sum(1).max(initial=0) * (target * target).sum(1).max()) + np.abs(bias).max()
        out, target = np.empty(len(row), np.float32), np.ascontiguousarray(target.T)
        cuts = np.searchsorted(row, np.arange(0, len(q) + size, size))
        for a, b, at in zip(cuts.tolist(), cuts[1:].tolist(), range(0, len(q), size)):
            s = q[at : at + size] @ target
            s += bias
            if roof >= 80:  # single precision might overflow
                s -= s.max(1, keepdims=True)
            here = row[a:b] - at
            picked = s[here, column[a:b]]
            np.exp(s, out=s)
            picked -= np.log(s.sum(1)).take(here)
            out[a:b] = picked
        return out

    def log_probs(self, ids: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        m = self.m
        code = one.astype(np.int64) * self.v + two
        order = np.argsort(code)
        code = code[order]
        fresh = np.r_[True, code[1:] != code[:-1]] if len(code) else np.zeros(0, bool)
        pair, of_pair = code[fresh], np.cumsum(fresh) - 1
        q = self.q1.take(pair // self.v, 0)
        q += self.q2.take(pair % self.v, 0)
        mine, g = ids[order], m.of(ids[order])
        got = self._chosen(q, m.group, m.group_bias, of_pair, g)
        rows = np.flatnonzero(mine >= m.head)
        rows = rows[np.argsort(g[rows])]
        bands, begin = np.unique(g[rows], return_index=True)
        for b, r in zip(bands.tolist(), np.split(rows, begin[1:])):
            low = m.head + (b - m.head) * m.band
            got[r] += self._chosen(q.take(of_pair[r], 0), m.target[low : low + m.band], m.bias[low : low + m.band], np.arange(len(r)), mine[r] - low)
        out = np.empty(len(ids), np.float32)
        out[order] = got
        return out

    def spell(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Log-probabilities of tokens, given that they are out of the vocabulary."""
        if self.spelling is None:
            self.spelling = _spelling(*(self.m.spelling or (np.zeros(0, np.int32), np.zeros(0))))
        codes, begin = _trigrams(data, starts, ends)
        return np.add.reduceat(self.spelling[codes].astype(np.float64), begin[:-1]) if len(codes) else np.zeros(0)


def score(docs: DataFrame, model: Model | None = None, p: Params = Params()) -> DataFrame:
    """(doc_id, tokens, log_prob, mean_log_prob) for each document; the model is trained on docs if none is given. Scoring needs no shuffle."""
    id_type = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {id_type}, tokens long, log_prob double, mean_log_prob double"
    model = fit(docs, p) if model is None else model
    if model is None:
        return docs.select("doc_id", F.lit(0).cast("long").alias("tokens"), F.lit(0.0).alias("log_prob"), F.lit(None).cast("double").alias("mean_log_prob"))
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        for batch in batches:
            scorer = scorer or Scorer(shared.value)
            for part in tk.pieces(batch, "text", LARGE):
                data, starts, ends, first = _tokens(part.column("text"))
                ids = _ids(tk.hashes(data, starts, ends), shared.value.words)
                n = np.diff(first)
                each = scorer.log_probs(ids, *_before(ids, first)).astype(np.float64)
                out = np.flatnonzero(ids == UNK)
                each[out] += scorer.spell(data, starts[out], ends[out])
                sums = np.r_[0, np.cumsum(each)]
                total = sums[first[1:]] - sums[first[:-1]]
                mean = pa.array(total / np.maximum(n, 1), mask=n == 0)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(np.where(n, total, 0.0)), mean], names=["doc_id", "tokens", "log_prob", "mean_log_prob"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)
