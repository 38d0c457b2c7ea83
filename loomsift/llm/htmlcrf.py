"""Main-text extraction with a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks: runs of text under the same block element. Each
has features of its ancestors' tags and classes, its length, links, digits and
punctuation, and its place. The chain says of each block whether it is content.
It is trained by gradient ascent on the conditional likelihood (forward and
backward passes over a whole batch of pages at once), and decoded by Viterbi.

Labelled pages are pages whose author marked the content up with <article> or
<main>: blocks inside are content. These two tags never become features, so
that what is learnt holds on pages without them.

Defined results:
* A null or empty page has a null text and no blocks. A page without a content
  block has an empty text. Markup, broken or not, is read as browsers do:
  unclosed elements end where their parent does, stray closing tags are passed
  over, a quote inside an unquoted value is part of it, and a comment, tag or
  script that never ends takes the rest of the page with it. Elements nested
  more than 512 deep become siblings.
* Pages of any length are read as a whole, in time that grows with their length.
* Of equally likely labels of a block, it is left out.
* Without a labelled page there is nothing to learn, and every block is kept;
  an empty table gives no rows.
* Repeated rows are each extracted, and rows without an id too; ids may have any
  atomic type. Other columns play no part, whatever their names.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .state import small_batches
from .tokens import pieces

WIDTH = 1 << 13
SEED = 11
#: Labelled pages that training reads at most.
MAX_LABELLED = 1500
#: Bytes that these have together at most; they and their features are held by the driver.
MAX_BYTES = 32 << 20
#: Blocks, padding included, that are trained or decoded at once.
CELLS = 1 << 19
CARRIERS = frozenset(["article", "main"])
INLINE = frozenset("a abbr b bdi bdo big cite code del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
RAW = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I | re.A) for t in ("script", "style", "noscript", "template", "svg")}
TITLES = frozenset(["title", "textarea"])
#: Elements nested deeper than this become siblings, as in browsers.
DEPTH = 512
_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_SKIP = re.compile(r"[\s/]*")
_ATTRIBUTE = re.compile(r"=?[^\s/>=]*")
_EQUALS = re.compile(r"\s*=\s*")
_BARE = re.compile(r"[^\s>]*")


def _tag(page: str, at: int) -> tuple[int, str, bool]:
    """Reads attributes from at on: the index behind the tag's end, its class and id, and whether it closes itself. Without an end, the index is -1."""
    found, closes = [], False
    while True:
        skipped = _SKIP.match(page, at)
        at = skipped.end()
        if at >= len(page):
            return -1, "", False
        if page[at] == ">":
            return at + 1, " ".join(found).lower(), page[at - 1] == "/" and skipped.end() > skipped.start()
        name = _ATTRIBUTE.match(page, at)
        at = name.end()
        value = ""
        if equals := _EQUALS.match(page, at):
            at = equals.end()
            quote = page[at : at + 1]
            if quote in ('"', "'") and quote:
                end = page.find(quote, at + 1)
                if end < 0:
                    return -1, "", False
                value, at = page[at + 1 : end], end + 1
            else:
                bare = _BARE.match(page, at)
                value, at = bare.group(), bare.end()
        if value and name.group().lower() in ("class", "id"):
            found.append(value)


def markup(page: str) -> Iterator[tuple[str, str, str, bool]]:
    """(kind, name or text, class and id, closes itself) for texts, opening ('<') and closing ('/') tags; a single pass over the page."""
    at, size = 0, len(page)
    while at < size:
        start = page.find("<", at)
        # a < that begins no markup is text
        while 0 <= start and not (page[start + 1 : start + 2].isascii() and (page[start + 1 : start + 2].isalpha() or page[start + 1 : start + 2] in ("!", "?", "/"))):
            start = page.find("<", start + 1)
        if start < 0:
            yield "t", page[at:], "", False
            return
        if start > at:
            yield "t", page[at:start], "", False
        if page.startswith("<!--", start):
            # <!--> and <!---> are whole comments
            end = page.find("-->", start + 2)
            at = size if end < 0 else end + 3
            continue
        closing = page[start + 1] == "/"
        name = _NAME.match(page, start + 1 + closing)
        if name is None:
            end = page.find(">", start)
            at = size if end < 0 else end + 1
            continue
        tag = name.group().lower()
        end, classes, closes = _tag(page, name.end())
        if end < 0:
            return
        at = end
        if not closing and tag in RAW and not closes:
            stop = RAW[tag].search(page, at)
            at = stop.end() if stop else size
            continue
        yield "/" if closing else "<", tag, classes, closes


@dataclass
class Block:
    text: str
    path: tuple[tuple[str, str], ...]  # (tag, classes), outermost first
    linked: int


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page, in order. The time grows with the page's length alone."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    count: dict[str, int] = {}
    parts: list[str] = []
    path: tuple[tuple[str, str], ...] | None = ()
    linked, anchors = 0, 0
    title = ""

    def flush() -> None:
        nonlocal linked, path
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            if path is None:
                path = tuple(stack)
            out.append(Block(text, path, min(linked, len(text))))
        parts.clear()
        linked = 0

    def pop() -> None:
        count[stack.pop()[0]] -= 1

    for kind, tag, classes, closes in markup(page):
        if kind == "t":
            if not title:
                parts.append(tag)
                if anchors:
                    linked += len(tag)
            continue
        closing = kind == "/"
        if title and tag != title:
            continue
        if tag in TITLES:
            title = "" if closing else tag
            continue
        if tag in INLINE:
            anchors = max(0, anchors + (-1 if closing else 1)) if tag == "a" else anchors
            continue
        if tag == "br":
            parts.append(" ")
            continue
        flush()
        anchors = 0
        path = None
        if closing:
            if count.get(tag):
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        if tag in ENDS_P and stack and stack[-1][0] == "p":
            pop()
        if tag in SIBLINGS and stack and stack[-1][0] in SIBLINGS[tag]:
            pop()
        if tag not in VOID and not closes:
            if len(stack) >= DEPTH:
                pop()
            stack.append((tag, classes))
            count[tag] = count.get(tag, 0) + 1
    flush()
    return out


def _hash(name: str) -> int:
    return zlib.crc32(name.encode()) % (WIDTH - 1) + 1


def _of_path(path: tuple[tuple[str, str], ...]) -> list[int]:
    names = {"root"}
    path = tuple(x for x in path if x[0] not in CARRIERS)
    for tag, classes in path:
        names.add(f"in {tag}")
        names.update(f"class {c}" for c in classes.split())
    names.add(f"parent {path[-1][0] if path else ''}")
    names.add("path " + "/".join(t for t, _ in path[-3:]))
    return [_hash(n) for n in sorted(names)]


def _of_text(b: Block, i: int, size: int) -> list[int]:
    n = len(b.text)
    digits = sum(map(b.text.count, "0123456789")) * 4 // n
    names = (
        f"length {n.bit_length()}", f"words {(b.text.count(' ') + 1).bit_length()}", f"linked {b.linked * 4 // n}", f"digits {digits}",
        f"end {b.text[-1] if not b.text[-1].isalnum() else 'a'}", f"capital {b.text[0].isupper()}", f"place {i * 5 // size}", f"from start {min(i, 4)}", f"from end {min(size - 1 - i, 4)}",
        f"stops {min(4, b.text.count('. '))}",
    )
    return [_hash(n) for n in names]


def features(page: list[Block]) -> list[list[int]]:
    """Hashed features of each block."""
    own: dict[tuple, list[int]] = {}
    return [(own.get(b.path) or own.setdefault(b.path, _of_path(b.path))) + _of_text(b, i, len(page)) for i, b in enumerate(page)]


def emissions(weights: np.ndarray, page: list[Block]) -> np.ndarray:
    """The summed weights of each block's features; those of a path are summed once for all its blocks."""
    if not page:
        return np.zeros(0)
    own: dict[tuple, float] = {}
    for b in page:
        if b.path not in own:
            own[b.path] = float(weights[_of_path(b.path)].sum())
    rest = np.array([_of_text(b, i, len(page)) for i, b in enumerate(page)], np.int64)
    return np.array([own[b.path] for b in page]) + weights[rest].sum(1)


def _grouped(sizes: list[int]) -> list[np.ndarray]:
    """Indices of the pages that have blocks, in groups of like length; padded to its longest page, a group has CELLS blocks at most (or is one page)."""
    out, now = [], []
    for i in sorted((i for i, n in enumerate(sizes) if n), key=lambda i: sizes[i]):
        if now and (len(now) + 1) * sizes[i] > CELLS:
            out.append(np.array(now))
            now = []
        now.append(i)
    return [*out, np.array(now)] if now else out


@dataclass(frozen=True)
class Crf:
    """Weights of features for the label 1 (label 0 has none), of moves between labels, and of the first label."""

    weights: np.ndarray
    moves: np.ndarray
    first: np.ndarray


def _flatten(pages: list[list[list[int]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Feature ids of all blocks in a row, begin of each block's, and page and place of each block."""
    ids = np.array([f for page in pages for b in page for f in b], np.int64)
    sizes = np.array([len(b) for page in pages for b in page], np.int64)
    begin = np.r_[0, np.cumsum(sizes)][:-1] if len(sizes) else np.zeros(0, np.int64)
    page = np.repeat(np.arange(len(pages)), [len(p) for p in pages])
    place = np.concatenate([np.arange(len(p)) for p in pages]) if pages else np.zeros(0, np.int64)
    return ids, begin, page, place.astype(np.int64)


def _emit(weights: np.ndarray, flat, shape: tuple[int, int]) -> np.ndarray:
    ids, begin, page, place = flat
    out = np.zeros(shape)
    if len(begin):
        out[page, place] = np.add.reduceat(weights[ids], begin)
    return out


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


class _Group:
    """Labelled pages of like length, and the gradient of their log-likelihood."""

    def __init__(self, pages: list[list[list[int]]], labels: list[list[int]]):
        self.flat = self.ids, self.begin, self.page, self.place = _flatten(pages)
        n = np.array([len(p) for p in pages])
        self.shape = (len(pages), int(n.max()))
        self.gold = np.zeros(self.shape, np.int64)
        self.gold[self.page, self.place] = np.concatenate([np.asarray(y) for y in labels])
        self.inside = np.arange(self.shape[1]) < n[:, None]
        self.per_block = np.diff(np.r_[self.begin, len(self.ids)])
        self.pair = self.inside[:, 1:]
        g = self.gold
        self.want_moves = np.array([[(self.pair & (g[:, :-1] == a) & (g[:, 1:] == b)).sum() for b in (0, 1)] for a in (0, 1)], float)
        self.want_first = np.bincount(g[:, 0], minlength=2).astype(float)

    def gradient(self, weights: np.ndarray, moves: np.ndarray, first: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """The log-likelihood of the labels, and its gradient."""
        shape, inside = self.shape, self.inside
        score = np.zeros((*shape, 2))
        score[..., 1] = _emit(weights, self.flat, shape)
        ahead, back = np.zeros_like(score), np.zeros_like(score)
        ahead[:, 0] = score[:, 0] + first
        for t in range(1, shape[1]):
            ahead[:, t] = np.where(inside[:, t, None], _lse(ahead[:, t - 1, :, None] + moves, 1) + score[:, t], ahead[:, t - 1])
        for t in range(shape[1] - 2, -1, -1):
            back[:, t] = np.where(inside[:, t + 1, None], _lse(moves + (score[:, t + 1] + back[:, t + 1])[:, None, :], 2), 0)
        total = _lse(ahead[:, -1], 1)
        prob = np.exp(ahead + back - total[:, None, None])
        joint = np.exp(ahead[:, :-1, :, None] + moves + (score + back)[:, 1:, None, :] - total[:, None, None, None])
        error = (self.gold - prob[..., 1])[self.page, self.place]
        value = (score[..., 1] * self.gold * inside).sum() + (self.want_moves * moves).sum() + (self.want_first * first).sum() - total.sum()
        return float(value), [
            np.bincount(self.ids, weights=np.repeat(error, self.per_block), minlength=WIDTH),
            self.want_moves - (joint * self.pair[..., None, None]).sum((0, 1)),
            self.want_first - prob[:, 0].sum(0),
        ]


def train(pages: list[list[list[int]]], labels: list[list[int]], rounds: int = 60, rate: float = 0.15, decay: float = 1e-3) -> Crf:
    """Adam on the penalised conditional log-likelihood of all pages at once."""
    weights, moves, first = np.zeros(WIDTH), np.zeros((2, 2)), np.zeros(2)
    groups = [_Group([pages[i] for i in g], [labels[i] for i in g]) for g in _grouped([len(p) for p in pages])]
    if not groups:
        weights[_hash("root")] = 1.0
        return Crf(weights, moves, first)
    number = sum(g.shape[0] for g in groups)
    theta = [weights, moves, first]
    m, v = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    for step in range(1, rounds + 1):
        parts = [group.gradient(*theta)[1] for group in groups]
        for k, g in enumerate([sum(x) for x in zip(*parts)]):
            g = g / number - decay * theta[k]
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            theta[k] += rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    return Crf(*theta)


def decode(model: Crf, scores: list[np.ndarray]) -> list[np.ndarray]:
    """The most likely labels of each page's blocks, given each block's score for the label 1; of equally likely ones, 0 before 1."""
    out = [np.zeros(len(s), np.int64) for s in scores]
    for group in _grouped([len(s) for s in scores]):
        n = np.array([len(scores[i]) for i in group])
        shape = (len(group), int(n.max()))
        score = np.zeros(shape)
        for row, i in enumerate(group):
            score[row, : n[row]] = scores[i]
        rows = np.arange(shape[0])
        best = np.stack([np.full(shape[0], model.first[0]), model.first[1] + score[:, 0]], 1)
        origin = np.zeros((*shape, 2), np.int8)
        for t in range(1, shape[1]):
            way = best[:, :, None] + model.moves
            origin[:, t] = way.argmax(1)
            new = way.max(1)
            new[:, 1] += score[:, t]
            live = t < n
            best[live] = new[live]
        found = np.zeros(shape, np.int64)
        state = best.argmax(1)
        for t in range(shape[1] - 1, -1, -1):
            live = t < n
            found[live, t] = state[live]
            state = np.where(live, origin[rows, t, state], state)
        for row, i in enumerate(group):
            out[i] = found[row, : n[row]]
    return out


def viterbi(model: Crf, pages: list[list[list[int]]]) -> list[np.ndarray]:
    """`decode` of pages given by their blocks' features."""
    return decode(model, [np.array([model.weights[b].sum() for b in p]) for p in pages])


def marked(page: str) -> tuple[list[list[int]], list[int]] | None:
    """Features and labels of a page that marks its content up; None for others."""
    found = blocks(page)
    inside = [int(any(t in CARRIERS for t, _ in b.path)) for b in found]
    return (features(found), inside) if any(inside) and not all(inside) else None


def fit(pages: DataFrame, max_labelled: int = MAX_LABELLED, max_bytes: int = MAX_BYTES) -> Crf:
    """Trains on at most max_labelled marked pages, the first by a hash of their id, as far as they have max_bytes together. Of rows that repeat an id, one counts."""
    some = pages.where("page_id is not null and html is not null and (contains(lower(html), '<article') or contains(lower(html), '<main'))").select("page_id", "html", F.octet_length("html").alias("size"))
    first = some.select("page_id", "size", F.xxhash64("page_id", F.lit(SEED)).alias("h")).orderBy("h", "page_id", "size").limit(max_labelled).groupBy("page_id", "h").agg(F.min("size").alias("size"))
    so_far = Window.orderBy("h", "page_id").rowsBetween(Window.unboundedPreceding, 0)  # over max_labelled rows
    chosen = first.withColumn("bytes", F.sum(F.col("size").cast("long")).over(so_far)).where(F.col("bytes") <= max_bytes).select("page_id", "size")
    rows = some.join(F.broadcast(chosen), ["page_id", "size"]).groupBy("page_id").agg(F.min("html").alias("html")).orderBy("page_id").collect()
    both = [x for x in (marked(r.html) for r in rows) if x]
    return train([x for x, _ in both], [y for _, y in both])


def extract(pages: DataFrame, model: Crf | None = None) -> DataFrame:
    """(page_id, text, blocks, kept): the content blocks of each page, a line each. Rows pass by one at a time: no shuffle."""
    small_batches(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(fit(pages) if model is None else model)
    id_type = dict(pages.dtypes)["page_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "html", 1 << 20):
                found = [blocks(x) if x else [] for x in part.column("html").to_pylist()]
                labels = decode(shared.value, [emissions(shared.value.weights, b) for b in found])
                empty = [not x for x in part.column("html").to_pylist()]
                text = [None if e else "\n".join(x.text for x, y in zip(b, l) if y) for e, b, l in zip(empty, found, labels)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), pa.array(text, pa.string()), pa.array([len(b) for b in found], pa.int32()), pa.array([int(l.sum()) for l in labels], pa.int32())],
                    names=["page_id", "text", "blocks", "kept"],
                )

    return pages.select("page_id", "html").mapInArrow(run, f"page_id {id_type}, text string, blocks int, kept int")
