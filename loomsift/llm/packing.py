"""Sum-of-squares online packing of documents into windows of fixed length.

The state is one array: how many open windows are filled to each level. A
document goes to the level (or a new window) at which the sum of the squared
counts is least afterwards, which keeps the levels even and leaves few gaps.
Ties go to the fullest level, and within a level to the window opened last.

Documents come in the order of their ids within shards by a hash of the id.
The number of shards follows the number of documents, so that each is packed
by one task; what sharding costs is the open windows left in each shard.

A length is the UTF-8 bytes of the text and one end mark, the exact count of a
byte-level vocabulary, or what `length` says. A document longer than a window
is cut: whole windows of it stand alone, the rest is packed.

Defined results:
* A null text isn't packed; an empty text is its end mark alone.
* Repeated rows are packed each on its own. A null doc_id comes last.
* Rows of one id stand in the order of their lengths; those that tie are alike
  here. A document of any length fills as many windows as it needs.
* An empty table gives no rows. Other columns play no part, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 8192
PER_SHARD = 50_000


class Levels:
    """The level array and the open windows of each level."""

    def __init__(self, window: int):
        self.window, self.opened = window, 0
        self.counts = np.zeros(window + 1, np.int64)
        self.open: dict[int, list[int]] = {}

    def new(self) -> int:
        self.opened += 1
        return self.opened - 1

    def place(self, size: int) -> tuple[int, int]:
        """The window for a document of the given size (1 to window - 1), and its offset there."""
        room = self.window - size
        # change of the sum of squares / 2, up to a constant; a window that is then full leaves the array
        change = (self.counts[size:] - self.counts[: room + 1]).astype(np.float64)
        change[room] = -self.counts[room] - 0.5
        change[0] = self.counts[size] - 0.5
        change[1:][self.counts[1 : room + 1] == 0] = np.inf
        level = room - int(change[::-1].argmin())
        if level:
            at = self.open[level].pop()
            self.counts[level] -= 1
        else:
            at = self.new()
        if level + size < self.window:
            self.open.setdefault(level + size, []).append(at)
            self.counts[level + size] += 1
        return at, level


def pack_lengths(lengths: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(document, window, start in the window, start in the document, length) for each piece, documents in order."""
    state, out = Levels(window), []
    for i, n in enumerate(lengths.tolist()):
        at = 0
        while n - at >= window:
            out.append((i, state.new(), 0, at, window))
            at += window
        if n > at:
            w, start = state.place(n - at)
            out.append((i, w, start, at, n - at))
    return tuple(np.array(out, np.int64).reshape(-1, 5).T)


def pack(docs: DataFrame, window: int = WINDOW, per_shard: int = PER_SHARD, length: Column | None = None) -> DataFrame:
    """(window_id, doc_id, start, doc_start, length) for each piece of a document. window_id holds the shard in its upper 32 bits."""
    if window < 2:
        raise ValueError("a window holds two units at least")
    length = F.octet_length(docs["text"]).cast("long") + 1 if length is None else length.cast("long")
    sized = docs.select("doc_id", length.alias("n")).where("n > 0")
    shards = max(1, -(-sized.count() // per_shard))
    id_type = dict(docs.dtypes)["doc_id"]

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("doc_id", "ascending"), ("n", "ascending")])
        doc, at, start, inside, n = pack_lengths(rows.column("n").to_numpy(), window)
        return pa.table({
            "window_id": pa.array((key[0].as_py() << 32) + at), "doc_id": rows.column("doc_id").take(pa.array(doc)),
            "start": pa.array(start.astype(np.int32)), "doc_start": pa.array(inside), "length": pa.array(n.astype(np.int32)),
        })

    # a number of partitions of its own, which adaptive plans leave alone: lengths are few bytes, but a shard is much work
    spread = sized.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards))).repartition(2 * shards, "shard")
    return spread.groupBy("shard").applyInArrow(run, f"window_id long, doc_id {id_type}, start int, doc_start long, length int")
