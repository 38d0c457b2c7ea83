"""Reversible line dedup over the whole corpus.

A line is kept where it occurs first (by batch, then doc_id, then place in the
text) and goes from everywhere else. The state of a `LineStore` is

* postings: every occurrence (line hash, document, place), a folder per batch,
* refs: exact counts of occurrences for each line hash, as deltas by shard,
* filters: for each shard of hashes a cuckoo filter of the lines present.

A new batch probes the filters of its shards first; only the lines that may be
present are joined with the exact counts, of their shards alone. It then appends
its postings and counts, and puts its fresh lines into the filters: nothing that
is in the store is written again, until many deltas are made one.
Deleting documents appends negative counts, takes lines that reach zero out of
the filters, and hands each line to its next holder: the state is then what it
would be had the documents never come.

Defined results:
* Blank lines (spaces, tabs, carriage returns) are no lines: they always stay.
* A document that loses every line it had goes; an empty, blank or null text
  loses nothing and stays as it is. A null doc_id sorts after all others.
* Rows that repeat both doc_id and text are one document: one row stays (the
  first by the remaining columns), the others go. A doc_id with several texts
  is several documents, in the order of the texts' hashes.
* Lines and texts of any length count as a whole. Ids may have any atomic type.
  An empty table gives no rows.
* Other columns pass through untouched, whatever their names.
"""

from __future__ import annotations

import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .cuckoo import CuckooFilter
from .state import cut, release, remove, shared_dir, small_batches

BLANK = r"^[ \t\r]*$"
KEYS = ["hi", "lo"]
WHO = ["none", "doc", "th"]
PER_SHARD = 250_000
_FILTER = "shard int, filter binary"


def _some(kind: str) -> Column:
    """Any value of an atomic type."""
    if kind.startswith(("array", "map", "struct", "variant", "interval")):
        raise TypeError(f"doc_id can't be a {kind}")
    return F.lit("1970-01-01" if kind.startswith(("date", "timestamp")) else "0" if kind != "boolean" else "false").cast(kind)


def _who(docs: DataFrame) -> list[Column]:
    """Three columns without nulls that say which document a row is."""
    return [docs["doc_id"].isNull().alias("none"), F.coalesce(docs["doc_id"], _some(dict(docs.dtypes)["doc_id"])).alias("doc"), F.xxhash64(docs["text"]).alias("th")]


def occurrences(docs: DataFrame) -> DataFrame:
    """(hi, lo, none, doc, th, pos) for every line that isn't blank; repeated rows count once each."""
    line = docs.select(*_who(docs), F.posexplode(F.split(docs["text"], "\n")).alias("pos", "line")).where(~F.col("line").rlike(BLANK))
    return line.select(F.xxhash64("line").alias("hi"), F.xxhash64(F.lit(0x5EED), "line").alias("lo"), *WHO, "pos")


def counted(lines: DataFrame) -> DataFrame:
    """For each line its first occurrence and how many there are; combines before the shuffle, so a hot line is no hot task."""
    return lines.groupBy(*KEYS).agg(F.min(F.struct(*WHO, "pos")).alias("first"), F.count("*").alias("n"))


def later(lines: DataFrame, seen: DataFrame) -> DataFrame:
    """For each document the places of its lines that occurred before; seen: (hi, lo, first or null)."""
    hit = lines.join(seen, KEYS)
    out = hit.where(F.col("first").isNull() | (F.struct(*WHO, "pos") > F.col("first")))
    return out.groupBy(*WHO).agg(F.collect_set("pos").alias("gone"))


def _without(texts: pa.Array, gone: pa.Array) -> pa.Array:
    """Texts without the lines at the given places; null where no line is left that isn't blank."""
    out = []
    for text, places in zip(texts.to_pylist(), gone.to_pylist()):
        if text is None or places is None:
            out.append(None)
            continue
        drop = set(places)
        left = [x for i, x in enumerate(text.split("\n")) if i not in drop]
        out.append("\n".join(left) if any(x.strip(" \t\r") for x in left) else None)
    return pa.array(out, pa.string())


def _fresh(df: DataFrame, *names: str) -> list[str]:
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name in taken:
            name += "_"
        out.append(name)
    return out


def strip(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs without the lines that `later` names. One shuffle of the texts, shared by the window and the join."""
    small_batches(docs.sparkSession)
    names = _fresh(docs, "ld_none", "ld_doc", "ld_th", "ld_row", "ld_gone", "ld_text")
    none, doc, th, row, places, text = names
    keyed = docs.select("*", *[c.alias(n) for c, n in zip(_who(docs), (none, doc, th))])
    kinds = dict(docs.dtypes)
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text") and not kinds[c].startswith(("map", "variant"))]
    w = Window.partitionBy(none, doc, th).orderBy(*others, F.lit(0))
    right = gone.select(F.col("none").alias(none), F.col("doc").alias(doc), F.col("th").alias(th), F.col("gone").alias(places))
    blank = F.col("text").isNull() | ~F.col("text").rlike(r"[^ \t\r\n]")
    joined = keyed.withColumn(row, F.row_number().over(w)).where((F.col(row) == 1) | blank).join(right, [none, doc, th], "left")
    touched = F.col(places).isNotNull()
    rebuilt = joined.withColumn(text, F.arrow_udf(_without, "string")(F.when(touched, F.col("text")), F.col(places)))
    kept = rebuilt.where(~touched | F.col(text).isNotNull())
    return kept.select(*[(F.when(touched, F.col(text)).otherwise(F.col("text")).alias(c) if c == "text" else F.col(f"`{c}`")) for c in docs.columns])


def _power(n: int) -> int:
    """The next power of two."""
    return 1 << max(0, int(n) - 1).bit_length()


def _hash(table: pa.Table) -> np.ndarray:
    return table.column("hi").to_numpy().astype(np.int64).view(np.uint64)


def _build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    made = CuckooFilter.of(_hash(table), room=table.num_rows // 2)
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "filter": pa.array([made.to_bytes()], pa.binary())})


def _probe(key: tuple[pa.Scalar, ...], keys: pa.Table, filters: pa.Table) -> pa.Table:
    """The keys that may be in the shard's filter."""
    own = keys.select(KEYS)
    if not filters.num_rows:
        return own.slice(0, 0)
    found = CuckooFilter.from_bytes(filters.column("filter")[0].as_py()).contains(_hash(own))
    return own.filter(pa.array(found))


def _update(key: tuple[pa.Scalar, ...], changes: pa.Table, filters: pa.Table) -> pa.Table:
    """The shard's filter with keys put in (n > 0) and taken out (n < 0); rebuilt from nothing only by `_build`."""
    made = CuckooFilter.from_bytes(filters.column("filter")[0].as_py()) if filters.num_rows else CuckooFilter(max(64, changes.num_rows * 3 // 2))
    h, n = _hash(changes), changes.column("n").to_numpy()
    made.delete(h[n < 0])
    full = not made.insert(h[n > 0])
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "filter": pa.array([None if full else made.to_bytes()], pa.binary())})


class LineStore:
    """The state, in a folder that all executors share. A change appends a delta; the deltas of the counts become one when there are many, or when shards have grown."""

    def __init__(self, spark: SparkSession, path: str, per_shard: int = PER_SHARD, deltas: int = 8):
        self.spark, self.path, self.per_shard, self.most = spark, path.rstrip("/"), per_shard, deltas
        self.version = self.generation = self.shards = self.lines = self.deltas = 0
        self.id_type, self.deletions = "long", 0

    def _read(self, name: str, schema: str, there: int) -> DataFrame:
        if not there:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    @property
    def postings(self) -> DataFrame:
        """Every occurrence that hasn't been deleted since."""
        rows = self._read("postings", f"hi long, lo long, none boolean, doc {self.id_type}, th long, pos int, batch int", self.version)
        if not self.deletions:
            return rows
        out = self._read("deleted", f"none boolean, doc {self.id_type}, version int", 1).alias("d")
        return rows.alias("p").join(out, F.expr("p.none = d.none AND p.doc = d.doc AND p.batch <= d.version"), "left_anti")

    def _counts(self) -> DataFrame:
        return self._read(f"refs{self.generation}", "hi long, lo long, n long, version int, shard int", self.deltas)

    @property
    def refs(self) -> DataFrame:
        return self._counts().groupBy(*KEYS).agg(F.sum("n").alias("n")).where("n > 0")

    @property
    def filters(self) -> DataFrame:
        return self._read(f"filters{self.generation}", "filter binary, shard int", self.deltas)

    def _shard(self) -> Column:
        return F.pmod("lo", F.lit(max(1, self.shards))).cast("int").alias("shard")

    def may_have(self, keys: DataFrame) -> DataFrame:
        """Those of the (hi, lo) that the filters don't rule out."""
        left = keys.select(*KEYS, self._shard()).groupBy("shard")
        return left.cogroup(self.filters.select("shard", "filter").groupBy("shard")).applyInArrow(_probe, "hi long, lo long")

    def _present(self, keys: DataFrame) -> DataFrame:
        """(hi, lo, n) of those of the keys that are in the store; only their shards' counts are read."""
        wanted = keys.select(*KEYS, self._shard())
        return self._counts().join(wanted, ["shard", *KEYS], "left_semi").groupBy(*KEYS).agg(F.sum("n").alias("n")).where("n > 0")

    def add(self, docs: DataFrame) -> DataFrame:
        """Adds docs as one batch; for each document the places of its lines that are in the store or came earlier in the batch."""
        kind = dict(docs.dtypes)["doc_id"]
        if not self.version:
            self.id_type = kind
        elif kind != self.id_type:
            raise TypeError(f"the store's ids are {self.id_type}, not {kind}")
        lines = occurrences(docs)
        new = cut(counted(lines))
        number = new.count()
        if not self.shards:
            self.shards = _power(-(-2 * number // self.per_shard))
        if self.deltas:
            known = cut(self._present(self.may_have(new)).select(*KEYS))
            told = cut(new.join(known.withColumn("old", F.lit(True)), KEYS, "left"))
            number -= known.count()
        else:
            told = new.withColumn("old", F.lit(None).cast("boolean"))
        seen = told.where("n > 1 or old").select(*KEYS, F.when(F.col("old").isNull(), F.col("first")).alias("first"))
        gone = cut(later(lines, seen))
        lines.write.parquet(f"{self.path}/postings/batch={self.version + 1}")
        self._change(new.select(*KEYS, "n"), told.where("old is null").select(*KEYS, F.lit(1).alias("n")), number)
        return gone

    def insert(self, docs: DataFrame) -> DataFrame:
        """Adds docs as one batch, and returns them without the lines that are in the store or came earlier in the batch."""
        return strip(docs, self.add(docs))

    def delete(self, doc_ids: DataFrame) -> None:
        """Takes out every document whose id is in the column doc_id; ids that are absent change nothing."""
        ids = cut(doc_ids.select(F.col("doc_id").isNull().alias("none"), F.coalesce(F.col("doc_id").cast(self.id_type), _some(self.id_type)).alias("doc")).distinct())
        minus = cut(self.postings.join(ids, ["none", "doc"], "left_semi").groupBy(*KEYS).agg((-F.count("*")).alias("n")))
        zero = cut(self._present(minus).withColumnRenamed("n", "had").join(minus, KEYS).where("had + n <= 0").select(*KEYS, F.lit(-1).alias("n")))
        ids.withColumn("version", F.lit(self.version)).write.mode("append").parquet(f"{self.path}/deleted")
        self.deletions += 1
        self._change(minus, zero, -zero.count())

    def _change(self, delta: DataFrame, keys: DataFrame, number: int) -> None:
        """Appends counts, and puts keys into the filters of their shards (n > 0) or takes them out; filters of other shards stay as they are."""
        self.version += 1
        delta.select(*KEYS, F.col("n").cast("long").alias("n"), self._shard()).repartition("shard").write.partitionBy("shard").parquet(f"{self.path}/refs{self.generation}/version={self.version}")
        old = self.filters.select("shard", "filter")
        self.deltas += 1
        self.lines += number
        changes = keys.select("hi", "n", self._shard())
        made = cut(changes.groupBy("shard").cogroup(old.join(changes.select("shard").distinct(), "shard", "left_semi").groupBy("shard")).applyInArrow(_update, _FILTER))
        full = made.where("filter is null").select("shard")
        if self.deltas > self.most or self.lines > 2 * self.shards * self.per_shard:
            self._compact()
        else:
            if not full.isEmpty():
                again = self._counts().join(full, "shard", "left_semi").groupBy("shard", *KEYS).agg(F.sum("n").alias("n")).where("n > 0").select("hi", "shard")
                made = cut(made.where("filter is not null").unionByName(again.groupBy("shard").applyInArrow(_build, _FILTER)))
            made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(f"{self.path}/filters{self.generation}")

    def _compact(self) -> None:
        """One table of counts, in as many shards as the lines ask for, and fresh filters."""
        now, before = self.refs, self.generation
        self.shards = max(self.shards, _power(-(-2 * self.lines // self.per_shard)))
        now.select(*KEYS, "n", self._shard()).repartition("shard").write.partitionBy("shard").parquet(f"{self.path}/refs{before + 1}/version={self.version}")
        self.generation, self.deltas = before + 1, 1
        self._counts().select("hi", "shard").groupBy("shard").applyInArrow(_build, _FILTER).write.partitionBy("shard").parquet(f"{self.path}/filters{self.generation}")
        for name in ("refs", "filters"):
            remove(self.spark, f"{self.path}/{name}{before}")

    def drop(self) -> None:
        """Deletes the state; what insert returned doesn't read it."""
        remove(self.spark, self.path)
        self.version = self.shards = self.deltas = self.lines = self.deletions = 0

    def view(self, docs: DataFrame) -> DataFrame:
        """docs, which were all inserted, as they stand now: each line only at its first holder still present."""
        at = F.struct("batch", *WHO, "pos")
        rows = self.postings
        first = rows.groupBy(*KEYS).agg(F.min(at).alias("first"), F.count("*").alias("n")).where("n > 1").select(*KEYS, "first")
        gone = rows.join(first, KEYS).where(at > F.col("first")).groupBy(*WHO).agg(F.collect_set("pos").alias("gone"))
        return strip(docs, cut(gone))


def new_store(spark: SparkSession) -> LineStore:
    """An empty store in the cluster's shared folder."""
    return LineStore(spark, f"{shared_dir(spark).rstrip('/')}/lines-{uuid.uuid4().hex}")


def dedup_lines(docs: DataFrame, batches: int = 3) -> DataFrame:
    """docs without repeated lines.

    They come into an empty store batch by batch, in ranges of doc_id (all at
    once, if ids aren't numbers); the last batch is then deleted and comes
    again, which leaves what one batch of all would leave. The store is dropped
    at the end.
    """
    store = new_store(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]
    parts = [docs]
    if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal"):
        at = docs.agg(F.percentile_approx("doc_id", [k / batches for k in range(1, batches)], 1000).alias("at")).first().at if batches > 1 else []
        edges = [None, *sorted(set(at or [])), None]
        parts = [docs.where((F.lit(True) if a is None else F.col("doc_id") > F.lit(a)) & (F.lit(True) if b is None else F.col("doc_id") <= F.lit(b)) | (F.col("doc_id").isNull() if b is None else F.lit(False))) for a, b in zip(edges, edges[1:])]
    try:
        gone = [store.add(p) for p in parts]
        if len(parts) > 1:
            store.delete(parts[-1].select("doc_id"))
            gone[-1] = store.add(parts[-1])
        return strip(docs, reduce(DataFrame.unionByName, gone))
    finally:
        store.drop()
        release(docs.sparkSession)


SQL = r"""
WITH lines AS (
  SELECT doc_id, text, unnest(generate_series(1, len(string_split(text, chr(10))))) AS pos FROM documents
), cut AS (
  SELECT doc_id, pos, string_split(text, chr(10))[pos] AS line FROM lines
), ranked AS (
  SELECT doc_id, pos, line, NOT regexp_matches(line, '^[ \t\r]*$') AS solid,
         row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) AS rn FROM cut
)
SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text
FROM ranked WHERE rn = 1 OR NOT solid
GROUP BY doc_id
HAVING bool_or(solid) OR doc_id NOT IN (SELECT doc_id FROM ranked WHERE solid)
"""
