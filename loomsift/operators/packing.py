"""Tokenise, join, cut into contexts of equal length, shuffle and write."""

from __future__ import annotations

import gzip
import io
import json
import re
import tarfile
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..session import checkpoints

END_OF_TEXT = 0
CONTEXT = 2049


def tokenize(df: DataFrame, tokenizer_file: str, text: str = "text", name: str = "tokens", pattern: str | None = None) -> DataFrame:
    """Adds token ids. The file is a `tokenizers` JSON, a `sentencepiece` model, or `tiktoken` ranks with their pattern; it is loaded once per task. A null text has null ids."""

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = encoder(tokenizer_file, pattern)
        for a in texts:
            ids = [None if t is None else np.asarray(encode(t), np.int32) for t in a.to_pylist()]
            off = np.concatenate([[0], np.cumsum([0 if x is None else len(x) for x in ids])]).astype(np.int32)
            values = np.concatenate([np.zeros(0, np.int32), *[x for x in ids if x is not None]])
            yield pa.ListArray.from_arrays(pa.array(off, pa.int32(), mask=np.array([*[x is None for x in ids], False])), pa.array(values))

    run.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return df.withColumn(name, F.arrow_udf(run, "array<int>")(F.col(text)))


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str | None = None):
    """A function from a text to token ids. Strings of special tokens are ordinary text."""
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True
        return _by_ranks(t) or (lambda s: t.encode(s, add_special_tokens=False).ids)
    if path.endswith(".model"):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=path).encode
    if path.endswith(".tiktoken"):
        import base64

        import tiktoken

        if pattern is None:
            raise ValueError("tiktoken ranks need the pattern that cuts words")
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    raise ValueError(f"unknown kind of tokenizer: {path}")


#: Texts of these characters only are cut by another engine of regexes; what newer versions of Unicode may change isn't among them.
_PLAIN = r"[\0-\u024f\u2010-\u2027\u2030-\u205e\u20a0-\u20bf\u2200-\u22ff\u2500-\u257f]*"
_PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


def _by_ranks(t):
    """The same ids by tiktoken, in a fifth of the time, for byte-level BPE; None for other tokenizers.

    tiktoken joins any two neighbours that make a token, in the order of ids, and
    not only the pair that the merges list. Neighbours that make a token c have
    come about within c alone, so both are the same if ids follow the merges and
    each token, alone, is encoded as itself. That is tested here.
    """
    spec = json.loads(t.to_str())
    cut, model = spec.get("pre_tokenizer") or {}, spec["model"]
    plain = not any(spec.get(x) for x in ("normalizer", "truncation", "padding", "post_processor")) and all(x["special"] for x in spec["added_tokens"])
    bytewise = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
    odd = any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    if not (plain and bytewise and model.get("type") == "BPE") or odd:
        return None
    import tiktoken

    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in shown)}
    vocab, merges = model["vocab"], [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
    made = [vocab.get(a + b, -1) for a, b in merges]
    if made != sorted(set(made)) or len(vocab) != 256 + len(merges) or any(c not in vocab or vocab[c] > made[0] for c in byte_of) or not all(len(t.model.tokenize(a + b)) == 1 for a, b in merges):
        return None
    ranks = {bytes(byte_of[c] for c in x): i for x, i in vocab.items()}
    ok, fast = re.compile(_PLAIN), tiktoken.Encoding("own", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return lambda s: fast(s) if s.isascii() or ok.fullmatch(s) else t.encode(s, add_special_tokens=False).ids


def end_marked(df: DataFrame, tokens: str = "tokens", end: int = END_OF_TEXT, begin: int | None = None) -> DataFrame:
    """The end token after each document, and a begin token before it if there is one."""
    parts = [F.array(F.lit(begin))] * (begin is not None) + [F.col(tokens), F.array(F.lit(end))]
    return df.withColumn(tokens, F.concat(*parts))


def running_sum(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Adds the sum of value over all rows that come before in the order of keys, which should tell rows apart.

    Rows are range partitioned and written down with their partition's number;
    sums of whole partitions, as many as there are partitions, are broadcast.
    No task sees more than its range.
    """
    checkpoints(df.sparkSession)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *keys).withColumn("_p", F.spark_partition_id()).checkpoint()
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("_p").agg(F.sum(value).alias("_s")).select("_p", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_b"))
    inside = Window.partitionBy("_p").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    return ranged.join(F.broadcast(sums), "_p").withColumn(name, F.col("_b") + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop("_p", "_b")


def contexts(df: DataFrame, shard: str, order: str, tokens: str = "tokens", length: int = CONTEXT, pad: int = -1, all_pad: bool = False) -> DataFrame:
    """(shard, context, tokens, n_tokens): the documents of each shard end to end, cut every `length` tokens; the rest is padded.

    A running sum over lengths alone gives each document its place, however
    large a shard is; it is then cut at context borders by expressions, and
    pieces meet again by context. Documents that tie in the order stand by a
    hash of their tokens. all_pad adds a context of padding to a shard that
    comes out even.
    """
    rows = df.where(F.col(tokens).isNotNull() & (F.size(tokens) > 0)).select(shard, order, F.col(tokens).alias("t"), F.xxhash64(tokens).alias("h"), F.coalesce(F.col(shard).cast("string"), F.lit("")).alias("s"), F.col(order).isNotNull().alias("o1"))
    sizes = rows.groupBy("s", shard, "o1", order, "h").agg(F.first(F.size("t")).cast("long").alias("n"), F.count("*").alias("times")).withColumn("all", F.col("n") * F.col("times"))
    placed = running_sum(sizes, ["s", "o1", order, "h"], "all", "at")
    starts = placed.groupBy("s", F.col(shard).isNull().alias("null")).agg(F.min("at").alias("start"), F.sum("all").alias("total"))
    placed = placed.withColumn("null", F.col(shard).isNull()).join(starts, ["s", "null"])
    placed = placed.select(F.col("s").alias("s2"), F.col("null").alias("null2"), F.col(order).alias("order2"), F.col("h").alias("h2"), "n", "times", (F.col("at") - F.col("start")).alias("at"))
    same = (F.col("s") == F.col("s2")) & (F.col(shard).isNull() == F.col("null2")) & F.col(order).eqNullSafe(F.col("order2")) & (F.col("h") == F.col("h2"))
    met = rows.join(placed, same)
    copy = F.row_number().over(Window.partitionBy("s", "h", "null2", order).orderBy(F.lit(0))) - 1
    at = met.withColumn("at", F.col("at") + F.col("n") * copy)
    first, last = F.floor(F.col("at") / length), F.floor((F.col("at") + F.col("n") - 1) / length)
    cut = at.withColumn("context", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("context") * length - F.col("at"), F.lit(0))
    stop = F.least((F.col("context") + 1) * length - F.col("at"), F.col("n"))
    pieces = cut.select(shard, "context", (F.col("at") + begin).alias("at"), F.slice("t", (begin + 1).cast("int"), (stop - begin).cast("int")).alias("piece"))
    joined = pieces.groupBy(shard, "context").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "piece"))), lambda x: x["piece"])).alias("t"))
    if all_pad:
        ends = sizes.groupBy(shard).agg(F.sum("all").alias("n")).where(F.col("n") % length == 0)
        joined = joined.unionByName(ends.select(shard, (F.col("n") / length).cast("long").alias("context"), F.array().cast("array<int>").alias("t")))
    return joined.select(shard, "context", F.concat("t", F.array_repeat(F.lit(pad), F.lit(length) - F.size("t"))).alias("tokens"), F.size("t").alias("n_tokens"))


def shuffled(ctx: DataFrame, seed: int = 0, per_chunk: int = 8192) -> DataFrame:
    """(chunk, place, tokens): contexts in an order by seeded hash, in chunks. Ranks come from a running count over hashes; nothing is sorted by one task."""
    ids = [c for c in ctx.columns if c != "tokens"]
    keyed = ctx.withColumn("h", F.xxhash64(*ids, "tokens", F.lit(seed)))
    ranks = running_sum(keyed.groupBy("h").agg(F.count("*").alias("times")), ["h"], "times", "i")
    ranked = keyed.join(ranks.drop("times"), "h").withColumn("i", F.col("i") + F.row_number().over(Window.partitionBy("h").orderBy(F.lit(0))) - 1)
    return ranked.select(F.floor(F.col("i") / per_chunk).alias("chunk"), (F.col("i") % per_chunk).cast("int").alias("place"), "tokens")


def manifest(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy(F.format_string("shard_%08d", F.col("chunk")).alias("shard")).agg(F.count("*").alias("num_sequences"))


def filesystem(uri: str):
    """The file system of a path or URI, and the path in it."""
    from pyarrow import fs

    if "://" not in uri:
        return fs.LocalFileSystem(), uri.rstrip("/")
    scheme, _, rest = uri.partition("://")
    system, path = fs.FileSystem.from_uri(f"s3://{rest}" if scheme in ("s3a", "s3n") else uri)
    return system, path.rstrip("/")


def write_tars(chunks: DataFrame, folder: str) -> DataFrame:
    """Writes each chunk as a tar of gzipped JSON arrays to a folder that all executors share (a path or a URI, of an object store too); returns (shard, num_sequences). A retried task writes the same file again."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        import uuid

        name = f"shard_{key[0].as_py():08d}"
        rows = rows.sort_by("place")
        raw = io.BytesIO()
        with tarfile.open(fileobj=raw, mode="w") as tar:
            for i, tokens in enumerate(rows.column("tokens").to_pylist()):
                data = gzip.compress(json.dumps(tokens).encode(), mtime=0)
                info = tarfile.TarInfo(f"{key[0].as_py():08d}_{i:08d}.json.gz")
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
        fs, base = filesystem(folder)
        fs.create_dir(base, recursive=True)
        part = f"{base}/.{name}-{uuid.uuid4().hex}"
        with fs.open_output_stream(part) as f:
            f.write(raw.getvalue())
        fs.move(part, f"{base}/{name}.tar")
        return pa.table({"shard": [name], "num_sequences": pa.array([rows.num_rows], pa.int64())})

    return chunks.groupBy("chunk").applyInArrow(run, "shard string, num_sequences bigint")


def read_tars(spark, folder: str) -> DataFrame:
    """(shard, place, tokens) of a folder of such tars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, raw in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                with tarfile.open(fileobj=io.BytesIO(raw)) as tar:
                    found = [json.loads(gzip.decompress(tar.extractfile(m).read())) for m in tar]
                shard = path.rsplit("/", 1)[-1].removesuffix(".tar")
                yield pa.record_batch({"shard": pa.array([shard] * len(found)), "place": pa.array(range(len(found)), pa.int32()), "tokens": pa.array(found, pa.list_(pa.int32()))})

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.tar").load(folder).select("path", "content").mapInArrow(run, "shard string, place int, tokens array<int>")


def sample_by_source(df: DataFrame, rates: DataFrame, key: str, source: str = "source", seed: int = 0) -> DataFrame:
    """Rows of each source at its rate; sources without a rate go. rates: (source, rate)."""
    return df.join(rates, source).where(tx.draw(F.col(key), seed) < F.col("rate")).drop("rate")
