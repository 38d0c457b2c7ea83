"""Web archives (WARC and WET) as tables."""

from __future__ import annotations

import gzip
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.modifiers import html_paragraphs

SCHEMA = "text string, metadata map<string,string>, warcinfo string, source_file string, record int"


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, body) of each record; gzip members are read on after a damaged one."""
    if data[:2] == b"\x1f\x8b":
        out, rest = [], data
        while rest:
            member = zlib.decompressobj(31)
            try:
                out.append(member.decompress(rest) + member.flush())
                rest = member.unused_data
            except zlib.error:
                at = rest.find(b"\x1f\x8b\x08", 1)
                rest = rest[at:] if at > 0 else b""
        data = b"".join(out)
    stream = io.BytesIO(data)
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        headers: dict[str, str] = {}
        while (h := stream.readline()) not in (b"", b"\r\n", b"\n"):
            name, _, value = h.decode("utf-8", "replace").partition(":")
            headers[name.strip()] = value.strip()
        length = headers.get("Content-Length", "")
        if not length.isdigit():
            continue
        yield headers, stream.read(int(length))


def http_body(raw: bytes) -> bytes:
    """The payload of an HTTP response, unzipped if need be."""
    head, mark, body = raw.partition(b"\r\n\r\n")
    if not mark:
        return raw
    low = head.lower()
    if b"transfer-encoding: chunked" in low:
        parts, stream = [], io.BytesIO(body)
        while size := stream.readline().split(b";")[0].strip():
            try:
                n = int(size, 16)
            except ValueError:
                break
            if not n:
                break
            parts.append(stream.read(n))
            stream.readline()
        body = b"".join(parts) or body
    if b"content-encoding: gzip" in low:
        try:
            body = gzip.decompress(body)
        except (OSError, EOFError, zlib.error):
            pass
    return body


def read(spark: SparkSession, path: str, extract: bool = False, kinds: tuple[str, ...] = ("response", "conversion")) -> DataFrame:
    """Records of the given types below a path: text, headers, the file's warcinfo. Bytes that aren't UTF-8 are replaced. extract turns HTML into its paragraphs.

    A file is read by one task, so archives of a GB or so spread well.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                info, rows, seen = None, [], 0
                for headers, body in records(data):
                    kind = headers.get("WARC-Type")
                    if kind == "warcinfo":
                        info = body.decode("utf-8", "replace")
                    elif kind in kinds:
                        text = (http_body(body) if kind == "response" else body).decode("utf-8", "replace")
                        rows.append(("\n\n".join(html_paragraphs(text)) if extract and kind == "response" else text, list(headers.items()), info, name, seen))
                        seen += 1
                    if len(rows) == 500:
                        yield batch(rows)
                        rows = []
                if rows:
                    yield batch(rows)

    def batch(rows: list) -> pa.RecordBatch:
        kinds_ = (pa.string(), pa.map_(pa.string(), pa.string()), pa.string(), pa.string(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds_)], names=["text", "metadata", "warcinfo", "source_file", "record"])

    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content").mapInArrow(run, SCHEMA)


def with_url(df: DataFrame) -> DataFrame:
    return df.withColumn("url", F.element_at("metadata", "WARC-Target-URI"))
