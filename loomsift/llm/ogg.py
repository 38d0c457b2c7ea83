"""Ogg in a media column: pages, packets, logical streams and times.

`demux` reads a binary column. Pages are found by their capture pattern and
count only if their checksum holds; after damage, reading goes on at the next
good page. Packets are put together from the lacing values, over page borders
where the continuation flag and the page numbers say so, and each logical
stream is known by its serial number.

A page's granule position is where the last packet that ends on it ends. The
packets before it are placed backward from there by their own durations: from
the TOC byte of Opus, the block sizes of Vorbis (with the modes of its setup
header), the frame headers of FLAC, the frames a packet of Speex, and a frame a
packet of Theora. A stream's last page may end before its packets do, and is
placed forward from the page before. The stream's first packet says how granules
turn into seconds.

Defined results:
* A null or empty value, or one without a good page, gives no packet; nor does
  an empty table.
* A damaged page is left out; a packet that had a part on it (or on a page that
  is missing) isn't reported, and `gap` is true for the next packet of its
  stream. What follows the last complete packet isn't reported.
* An unknown codec, or a granule of -1, gives no time; a packet before one whose
  duration can't be told has none either. Header packets are at granule 0.
* Repeated rows are each reported, and a null key as null; keys may have any
  type. A serial number that begins again counts as a new link.
* Packets and files of any length count as a whole; a value is held in memory.
* A key column named like a column of the result gets "_" appended there. Other
  columns play no part, whatever their names.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from .state import small_batches

CONTINUED, BEGIN, END = 1, 2, 4
_HEADER = struct.Struct("<4sBBqIIIB")
_MIRROR = bytes(int(f"{b:08b}"[::-1], 2) for b in range(256))


def checksum(page: bytes) -> int:
    """Ogg's CRC (polynomial 04c11db7, most significant bit first, from 0), by way of zlib's mirrored one."""
    mirrored = zlib.crc32(page.translate(_MIRROR), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(mirrored.to_bytes(4, "little").translate(_MIRROR), "big")


def pages(data: bytes) -> Iterator[tuple[int, int, int, int, bytes, int, int]]:
    """(flags, granule, serial, number, lacing values, start of body, end of body) of each page whose checksum holds."""
    at = data.find(b"OggS")
    while at >= 0:
        if at + 27 <= len(data):
            _, version, flags, granule, serial, number, crc, n = _HEADER.unpack_from(data, at)
            lacing = data[at + 27 : at + 27 + n]
            end = at + 27 + n + sum(lacing)
            if version == 0 and len(lacing) == n and end <= len(data):
                page = data[at:end]
                if checksum(page[:22] + b"\0\0\0\0" + page[26:]) == crc:
                    yield flags, granule, serial, number, lacing, at + 27 + n, end
                    at = end if data.startswith(b"OggS", end) else data.find(b"OggS", end)
                    continue
        at = data.find(b"OggS", at + 1)


def _opus_samples(packet: bytes) -> int | None:
    """The duration of an Opus packet at 48 kHz, from its first two bytes."""
    if not packet:
        return None
    config, code = packet[0] >> 3, packet[0] & 3
    frame = (480, 960, 1920, 2880)[config & 3] if config < 12 else (480, 960)[config & 1] if config < 16 else (120, 240, 480, 960)[config & 3]
    if code == 3 and len(packet) < 2:
        return None
    return frame * (1, 2, 2, packet[1] & 63 if code == 3 else 0)[code]


def _vorbis_modes(setup: bytes) -> list[int] | None:
    """Whether each mode has long blocks. Modes stand at the end of the setup header, 41 bits each, behind their number less one."""
    bits = int.from_bytes(setup, "little")
    end = bits.bit_length() - 1  # the framing bit
    field = lambda at, n: bits >> at & (1 << n) - 1
    flags: list[int] = []
    found = None
    while end - 41 * (len(flags) + 1) - 6 >= 0 and len(flags) < 64:
        at = end - 41 * (len(flags) + 1)
        if field(at + 1, 32):  # window and transform types are 0
            break
        flags.insert(0, field(at, 1))
        if field(at - 6, 6) + 1 == len(flags):
            found = list(flags)
    return found


def _flac_samples(packet: bytes) -> int | None:
    """The block size in a FLAC frame's header."""
    code = packet[2] >> 4
    if code == 1:
        return 192
    if 2 <= code <= 5:
        return 576 << code - 2
    if code >= 8:
        return 256 << code - 8
    if code in (6, 7):
        lead = 8 - (packet[4] ^ 0xFF).bit_length()  # the frame's number is coded as in UTF-8
        at = 4 + max(1, lead)
        own = packet[at : at + code - 5]
        return int.from_bytes(own, "big") + 1 if len(own) == code - 5 else None
    return None


class _Clock:
    """A codec, from the first packet of its stream: the seconds of a granule position, and the durations of packets."""

    def __init__(self, head: bytes):
        self.codec, self.rate, self.skip, self.shift = "unknown", 0.0, 0, None
        self.blocks, self.modes, self.before, self.frame = (0, 0), None, None, 0
        if head.startswith(b"OpusHead") and len(head) >= 19:
            self.codec, self.rate, self.skip = "opus", 48000.0, struct.unpack_from("<H", head, 10)[0]
        elif head.startswith(b"\x01vorbis") and len(head) >= 16:
            self.codec, self.rate = "vorbis", float(struct.unpack_from("<I", head, 12)[0])
            if len(head) >= 29:
                self.blocks = 1 << (head[28] & 15), 1 << (head[28] >> 4)
        elif head.startswith(b"Speex   ") and len(head) >= 40:
            self.codec, self.rate = "speex", float(struct.unpack_from("<I", head, 36)[0])
            if len(head) >= 68:
                self.frame = struct.unpack_from("<I", head, 56)[0] * max(1, struct.unpack_from("<I", head, 64)[0])
        elif head.startswith(b"\x7fFLAC") and len(head) >= 31:
            self.codec, self.rate = "flac", float(int.from_bytes(head[27:30], "big") >> 4)
        elif head.startswith(b"\x80theora") and len(head) >= 42:
            num, den = struct.unpack_from(">II", head, 22)
            self.codec, self.rate, self.shift = "theora", num / den if den else 0.0, (struct.unpack_from(">H", head, 40)[0] >> 5) & 31

    def samples(self, packet: bytes, number: int) -> int | None:
        """The granules that a packet lasts, 0 for headers; None where that can't be told. Packets come in order."""
        if self.codec == "opus":
            return 0 if number == 0 or packet.startswith(b"OpusTags") else _opus_samples(packet)
        if self.codec == "vorbis":
            if packet[:1] and packet[0] & 1:
                if packet.startswith(b"\x05vorbis"):
                    self.modes = _vorbis_modes(packet)
                return 0
            if not packet:
                return 0
            if self.blocks[0] == self.blocks[1]:
                size = self.blocks[0]
            elif self.modes:
                mode = packet[0] >> 1 & (1 << (len(self.modes) - 1).bit_length()) - 1
                size = self.blocks[self.modes[mode]] if mode < len(self.modes) else None
            else:
                size = None
            last, self.before = self.before, size
            return None if size is None else 0 if last is None else (last + size) // 4
        if self.codec == "flac":
            return _flac_samples(packet) if len(packet) > 4 and packet[0] == 0xFF and packet[1] >> 2 == 0x3E else 0
        if self.codec == "speex":
            return 0 if number < 2 else self.frame or None
        if self.codec == "theora":
            return 0 if packet[:1] and packet[0] & 0x80 else 1
        return None

    def place(self, granule: int) -> int:
        """A granule position as a number of samples or frames."""
        return granule if self.shift is None else (granule >> self.shift) + (granule & ((1 << self.shift) - 1))

    def seconds(self, place: int) -> float | None:
        if place < 0 or not self.rate:
            return None
        return max(0, place - self.skip) / self.rate


class _Stream:
    def __init__(self, link: int):
        self.link, self.clock, self.next_page, self.packets, self.parts, self.gap = link, None, None, 0, None, False
        self.end: int | None = None  # of the page before


def _places(sizes: list[int | None], end: int, before: int | None) -> list[int | None]:
    """Where each packet of a page ends: backward from the page's end, or, on a last page (before is given), forward and no further than its end."""
    if before is not None and None not in sizes:
        return [*[min(end, before + x) for x in accumulate(sizes)][:-1], end]
    out: list[int | None] = [end]
    for size in reversed(sizes[1:]):
        out.append(None if size is None or out[-1] is None else max(0, out[-1] - size))
    return out[::-1]


def packets(data: bytes) -> Iterator[tuple[int, int, str, int, bytes, int | None, float | None, bool]]:
    """(serial, link, codec, number, packet, granule, seconds, gap) of each complete packet, in the order in which they end. granule is in samples or frames, for all packets of a page."""
    streams: dict[int, _Stream] = {}
    for flags, granule, serial, number, lacing, at, _ in pages(data):
        stream = streams.get(serial)
        if stream is None or flags & BEGIN:
            stream = streams[serial] = _Stream(stream.link + 1 if stream else 0)
        lost = stream.next_page is not None and number != stream.next_page
        stream.next_page = (number + 1) & 0xFFFFFFFF
        if lost or stream.parts is not None and not flags & CONTINUED:
            stream.parts, stream.gap, stream.end = None, True, None
        # the rest of a packet whose beginning is missing
        skipping = bool(flags & CONTINUED) and stream.parts is None
        ended: list[bytes] = []
        begin, end = at, at
        for value in lacing:
            end += value
            if value < 255:
                if skipping:
                    skipping, stream.gap = False, True
                else:
                    ended.append(b"".join([*(stream.parts or ()), data[begin:end]]))
                stream.parts, begin = None, end
        if lacing and lacing[-1] == 255 and not skipping:
            stream.parts = [*(stream.parts or ()), data[begin:end]]
        if not ended:
            continue
        if stream.clock is None:
            stream.clock = _Clock(ended[0] if stream.packets == 0 and not stream.gap else b"")
        clock = stream.clock
        places: list[int | None] = [None] * len(ended)
        sizes = [clock.samples(p, stream.packets + i) for i, p in enumerate(ended)]
        if granule >= 0:
            last = clock.place(granule)
            places = _places(sizes, last, stream.end if flags & END else None)
            stream.end = last
        else:
            stream.end = None
        for packet, own in zip(ended, places):
            yield serial, stream.link, clock.codec, stream.packets, packet, own, None if own is None else clock.seconds(own), stream.gap
            stream.packets += 1
            stream.gap = False


def page(flags: int, granule: int, serial: int, number: int, lacing: bytes, body: bytes) -> bytes:
    blank = _HEADER.pack(b"OggS", 0, flags, granule, serial, number, 0, len(lacing)) + lacing + body
    return blank[:22] + struct.pack("<I", checksum(blank)) + blank[26:]


class Writer:
    """A logical stream. Pages close when their body reaches `fill` bytes or their lacing table is full."""

    def __init__(self, serial: int, fill: int = 4096):
        self.serial, self.fill, self.number, self.granule = serial, fill, 0, -1
        self.lacing, self.body, self.continued = bytearray(), bytearray(), False

    def packet(self, data: bytes, granule: int) -> bytes:
        """The pages that close while this packet is written."""
        out = b""
        whole, rest = divmod(len(data), 255)
        at = 0
        for value in [255] * whole + [rest]:
            if len(self.lacing) == 255:
                out += self.flush(open_packet=at > 0)
            self.lacing.append(value)
            self.body += data[at : at + value]
            at += value
        self.granule = granule
        return out + (self.flush() if len(self.body) >= self.fill else b"")

    def flush(self, open_packet: bool = False, end: bool = False) -> bytes:
        if not self.lacing and not end:
            return b""
        flags = CONTINUED * self.continued | BEGIN * (self.number == 0) | END * end
        made = page(flags, self.granule, self.serial, self.number, bytes(self.lacing), bytes(self.body))
        self.number += 1
        self.lacing, self.body, self.continued, self.granule = bytearray(), bytearray(), open_packet, -1
        return made


def opus_head(skip: int = 312) -> bytes:
    return struct.pack("<8sBBHIhB", b"OpusHead", 1, 2, skip, 48000, 0, 0)


def vorbis_head(rate: int = 44100) -> bytes:
    return struct.pack("<7sIBIiiiBB", b"\x01vorbis", 0, 2, rate, 0, 0, 0, 0xBB, 1)  # all blocks have 2,048 samples


#: What an Opus packet of 20 ms and a Vorbis audio packet of mode 0 begin with.
AUDIO = b"\x98", b"\x00"


def text_as_media(text: str, serial: int) -> bytes:
    """A text as an Ogg file of two multiplexed streams: its lines, each behind a byte that makes it audio, are packets, in turn of the one and the other."""
    first, second = Writer(serial), Writer(serial ^ 0x80000000)
    out = [first.packet(opus_head(), 0), first.flush(), second.packet(vorbis_head(), 0), second.flush()]
    for i, line in enumerate(text.split("\n")):
        stream, length = ((first, 960), (second, 1024))[i % 2]
        out.append(stream.packet(AUDIO[i % 2] + line.encode(), (i // 2 + 1 - i % 2) * length))
    return b"".join([*out, first.flush(end=True), second.flush(end=True)])


def media_table(docs: DataFrame) -> DataFrame:
    """(doc_id, media): each document's text as an Ogg file; null for a null text."""
    small_batches(docs.sparkSession)
    id_type = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100)
                ids, texts = part.column("doc_id").to_pylist(), part.column("text").to_pylist()
                media = [None if t is None else text_as_media(t, zlib.crc32(repr(i).encode()) & 0x7FFFFFFF) for i, t in zip(ids, texts)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(media, pa.binary())], names=["doc_id", "media"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, media binary")


def demux(media: DataFrame, key: str = "doc_id", column: str = "media", payload: bool = False) -> DataFrame:
    """(key, serial, link, codec, packet, bytes, md5, granule, seconds, gap) for each complete packet, and its bytes as `payload` if asked for. Rows pass by one at a time: no shuffle."""
    small_batches(media.sparkSession)
    key_type = dict(media.dtypes)[key]
    kinds = {"serial": "long", "link": "int", "codec": "string", "packet": "int", "bytes": "int", "md5": "string", "granule": "long", "seconds": "double", "gap": "boolean"}
    if payload:
        kinds["payload"] = "binary"
    name = key
    while name.lower() in kinds:
        name += "_"
    schema = ", ".join([f"`{name}` {key_type}", *[f"{c} {k}" for c, k in kinds.items()]])
    arrow = [{"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary()}[k] for k in kinds.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out, size = [], [], 0

            def flush(batch=batch) -> pa.RecordBatch:
                columns = list(zip(*out)) or [()] * len(arrow)
                made = pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *[pa.array(c, k) for c, k in zip(columns, arrow)]], names=[name, *kinds])
                rows.clear(), out.clear()
                return made

            for i, value in enumerate(batch.column(1)):
                for serial, link, codec, number, packet, granule, seconds, gap in packets(value.as_py() or b""):
                    rows.append(i)
                    out.append((serial, link, codec, number, len(packet), hashlib.md5(packet).hexdigest(), granule, seconds, gap, *([packet] if payload else [])))
                    size += len(packet) if payload else 100
                    if size > 4 << 20:
                        yield flush()
                        size = 0
            yield flush()

    return media.select(key, column).mapInArrow(run, schema)
