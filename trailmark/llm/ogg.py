"""Media columns: Ogg containers (RFC 3533) written to and read from binary columns.

Reading verifies each page's checksum and sequence number, reassembles packets from lacing values across pages,
demultiplexes the logical streams by serial number, and turns granule positions into time.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Payloads are padded with spaces to a positive multiple of this many bytes, one frame of samples.
FRAME = 192
#: Bytes of a packet (frames of one stream), samples a second, and the serial numbers of the two streams.
PACKET, RATE, SERIALS = 25 * FRAME, 8000, (1, 2)
#: Each stream's first packet: magic, samples a second.
HEAD = struct.Struct("<8sI")
MAGIC = b"rawpcm8 "
#: How the first packets of streams begin.
HEADS = {"pcm8": MAGIC, "opus": b"OpusHead", "vorbis": b"\x01vorbis", "flac": b"\x7fFLAC"}

_PAGE = struct.Struct("<4sBBqIIIB")
_REVERSED = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))


def checksum(page: bytes) -> int:
    """CRC-32 with polynomial 0x04C11DB7, unreflected, from 0: zlib's on bit-reversed bytes, reversed."""
    crc = zlib.crc32(page.translate(_REVERSED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(crc.to_bytes(4, "big").translate(_REVERSED), "little")


def _page(serial: int, number: int, flags: int, granule: int, lacing: bytes, body: bytes) -> bytes:
    head = _PAGE.pack(b"OggS", 0, flags, granule, serial, number, 0, len(lacing))
    raw = head + lacing + body
    return raw[:22] + struct.pack("<I", checksum(raw)) + raw[26:]


def pages(serial: int, packets: list[tuple[bytes, int]]) -> Iterator[bytes]:
    """Pages of one logical stream from (packet, granule position at its end); the first packet has a page to itself."""
    number, at = 0, 0
    lacing, body, granule, cont = bytearray(), bytearray(), -1, False
    for k, (packet, position) in enumerate(packets):
        last = k == len(packets) - 1
        values = b"\xff" * (len(packet) // 255) + bytes([len(packet) % 255])
        at = 0
        for i, v in enumerate(values):
            lacing.append(v)
            body += packet[at : at + v]
            at += v
            ends = i == len(values) - 1
            if ends:
                granule = position
            if len(lacing) == 255 or ends and (k == 0 or last):
                flags = cont * 1 | (number == 0) * 2 | (last and ends) * 4
                yield _page(serial, number, flags, granule, bytes(lacing), bytes(body))
                number, cont = number + 1, not ends
                lacing, body, granule = bytearray(), bytearray(), -1


def encode(payload: bytes) -> bytes:
    """8-bit samples as an Ogg file: packets of 25 frames, dealt in turn to two logical streams whose pages alternate."""
    pieces = [payload[i : i + PACKET] for i in range(0, len(payload), PACKET)]
    streams, at = {s: [(HEAD.pack(MAGIC, RATE), 0)] for s in SERIALS}, 0
    for k, x in enumerate(pieces):
        at += len(x)
        streams[SERIALS[k % len(SERIALS)]].append((x, at))
    made = [list(pages(s, p)) for s, p in streams.items()]
    return b"".join(m[i] for i in range(max(map(len, made))) for m in made if i < len(m))


@dataclass
class Stream:
    """One logical stream: whole packets with the granule position of the page on which each ends (-1: not given)."""

    serial: int
    packets: list[bytes] = field(default_factory=list)
    granules: list[int] = field(default_factory=list)
    pages: int = 0
    ended: bool = False
    partial: bytes = b""

    @property
    def codec(self) -> str:
        """What the first packet says the stream is: pcm8 (this module's own), opus, vorbis, flac, or empty."""
        head = self.packets[0] if self.packets else b""
        return next((name for name, magic in HEADS.items() if head.startswith(magic)), "")

    @property
    def rate(self) -> int:
        """Granules a second, from the identification header; 0 if it isn't known."""
        head, codec = self.packets[0] if self.packets else b"", self.codec
        if codec == "opus":
            return 48000  # whatever the input's rate was
        if codec == "flac" and len(head) >= 30:
            return int.from_bytes(head[27:30], "big") >> 4  # after 9 bytes of mapping, "fLaC" and a block's head: 20 bits
        if codec == "vorbis" and len(head) >= 16:
            return int.from_bytes(head[12:16], "little")
        return HEAD.unpack(head[: HEAD.size])[1] if codec == "pcm8" and len(head) >= HEAD.size else 0

    @property
    def headers(self) -> int:
        """Packets before the first one of media; FLAC says how many follow its first."""
        head, codec = self.packets[0] if self.packets else b"", self.codec
        return {"pcm8": 1, "opus": 2, "vorbis": 3, "flac": 1 + int.from_bytes(head[7:9], "big") if len(head) >= 9 else 1}.get(codec, 0)

    @property
    def skipped(self) -> int:
        """Granules before time 0: Opus streams begin with so many that aren't played."""
        return int.from_bytes(self.packets[0][10:12], "little") if self.codec == "opus" and len(self.packets[0]) >= 12 else 0

    def times(self) -> list[float]:
        """The time at the end of each packet of media in seconds; empty without a rate or granules.

        Granules are known where a packet ends a page; those between two such ends are shared out evenly by packets, and
        those after the last known one keep its time.
        """
        known = [(0, 0), *((k + 1, g) for k, g in enumerate(self.granules[self.headers :]) if g >= 0)]
        if not self.rate or len(known) == 1:
            return []
        out: list[float] = []
        for (a, x), (b, y) in zip(known, known[1:]):
            out += [(x + (y - x) * (k - a) / (b - a) - self.skipped) / self.rate for k in range(a + 1, b + 1)]
        return out + out[-1:] * (len(self.packets) - self.headers - len(out))

    @property
    def seconds(self) -> float:
        """Time at the end of the stream."""
        return max(self.times(), default=0.0)


def decode(data: bytes) -> dict[int, Stream]:
    """The logical streams by serial number; ValueError for a bad capture pattern, checksum, page number or continuation."""
    streams: dict[int, Stream] = {}
    at = 0
    while at < len(data):
        if len(data) - at < _PAGE.size:
            raise ValueError("page header cut short")
        mark, version, flags, granule, serial, number, crc, n = _PAGE.unpack_from(data, at)
        if mark != b"OggS" or version:
            raise ValueError(f"no page at byte {at}")
        lacing = data[at + _PAGE.size : at + _PAGE.size + n]
        body = at + _PAGE.size + n
        end = body + sum(lacing)
        raw = data[at:end]
        if len(lacing) < n or end > len(data) or checksum(raw[:22] + b"\0\0\0\0" + raw[26:]) != crc:
            raise ValueError(f"bad checksum of the page at byte {at}")
        s = streams.setdefault(serial, Stream(serial))
        if bool(flags & 2) != (s.pages == 0) or number != s.pages or bool(flags & 1) != bool(s.partial) or s.ended:
            raise ValueError(f"page at byte {at} does not follow stream {serial}")
        s.pages, s.ended = s.pages + 1, bool(flags & 4)
        done = []
        for v in lacing:
            s.partial += data[body : body + v]
            body += v
            if v < 255:
                done.append(s.partial)
                s.partial = b""
        s.packets += done
        s.granules += [-1] * (len(done) - 1) + [granule] * bool(done)
        at = end
    if any(not s.ended or s.partial for s in streams.values()):
        raise ValueError("a stream has no last page")
    return streams


def payload(streams: dict[int, Stream]) -> bytes:
    """The samples of ``encode``: data packets taken from the streams in turn."""
    bodies = [streams[s].packets[1:] for s in sorted(streams)]
    return b"".join(b[i] for i in range(max(map(len, bodies), default=0)) for b in bodies if i < len(b))


def padded(text: str | None) -> bytes:
    raw = (text or "").encode()
    return raw + b" " * (max(FRAME, -(-len(raw) // FRAME) * FRAME) - len(raw))


def to_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, media) for every row: its text as an Ogg file; null texts count as empty. Equal texts, equal files.

    Repeated rows, null and repeated ids are rows of their own. Only the named columns are read; an empty table stays empty.
    """
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 512):
                part = b.slice(k, 512)
                texts = part.column(1).to_pylist()
                sizes = pa.array([len((t or "").encode()) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), sizes, pa.array([encode(padded(t)) for t in texts], pa.binary())], names=schema.names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def read_media(media: DataFrame, id_col: str = "id", media_col: str = "media") -> DataFrame:
    """The rows of ``media`` with what their files hold.

    payload (samples read back, in packets taken from the streams in turn), streams, packets, pages, first_time and
    seconds (ends of the earliest packet and of the last one), widest_gap (the longest time that one packet spans) and
    error. A null or damaged file gives null in all of these but ``error``, which says what is wrong; times are 0 where
    no stream tells its rate. Columns of ``media`` with one of these names are replaced, all others carried. Repeated
    rows and null ids come back as they are; an empty table stays empty.
    """
    more = [
        ("payload", T.BinaryType()), ("streams", T.IntegerType()), ("packets", T.IntegerType()), ("pages", T.IntegerType()), ("first_time", T.DoubleType()), ("seconds", T.DoubleType()),
        ("widest_gap", T.DoubleType()), ("error", T.StringType()),
    ]
    media = media.drop(*(n for n, _ in more))
    at = media.columns.index(media_col)
    schema = T.StructType([*media.schema.fields, *(T.StructField(n, t) for n, t in more)])
    types = [pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.string()]

    def read(data: bytes | None) -> tuple:
        try:
            s = decode(data) if data is not None else {}
            if not s:
                raise ValueError("no media")
            ends = [t for x in s.values() if (t := x.times())]
            gaps = [b - a for t in ends for a, b in zip([0.0, *t], t)]
            times = min((t[0] for t in ends), default=0.0), max((t[-1] for t in ends), default=0.0), max(gaps, default=0.0)
            return payload(s), len(s), sum(len(x.packets) for x in s.values()), sum(x.pages for x in s.values()), *times, None
        except ValueError as e:
            return (None,) * (len(more) - 1) + (str(e),)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = list(zip(*map(read, b.column(at).to_pylist()))) or [()] * len(more)
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(g, t) for g, t in zip(got, types))], names=schema.names)

    return media.mapInArrow(run, schema)


def digest(read: DataFrame) -> DataFrame:
    """The digest columns of ``read_media`` over ``to_media``, for every row; a damaged file has nulls in those read back."""
    tail = F.expr("substring(payload, -16, 16)")
    feature = F.concat_ws(" ", F.format_string("streams=%d packets=%d pages=%d first=%.6f seconds=%.6f gap=%.6f", "streams", "packets", "pages", "first_time", "seconds", "widest_gap"))
    return read.select(
        F.col("id").alias("doc_id"), "n_bytes", F.length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(tail).alias("tail_crc32"), F.length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), feature.alias("feature"),
    )


def digest_of(text: str | None) -> tuple:
    """One text's digest columns, without Spark."""
    raw, body = len((text or "").encode()), padded(text)
    media = encode(body)
    assert payload(decode(media)) == body
    return raw, len(body), hashlib.sha256(body).hexdigest(), zlib.crc32(body[-16:]), len(media), hashlib.sha256(media).hexdigest()
