"""Texts as Ogg media: pages with checksums, lacing, two logical streams, timestamps from granule positions.

``to_ogg`` stores each payload as 8-bit PCM samples (a stream with PCM headers) beside a small stream that
holds the payload's unpadded length. ``from_ogg`` reads any such file back: it verifies every page's checksum,
sorts pages by stream, joins lacing values to packets across pages, and takes times from granule positions.

Nulls: a null text is empty. The payload is padded with zero bytes to a positive multiple of 64. Repeated rows
give equal rows; empty tables give empty results; other columns can be kept with ``keep``, but those with the names of added ones are replaced. A very long
text is one file, written and read as a step of its own. A file that breaks a rule raises ``ValueError``.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import released, steps

RATE = 8000
PACKET = 4096
BLOCK = 64
#: Bytes of texts or files that are worked on at once; a longer one is a step of its own.
SLICE = 4_000_000
CONTINUED, FIRST, LAST = 1, 2, 4
#: A page header without its lacing values: version, flags, granule, serial, sequence, checksum, segments.
HEAD = struct.Struct("<4sBBqIIIB")
PCM = struct.Struct("<8sHHIIBBHI")
NOTE = struct.Struct("<8sQ")
_REVERSED = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))


def checksum(page: bytes) -> int:
    """Ogg's CRC: polynomial 04c11db7, most significant bit first, no inversion. zlib's has the same polynomial
    over reversed bits, with inversion before and after."""
    crc = zlib.crc32(page.translate(_REVERSED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(crc.to_bytes(4, "little").translate(_REVERSED), "big")


class Stream:
    """Writer of one logical stream; ``pages`` cuts packets into pages of at most 255 lacing values."""

    def __init__(self, serial: int):
        self.serial, self.sequence = serial, 0

    def page(self, flags: int, granule: int, lacing: bytes, body: bytes) -> bytes:
        head = HEAD.pack(b"OggS", 0, flags, granule, self.serial, self.sequence, 0, len(lacing))
        crc = checksum(head + lacing + body)
        self.sequence += 1
        return b"".join((head[:22], struct.pack("<I", crc), head[26:], lacing, body))

    def pages(self, packets: list[tuple[bytes, int]], last: bool = False):
        """``packets``: (bytes, granule at its end)."""
        lacing, body, granule, more = bytearray(), [], -1, False
        for k, (data, end) in enumerate(packets):
            values = bytes([255]) * (len(data) // 255) + bytes([len(data) % 255])
            at = 0
            while at < len(values):
                take = min(255 - len(lacing), len(values) - at)
                lacing += values[at : at + take]
                body.append(data[at * 255 : (at + take) * 255])
                at += take
                if at == len(values):
                    granule = end
                if len(lacing) == 255 and not (at == len(values) and k + 1 == len(packets)):
                    yield self.page(CONTINUED * more | FIRST * (self.sequence == 0), granule, bytes(lacing), b"".join(body))
                    lacing, body, granule, more = bytearray(), [], -1, at < len(values)
        flags = CONTINUED * more | FIRST * (self.sequence == 0) | LAST * last
        yield self.page(flags, granule, bytes(lacing), b"".join(body))


def encode(payload: bytes, n_bytes: int) -> bytes:
    """One Ogg file of ``payload`` as 8-bit samples, its serial numbers from its content."""
    serial = zlib.crc32(payload)
    sound, note = Stream(serial), Stream(serial ^ 1)
    header = PCM.pack(b"PCM     ", 0, 0, 1, RATE, 8, 1, PACKET, 0)
    packets = [(payload[i : i + PACKET], min(i + PACKET, len(payload))) for i in range(0, len(payload), PACKET)]
    out = [*sound.pages([(header, 0)]), *note.pages([(NOTE.pack(b"Length\0\0", n_bytes), 0)])]
    vendor = b"8-bit samples"
    out += sound.pages([(struct.pack("<I", len(vendor)) + vendor + struct.pack("<I", 0), 0)])
    out += note.pages([(b"", len(payload))], last=True)
    return b"".join([*out, *sound.pages(packets, last=True)])


def decode(media: bytes) -> dict[int, list[tuple[bytes, int]]]:
    """Packets (bytes, granule of the page that ends it; -1 if none) of each logical stream, by serial number."""
    streams: dict[int, list] = {}
    state: dict[int, list] = {}  # next sequence number, parts of an open packet, ended
    at = 0
    while at < len(media):
        if len(media) - at < HEAD.size:
            raise ValueError("a page header is cut off")
        magic, version, flags, granule, serial, sequence, crc, n = HEAD.unpack_from(media, at)
        lacing = media[at + 27 : at + 27 + n]
        end = at + 27 + n + sum(lacing)
        if magic != b"OggS" or version or len(lacing) < n or end > len(media):
            raise ValueError(f"no whole page at {at}")
        if checksum(b"".join((media[at : at + 22], bytes(4), media[at + 26 : end]))) != crc:
            raise ValueError(f"checksum of the page at {at}")
        if bool(flags & FIRST) != (serial not in state):
            raise ValueError(f"stream {serial} begins twice or never")
        own = state.setdefault(serial, [0, [], False])
        if sequence != own[0] or own[2] or bool(flags & CONTINUED) != bool(own[1]):
            raise ValueError(f"a page of stream {serial} is missing")
        own[0], own[2] = sequence + 1, bool(flags & LAST)
        packets = streams.setdefault(serial, [])
        x, size = at + 27 + n, 0
        ended = []
        for v in lacing:
            size += v
            if v < 255:
                own[1].append(media[x : x + size])
                ended.append(b"".join(own[1]))
                own[1].clear()
                x, size = x + size, 0
        if size or (n and lacing[-1] == 255):
            own[1].append(media[x : x + size])
        # the granule position is that of the last packet that ends on the page
        packets += [(p, -1) for p in ended[:-1]] + [(p, granule) for p in ended[-1:]]
        at = end
    if any(parts or not ended for _, parts, ended in state.values()):
        raise ValueError("a stream has no end")
    return streams


def samples(media: bytes) -> tuple[bytes, int, int, int]:
    """(samples, unpadded length, rate, end granule) of a file of ``encode``."""
    data, n_bytes, rate, end = b"", None, None, 0
    for packets in decode(media).values():
        if packets[0][0].startswith(b"PCM     "):
            rate = PCM.unpack(packets[0][0])[4]
            data, end = b"".join(p for p, _ in packets[2:]), packets[-1][1]
        elif packets[0][0].startswith(b"Length\0\0"):
            n_bytes = NOTE.unpack(packets[0][0])[1]
    if rate is None or n_bytes is None or end != len(data):
        raise ValueError("a stream is missing")
    return data, n_bytes, rate, end


def _map(schema: T.StructType, keep: list[str], source: str, row):
    def run(batches):
        arrow = to_arrow_schema(schema)
        new = list(arrow)[len(keep) :]
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(source)), 0).to_numpy(zero_copy_only=False)
            for i, j in steps(np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))), SLICE):
                part = batch.slice(i, j - i)
                rows = [row(x) for x in part.column(source).to_pylist()]
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), new)] if rows else [pa.array([], f.type) for f in new]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *columns], schema=arrow)

    return released(run)


def _written(text: str | None) -> tuple[bytes]:
    raw = (text or "").encode()
    return (encode(raw + bytes(-len(raw) % BLOCK or (0 if raw else BLOCK)), len(raw)),)


def _read(media: bytes) -> tuple:
    data, n_bytes, rate, end = samples(media)
    x = np.frombuffer(data, np.uint8)
    crossings = int(np.count_nonzero(np.diff((x >= 128).view(np.int8))))
    feature = f"ms={end * 1000 // rate};sum={int(x.sum(dtype=np.int64))};peak={int(x.max())};crossings={crossings}"
    return n_bytes, len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-BLOCK:]), len(media), hashlib.sha256(media).hexdigest(), feature


def to_ogg(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default all) and ``media``: each text as an Ogg file."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != "media"]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("media", T.BinaryType())])
    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(_map(schema, keep, text, _written), schema)


def from_ogg(files: DataFrame, keep: list[str]) -> DataFrame:
    """Lengths, digests and features of what is stored in column ``media``."""
    kinds = (("n_bytes", T.LongType()), ("payload_bytes", T.LongType()), ("payload_sha256", T.StringType()), ("tail_crc32", T.LongType()), ("media_bytes", T.LongType()), ("media_sha256", T.StringType()), ("feature", T.StringType()))
    keep = [c for c in keep if c not in dict(kinds)]
    schema = T.StructType([files.schema[c] for c in keep] + [T.StructField(c, t) for c, t in kinds])
    return files.mapInArrow(_map(schema, keep, "media", _read), schema)


def op8_ogg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return from_ogg(to_ogg(docs, keep=["doc_id"]), keep=["doc_id"])
