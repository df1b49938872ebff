"""Media columns: payloads stored losslessly as MPEG transport streams.

A stream is PAT, PMT, then packetized elementary stream (PES) packets of one
private-data program.  Each PES packet holds up to PES_BYTES of the payload and
has a timestamp; its first transport packet is marked as a random-access point
and carries a clock reference in the adaptation field.  Reading parses the
program tables with their CRC, checks every continuity counter, reassembles the
PES packets, and returns the payload with (timestamp, byte position of the
random-access point) of each.

A payload is the text in UTF-8 followed by bytes 0 up to a positive multiple of
UNIT bytes.  Null and empty texts are UNIT zero bytes.  Repeated rows are stored
once each, and equal texts give equal bytes.  A media value that can't be read
raises ValueError.  An empty table gives an empty result.  Extra columns are
ignored."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNIT = 64
PACKET = 188
SYNC = 0x47
PMT_PID, DATA_PID, PROGRAM = 0x1000, 0x0100, 1
PRIVATE_STREAM, PRIVATE_TYPE = 0xBD, 0x06
PES_BYTES = 16_384
#: Clock ticks (90 kHz) between two PES packets.
TICKS = 3_600
COLUMNS = "doc_id long, n_bytes long, media binary"
FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"

_CRC = []
for _i in range(256):
    _c = _i << 24
    for _ in range(8):
        _c = ((_c << 1) ^ 0x04C11DB7 if _c & 0x80000000 else _c << 1) & 0xFFFFFFFF
    _CRC.append(_c)


def section_crc(data: bytes) -> int:
    """CRC-32 of program-specific information (most significant bit first, no final inversion)."""
    crc = 0xFFFFFFFF
    for b in data:
        crc = ((crc << 8) & 0xFFFFFFFF) ^ _CRC[(crc >> 24) ^ b]
    return crc


def _section(table_id: int, number: int, body: bytes) -> bytes:
    head = struct.pack(">BHHBBB", table_id, 0xB000 | (5 + len(body) + 4), number, 0xC1, 0, 0)
    return head + body + struct.pack(">I", section_crc(head + body))


def _table_packet(pid: int, section: bytes) -> bytes:
    packet = struct.pack(">BHB", SYNC, 0x4000 | pid, 0x10) + b"\x00" + section
    return packet + b"\xff" * (PACKET - len(packet))


_PAT = _table_packet(0, _section(0, 1, struct.pack(">HH", PROGRAM, 0xE000 | PMT_PID)))
_PMT = _table_packet(PMT_PID, _section(2, PROGRAM, struct.pack(">HH", 0xE000 | DATA_PID, 0xF000) + struct.pack(">BHH", PRIVATE_TYPE, 0xE000 | DATA_PID, 0xF000)))


def _timestamp(value: int) -> bytes:
    """33 bits in five bytes with marker bits."""
    return bytes([0x21 | (value >> 29) & 0x0E, value >> 22 & 0xFF, 0x01 | (value >> 14) & 0xFE, value >> 7 & 0xFF, 0x01 | (value << 1) & 0xFE])


def _clock(value: int) -> bytes:
    """Program clock reference: 33 bits of 90 kHz base, 6 reserved, extension 0."""
    return struct.pack(">IH", value >> 1 & 0xFFFFFFFF, (value & 1) << 15 | 0x7E00)


def write_stream(payload: bytes) -> bytes:
    out, counter = [_PAT, _PMT], 0
    for k, at in enumerate(range(0, len(payload), PES_BYTES)):
        part, pts = payload[at : at + PES_BYTES], k * TICKS
        pes = b"\x00\x00\x01" + struct.pack(">BHBBB", PRIVATE_STREAM, len(part) + 8, 0x84, 0x80, 5) + _timestamp(pts) + part
        pos = 0
        while pos < len(pes):
            field_ = bytes([0x50]) + _clock(pts) if pos == 0 else b""  # random access, clock reference
            room = PACKET - 4 - (len(field_) + 1 if field_ else 0)
            left = len(pes) - pos
            if left < room:  # stuffing in the adaptation field
                if not field_:
                    need = PACKET - 4 - left - 1
                    field_ = b"" if need == 0 else b"\x00" + b"\xff" * (need - 1)
                    control, lead = 0x30, bytes([len(field_)]) + field_
                else:
                    field_ += b"\xff" * (room - left)
                    control, lead = 0x30, bytes([len(field_)]) + field_
                take = left
            else:
                control, lead, take = (0x30, bytes([len(field_)]) + field_, room) if field_ else (0x10, b"", room)
            out.append(struct.pack(">BHB", SYNC, (0x4000 if pos == 0 else 0) | DATA_PID, control | counter) + lead + pes[pos : pos + take])
            pos, counter = pos + take, (counter + 1) & 15
    return b"".join(out)


@dataclass
class Stream:
    payload: bytes = b""
    programs: dict[int, int] = field(default_factory=dict)  # elementary PID -> stream type
    points: list[tuple[int, int]] = field(default_factory=list)  # (timestamp, position of the packet) of random-access points
    packets: int = 0
    clocks: int = 0


def _read_section(body: bytes) -> bytes:
    at = 1 + body[0]
    size = struct.unpack_from(">H", body, at + 1)[0] & 0x0FFF
    section = body[at : at + 3 + size]
    if section_crc(section) != 0:
        raise ValueError("a program table's checksum is wrong")
    return section


def read_stream(media: bytes) -> Stream:
    """Parses tables, checks continuity, reassembles and returns the payload."""
    if len(media) % PACKET:
        raise ValueError("not a whole number of packets")
    out, tables, counters = Stream(packets=len(media) // PACKET), {0}, {}
    parts: list[bytes] = []
    open_: list[bytes] = []

    def close() -> None:
        if not open_:
            return
        pes = b"".join(open_)
        open_.clear()
        if pes[:3] != b"\x00\x00\x01" or struct.unpack_from(">H", pes, 4)[0] != len(pes) - 6:
            raise ValueError("a PES packet is incomplete")
        parts.append(pes[9 + pes[8] :])

    for at in range(0, len(media), PACKET):
        if media[at] != SYNC:
            raise ValueError("lost synchronization")
        pid, flags, start = (media[at + 1] & 0x1F) << 8 | media[at + 2], media[at + 3], media[at + 1] & 0x40
        body, random = at + 4, False
        if flags & 0x20:
            size = media[body]
            if size:
                random = bool(media[body + 1] & 0x40)
                out.clocks += media[body + 1] >> 4 & 1
            body += 1 + size
        if not flags & 0x10:
            continue
        if pid in counters and counters[pid] != flags & 15:
            raise ValueError(f"a packet of PID {pid} is missing")
        counters[pid] = (flags & 15) + 1 & 15
        content = media[body : at + PACKET]
        if pid == 0:
            section = _read_section(content)
            for k in range(8, len(section) - 4, 4):
                number, table = struct.unpack_from(">HH", section, k)
                if number:
                    tables.add(table & 0x1FFF)
        elif pid in tables:
            section = _read_section(content)
            k = 12 + (struct.unpack_from(">H", section, 10)[0] & 0x0FFF)
            while k < len(section) - 4:
                kind, elementary, more = struct.unpack_from(">BHH", section, k)
                out.programs[elementary & 0x1FFF] = kind
                k += 5 + (more & 0x0FFF)
        elif pid in out.programs:
            if start:
                close()
                if random and content[7] & 0x80:
                    t = content[9:14]
                    out.points.append(((t[0] >> 1 & 7) << 30 | t[1] << 22 | (t[2] >> 1) << 15 | t[3] << 7 | t[4] >> 1, at))
            open_.append(content)
    close()
    out.payload = b"".join(parts)
    return out


def padded(text: str | None) -> tuple[int, bytes]:
    raw = (text or "").encode()
    return len(raw), raw + bytes(-len(raw) % UNIT if raw else UNIT)


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, column = batch.column("doc_id"), batch.column("text")
        for a in range(0, batch.num_rows, 512):
            rows = [padded(t) for t in column.slice(a, 512).to_pylist()]
            yield pa.RecordBatch.from_arrays([ids.slice(a, 512), pa.array([n for n, _ in rows], pa.int64()), pa.array([write_stream(p) for _, p in rows], pa.binary())], names=["doc_id", "n_bytes", "media"])


def describe(stream: Stream) -> str:
    pid, kind = next(iter(stream.programs.items()))
    last = stream.points[-1] if stream.points else (0, 0)
    return f"ts:pid={pid},type={kind},packets={stream.packets},pes={len(stream.points)},clocks={stream.clocks},last_pts={last[0]},last_access={last[1]}"


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, digests, tails, stored, hashes, features = [], [], [], [], [], []
        for item in batch.column("media"):
            media = item.as_py()
            stream = read_stream(media)
            sizes.append(len(stream.payload))
            digests.append(hashlib.sha256(stream.payload).hexdigest())
            tails.append(zlib.crc32(stream.payload[-UNIT:]))
            stored.append(len(media))
            hashes.append(hashlib.sha256(media).hexdigest())
            features.append(describe(stream))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_bytes"), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), pa.array(tails, pa.int64()),
             pa.array(stored, pa.int64()), pa.array(hashes, pa.string()), pa.array(features, pa.string())],
            names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"],
        )


def store_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes (of the text) and media (its transport stream) of every text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_store, COLUMNS)


def media_features(media: DataFrame) -> DataFrame:
    """Reads stored media back: payload and stored sizes and digests, and a description of the stream."""
    return media.select("doc_id", "n_bytes", "media").mapInArrow(_features, FEATURES)
