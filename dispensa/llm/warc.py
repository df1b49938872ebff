"""WARC archives of pages: written, read back, segments reassembled.

Every page becomes an HTTP response (chunked transfer framing) in a record.
Records longer than a segment are continued: the first record has segment number
1, continuation records name it as WARC-Segment-Origin-ID, and the last one
gives WARC-Segment-Total-Length.  Of pages with equal payloads of at least
min_bytes, that with the largest page_id is stored (response); the others refer
to it (revisit) and keep their HTTP header alone.

Archives are compressed files in the shared folder, written by Spark with the
record separator as line separator and at most RECORDS_PER_FILE records each.
Reading takes them as binary files and parses records by Content-Length.  A
record without continuations is decoded on the spot; segments are grouped by
origin and ordered by segment number, their total length is verified, and the
chunks are decoded.

Null pages are empty payloads.  A null page_id counts as smaller than any other.
Repeated rows of one page_id and payload have the same type: record ids carry a
number that tells rows apart.  An empty table gives an empty result.  Extra columns are
ignored."""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch_path

END = b"\r\n\r\n"
SEGMENT_BYTES = 16_384
CHUNK_BYTES = 4_096
RECORDS_PER_FILE = 1_000
DATE = "2024-01-01T00:00:00Z"
HASHED = "page_id long, url string, payload binary, n long, digest string"
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
PARTS = "origin string, number long, total long, kind string, page_id long, refers_to long, digest string, size long, body binary"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [b"%x\r\n%s\r\n" % (len(payload[a : a + size]), payload[a : a + size]) for a in range(0, len(payload), size)]
    return b"".join(parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """The payload of chunked transfer framing; trailers and chunk extensions are skipped."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        out.append(body[line + 2 : line + 2 + size])
        if len(out[-1]) != size or body[line + 2 + size : line + 4 + size] != b"\r\n":
            raise ValueError("a chunk is incomplete")
        at = line + 4 + size


def record(kind: str, record_id: str, fields: list[tuple[str, object]], block: bytes) -> bytes:
    """One record without the separator after it."""
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", DATE), *fields, ("Content-Length", len(block))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block


def page_id_uri(page: int | None, n: int) -> str:
    return f"urn:page:{'null' if page is None else page}:{n}"


def page_of_uri(uri: str) -> int | None:
    number = uri.strip("<>").split(":")[2]
    return None if number == "null" else int(number)


def page_records(page: int | None, n: int, url: str | None, payload: bytes, refers_to: int | None, refers_n: int | None, revisit: bool) -> list[bytes]:
    """All records of a page: a revisit, or a response and its continuations."""
    me, digest = page_id_uri(page, n), f"sha1:{payload_digest(payload)}"
    target = [("WARC-Target-URI", (url or "").replace("\r", "%0D").replace("\n", "%0A")), ("WARC-Payload-Digest", digest)]
    if revisit:
        http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: %d\r\n\r\n" % len(payload)
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        return [record("revisit", me, [*target, ("WARC-Profile", profile), ("WARC-Refers-To", f"<{page_id_uri(refers_to, refers_n or 0)}>"), ("Content-Type", "application/http; msgtype=response")], http)]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    parts = [http[a : a + SEGMENT_BYTES] for a in range(0, len(http), SEGMENT_BYTES)]
    kind = [("Content-Type", "application/http; msgtype=response")]
    if len(parts) == 1:
        return [record("response", me, [*target, *kind], http)]
    out = [record("response", me, [*target, *kind, ("WARC-Segment-Number", 1)], parts[0])]
    for k, part in enumerate(parts[1:], 2):
        last = [("WARC-Segment-Total-Length", len(http))] if k == len(parts) else []
        out.append(record("continuation", f"{me}:{k}", [("WARC-Segment-Origin-ID", f"<{me}>"), ("WARC-Segment-Number", k), *last], part))
    return out


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields by lower-case name, block) of all records of an archive."""
    at = 0
    while at < len(data):
        end = data.index(END, at)
        version, *lines = data[at:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError("no record where one should begin")
        head = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        size = int(head["content-length"])
        block = data[end + 4 : end + 4 + size]
        if len(block) != size or data[end + 4 + size : end + 8 + size] != END:
            raise ValueError("a record is incomplete")
        yield head, block
        at = end + 8 + size


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        payloads = [(h or "").encode() for h in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(payloads, pa.binary()), batch.column("n"), pa.array([payload_digest(p) for p in payloads], pa.string())],
            names=["page_id", "url", "payload", "n", "digest"],
        )


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("page_id", "n", "url", "payload", "refers_to", "refers_n", "revisit")]
        out = [r for row in zip(*columns, strict=True) for r in page_records(*row)]
        for a in range(0, len(out), 256):
            yield pa.RecordBatch.from_arrays([pa.array(out[a : a + 256], pa.binary())], names=["record"])


def write_archives(pages: DataFrame, min_bytes: int = 0, path: str | None = None) -> str:
    """Writes pages (page_id, url, html) as WARC files and returns their folder."""
    path = path or scratch_path(pages.sparkSession, "warc")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    hashed = rows.withColumn("n", F.monotonically_increasing_id()).mapInArrow(_hash, HASHED)
    long_enough = F.length("payload") >= min_bytes
    # one row per payload that several pages share, summed up before the shuffle
    newest = F.max(F.struct("page_id", "n")).alias("newest")
    shared = hashed.where(long_enough).groupBy("digest").agg(newest, F.count("*").alias("copies")).where("copies > 1")
    marked = hashed.join(shared, "digest", "left")
    revisit = F.col("newest").isNotNull() & long_enough & ~F.col("page_id").eqNullSafe(F.col("newest.page_id"))
    marked = marked.select("page_id", "n", "url", "payload", F.when(revisit, F.col("newest.page_id")).alias("refers_to"), F.when(revisit, F.col("newest.n")).alias("refers_n"), revisit.alias("revisit"))
    text = marked.mapInArrow(_write, "record binary").select(F.col("record").cast("string").alias("value"))
    text.write.option("lineSep", END.decode()).option("maxRecordsPerFile", RECORDS_PER_FILE).text(path, compression="gzip")
    return path


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in PARTS.split(", ")]
    types = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary())
    for batch in batches:
        for item in batch.column("content"):
            rows = []
            for head, block in records(gzip.decompress(item.as_py())):
                kind = head["warc-type"]
                origin = head.get("warc-segment-origin-id", head["warc-record-id"])
                number = int(head.get("warc-segment-number", 0))
                refers = head.get("warc-refers-to")
                total = head.get("warc-segment-total-length")
                digest = head.get("warc-payload-digest", "").removeprefix("sha1:")
                size = None
                if not number:  # complete: only its figures go on
                    size, block = verified(block, digest), b""
                rows.append((origin, number, None if total is None else int(total), kind, page_of_uri(origin), page_of_uri(refers) if refers else None, digest, size, block))
            for a in range(0, len(rows), 256):
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows[a : a + 256]], t) for i, t in enumerate(types)], names=names)


def verified(block: bytes, digest: str) -> int:
    """Payload length of a whole HTTP message whose payload has the digest."""
    payload, size = http_payload(block)
    if payload is not None and payload_digest(payload) != digest:
        raise ValueError("a payload's digest differs")
    return size


def whole(parts: list[tuple[int, int | None, bytes]]) -> bytes:
    """The block of segments (number, total length or None, bytes): ordered, gapless and of the stated length."""
    parts = sorted(parts, key=lambda p: p[0])
    if len(parts) == 1 and parts[0][0] == 0:
        return parts[0][2]
    block = b"".join(p[2] for p in parts)
    if [p[0] for p in parts] != list(range(1, len(parts) + 1)) or parts[-1][1] != len(block):
        raise ValueError("segments are missing, or their total length differs")
    return block


def http_payload(block: bytes) -> tuple[bytes | None, int]:
    """(payload, its length) of an HTTP message; a message without body has only the length it states."""
    head, _, body = block.partition(END)
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(b":") for line in head.split(b"\r\n")[1:])}
    if fields.get(b"transfer-encoding", b"").lower() == b"chunked":
        payload = dechunked(body)
        return payload, len(payload)
    return None, int(fields[b"content-length"])


def _join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by origin and segment number, of which only one origin's are held at a time."""
    held: list[dict] = []

    def close() -> tuple | None:
        if not held:
            return None
        first = held[0]
        size = first["size"] if not first["number"] else verified(whole([(r["number"], r["total"], r["body"]) for r in held]), first["digest"])
        row = (first["page_id"], size, first["digest"], first["kind"], first["refers_to"])
        held.clear()
        return row

    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
    names = [f.split()[0] for f in READ.split(", ")]
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            if held and held[0]["origin"] != row["origin"]:
                out.append(close())
            held.append(row)
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names=names)
    if last := close():
        yield pa.RecordBatch.from_arrays([pa.array([last[k]], t) for k, t in enumerate(types)], names=names)


def read_archives(spark, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every page in the archives of a folder."""
    files = spark.read.format("binaryFile").load(f"{path}/part-*").select("content")
    parts = files.mapInArrow(_parse, PARTS)
    return parts.repartition("origin").sortWithinPartitions("origin", "number").mapInArrow(_join, READ)
