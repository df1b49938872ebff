"""Removal of lines that other documents hold already.

Method: sharded minimal perfect hash.  Documents are handled in chunks.  Each
chunk offers its distinct line hashes, each with the smallest and the largest
document holding it, to the hashes' shards.  A shard builds a minimal perfect
hash over the distinct hashes that several documents hold and publishes the
compact arrays it indexes: fingerprint, count of documents and smallest
document.  Documents then probe these arrays: a chunk's hashes come to the
arrays of their shards (which grow with the corpus and can't be sent to every
document), the fingerprint rejects lines that aren't shared, and one bit per
hash goes back, with the owner of those that are.  A chunk knows its hashes'
order, so neither lines nor their hashes return or are joined.

A line's key is the line without [\\x20\\x09-\\x0D] at both ends, with A-Z in
lower case.  Keys are told apart by two hashes of 64 bits: one is the place in
the arrays, the other the fingerprint; keys that agree in the first alone are
kept beside the arrays.

Shards grow in number with the input (SHARD_BYTES of text each).  A chunk has a
row for each shard that one of its lines belongs to: a few hundred hashes per row
at tens of gigabytes, and never more rows than lines.

Null and empty texts are one empty line.  Repeated rows of one doc_id count as
one document.  Rows without doc_id take no part and keep all their lines.  An
empty table gives an empty result.  Columns not named in `keep` are left out;
of those named like the operator's own, the operator's stay."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as V
from .common import chunk_count, input_bytes, materialize, with_chunk

U = np.uint64
OFFERS = "chunk int, shard int, keys binary, prints binary, low binary, high binary"
ARRAYS = "shard int, sizes binary, bits binary, rest binary, prints binary, counts binary, owners binary, twins binary"
ANSWERS = "chunk int, shard int, shared binary, owners binary"
#: Bytes of text whose lines one shard holds.
SHARD_BYTES = 64 << 20
#: Bits a key of the perfect hash's first levels: larger is faster to build, smaller is more compact.
GAMMA = 2.0
LEVELS = 40


class MinimalPerfectHash:
    """Maps n distinct 64-bit keys to 0..n-1: levels of bit arrays, each holding the keys that have a bit to themselves."""

    def __init__(self, keys: np.ndarray):
        levels, left = [], keys
        for level in range(LEVELS):
            if not len(left):
                break
            size = int(GAMMA * len(left)) + 64
            at = self._slot(left, level, size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
        self.set(levels, np.sort(left))  # the rest is practically empty

    def set(self, levels: list[np.ndarray], rest: np.ndarray) -> None:
        self.levels, self.ranks, self.rest, base = levels, [], rest, 0
        for alone in levels:
            self.ranks.append(base + np.cumsum(alone, dtype=np.int64) - alone)
            base += int(alone.sum())
        self.base = base

    def packed(self) -> tuple[bytes, bytes, bytes]:
        """(sizes of the levels, their bits, the rest)."""
        sizes = np.array([len(x) for x in self.levels], np.int64)
        return sizes.tobytes(), b"".join(np.packbits(x).tobytes() for x in self.levels), self.rest.tobytes()

    @classmethod
    def unpacked(cls, sizes: bytes, bits: bytes, rest: bytes) -> "MinimalPerfectHash":
        out, levels, at = cls.__new__(cls), [], 0
        for size in np.frombuffer(sizes, np.int64).tolist():
            n = -(-size // 8)
            levels.append(np.unpackbits(np.frombuffer(bits, np.uint8, n, at), count=size).astype(bool))
            at += n
        out.set(levels, np.frombuffer(rest, U))
        return out

    @staticmethod
    def _slot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (V.mix(keys + np.uint64((level + 1) * 0xA0761D6478BD642F % 2**64)) >> np.uint64(11)).astype(np.int64) % size

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key; any number below n for keys that weren't there at building."""
        out = np.zeros(len(keys), np.int64)
        open_ = np.arange(len(keys))
        for level, (alone, rank) in enumerate(zip(self.levels, self.ranks, strict=True)):
            if not len(open_):
                return out
            at = self._slot(keys[open_], level, len(alone))
            hit = alone[at]
            out[open_[hit]] = rank[at[hit]]
            open_ = open_[~hit]
        if len(open_) and len(self.rest):
            out[open_] = self.base + np.minimum(np.searchsorted(self.rest, keys[open_]), len(self.rest) - 1)
        return out


def merge(keys: np.ndarray, prints: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """(keys, prints, smallest document, largest document, number of entries) of the distinct lines, sorted."""
    order = np.lexsort((prints, keys))
    keys, prints, low, high = keys[order], prints[order], low[order], high[order]
    if not len(keys):
        return keys, prints, low, high, np.zeros(0, np.int64)
    at = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (prints[1:] != prints[:-1])])
    return keys[at], prints[at], np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.diff(np.r_[at, len(keys)])


@dataclass
class LineArrays:
    """The arrays of one shard: for every place of the perfect hash fingerprint, count (of chunks with the line, 2 to 255) and owner."""

    hash: MinimalPerfectHash
    prints: np.ndarray
    counts: np.ndarray
    owners: np.ndarray
    twins: np.ndarray  # (key, fingerprint, owner) of lines whose key another line has

    @classmethod
    def build(cls, keys: np.ndarray, prints: np.ndarray, low: np.ndarray, high: np.ndarray) -> "LineArrays":
        """From offers; lines of one document only are left out."""
        keys, prints, low, high, entries = merge(keys, prints, low, high)
        several = low < high
        keys, prints, low, entries = keys[several], prints[several], low[several], entries[several]
        twin = np.zeros(len(keys), bool)
        twin[1:] = keys[1:] == keys[:-1]
        own = keys[~twin]
        out = cls(MinimalPerfectHash(own), np.zeros(len(own), U), np.zeros(len(own), np.uint8), np.zeros(len(own), np.int64), np.stack([keys[twin], prints[twin], low[twin].view(U)]))
        at = out.hash.index(own)
        out.prints[at], out.owners[at], out.counts[at] = prints[~twin], low[~twin], np.clip(entries[~twin], 2, 255)
        return out

    def packed(self) -> tuple[bytes, ...]:
        return (*self.hash.packed(), self.prints.tobytes(), self.counts.tobytes(), self.owners.tobytes(), self.twins.tobytes())

    @classmethod
    def unpacked(cls, sizes: bytes, bits: bytes, rest: bytes, prints: bytes, counts: bytes, owners: bytes, twins: bytes) -> "LineArrays":
        return cls(MinimalPerfectHash.unpacked(sizes, bits, rest), np.frombuffer(prints, U), np.frombuffer(counts, np.uint8), np.frombuffer(owners, np.int64), np.frombuffer(twins, U).reshape(3, -1))

    def probe(self, keys: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether several documents hold the line, the smallest that does) for any lines."""
        shared, owner = np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        if len(self.prints):
            at = self.hash.index(keys)
            shared, owner = (self.prints[at] == prints) & (self.counts[at] > 1), self.owners[at].copy()
        for key, mark, first in self.twins.T:
            hit = (keys == key) & (prints == mark)
            shared |= hit
            owner[hit] = first.astype(np.int64)
        return shared, owner


def split_lines(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document of all \\n-split lines, empty ones and those of empty documents included."""
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([off[:-1], breaks + 1]), kind="stable")
    ends = np.sort(np.concatenate([off[1:], breaks]), kind="stable")
    count = 1 + np.searchsorted(breaks, off[1:]) - np.searchsorted(breaks, off[:-1])
    return starts, ends, np.repeat(np.arange(len(off) - 1), count)


def line_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(whether the key has at least `least` code points, the two hashes of the key) of each line."""
    solid = np.flatnonzero(~V.SPACE[data])
    a, b = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    full = b > a
    if not full.any():
        return full, np.zeros(len(starts), U), np.zeros(len(starts), U)
    first = np.where(full, solid[np.minimum(a, len(solid) - 1)], starts)
    last = np.where(full, solid[np.maximum(b - 1, 0)] + 1, first)
    points = V.code_points(data)
    return full & (points[last] - points[first] >= least), V.hashes(data, first, last, V.LOWER), V.hashes(data, first, last, V.SECOND)


@dataclass
class Lines:
    """The lines of one slice of a chunk that take part, and where all its lines are."""

    first: int  # document, as its place in the chunk
    end: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray  # of every line, from `first`
    usable: np.ndarray
    keys: np.ndarray
    prints: np.ndarray


def _lines(table: pa.Table, least: int) -> tuple[np.ndarray, Iterator[Lines]]:
    """(doc_ids, the lines by slices) of a chunk."""
    known = table.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
    ids = np.where(known, table.column("doc_id").to_numpy(zero_copy_only=False), 0).astype(np.int64)
    data, off = V.flat(table.column("text"))

    def slices() -> Iterator[Lines]:
        for first, end, part, offsets in V.slices(data, off):
            starts, ends, doc = split_lines(part, offsets)
            usable, keys, prints = line_keys(part, starts, ends, least)
            yield Lines(first, end, part, starts, ends, doc, usable & known[first + doc], keys, prints)

    return ids, slices()


def _distinct(ids: np.ndarray, found: Iterator[Lines]) -> tuple[np.ndarray, ...]:
    """The distinct lines of a chunk in the order of its offers (within a shard: sorted), as merge() gives them."""
    keys, prints, docs = [np.zeros(0, U)], [np.zeros(0, U)], [np.zeros(0, np.int64)]
    for x in found:
        keys.append(x.keys[x.usable])
        prints.append(x.prints[x.usable])
        docs.append(ids[x.first + x.doc[x.usable]])
    doc = np.concatenate(docs)
    return merge(np.concatenate(keys), np.concatenate(prints), doc, doc)


def _by_shard(keys: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, places of its keys in order)."""
    shard = (V.mix(keys) % U(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    cut = np.flatnonzero(np.r_[True, shard[order][1:] != shard[order][:-1], True]) if len(keys) else np.zeros(1, np.int64)
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        yield int(shard[order[a]]), order[a:b]


def _table(rows: list[tuple], schema: str) -> pa.Table:
    fields = [f.split() for f in schema.split(", ")]
    return pa.table({name: pa.array([r[i] for r in rows], pa.int32() if kind == "int" else pa.binary()) for i, (name, kind) in enumerate(fields)})


def _offer(least: int, shards: int):
    def offer(table: pa.Table) -> pa.Table:
        keys, prints, low, high, _ = _distinct(*_lines(table, least))
        chunk = table.column("chunk")[0].as_py()
        return _table([(chunk, s, keys[i].tobytes(), prints[i].tobytes(), low[i].tobytes(), high[i].tobytes()) for s, i in _by_shard(keys, shards)], OFFERS)

    return offer


def _joined(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _build(offers: pa.Table) -> pa.Table:
    """One shard's arrays, from all offers."""
    arrays = LineArrays.build(_joined(offers.column("keys"), U), _joined(offers.column("prints"), U), _joined(offers.column("low"), np.int64), _joined(offers.column("high"), np.int64))
    return _table([(offers.column("shard")[0].as_py(), *arrays.packed())], ARRAYS)


def _probe(offers: pa.Table, published: pa.Table) -> pa.Table:
    """One shard: the answer to every chunk's lines, in their order."""
    if not published.num_rows:
        return _table([], ANSWERS)
    arrays = LineArrays.unpacked(*[published.column(f.split()[0])[0].as_py() for f in ARRAYS.split(", ")[1:]])
    out = []
    for chunk, shard, keys, prints in zip(*(offers.column(c).to_pylist() for c in ("chunk", "shard", "keys", "prints")), strict=True):
        shared, owner = arrays.probe(np.frombuffer(keys, U), np.frombuffer(prints, U))
        if shared.any():
            out.append((chunk, shard, np.packbits(shared).tobytes(), owner[shared].tobytes()))
    return _table(out, ANSWERS)


def _rewrite(least: int, shards: int):
    def rewrite(docs: pa.Table, answers: pa.Table) -> pa.Table:
        ids, found = _lines(docs, least)
        slices = list(found)
        keys, prints, *_ = _distinct(ids, iter(slices))
        owner = np.full(len(keys), -1, np.int64)
        shared = np.zeros(len(keys), bool)
        told = {s: (bits, owners) for s, bits, owners in zip(*(answers.column(c).to_pylist() for c in ("shard", "shared", "owners")), strict=True)}
        for s, i in _by_shard(keys, shards) if told else ():
            if s in told:
                hit = i[np.unpackbits(np.frombuffer(told[s][0], np.uint8), count=len(i)).astype(bool)]
                shared[hit], owner[hit] = True, np.frombuffer(told[s][1], np.int64)
        keys, prints, owner = keys[shared], prints[shared], owner[shared]
        n_lines, n_dropped, texts = np.zeros(docs.num_rows, np.int64), np.zeros(docs.num_rows, np.int64), []
        for x in slices:
            drop = np.zeros(len(x.doc), bool)
            if len(keys):
                # twins of one key follow each other; there are practically none
                for step in range(int(np.bincount(np.unique(keys, return_inverse=True)[1]).max())):
                    at = np.minimum(np.searchsorted(keys, x.keys) + step, len(keys) - 1)
                    drop |= x.usable & (keys[at] == x.keys) & (prints[at] == x.prints) & (owner[at] != ids[x.first + x.doc])
            size = x.end - x.first
            n_lines[x.first : x.end] = np.bincount(x.doc, minlength=size)
            n_dropped[x.first : x.end] = np.bincount(x.doc[drop], minlength=size)
            edge = np.searchsorted(x.doc, np.arange(size + 1))
            raw = x.data.tobytes()
            for i in range(size):
                a, b = edge[i], edge[i + 1]
                if n_dropped[x.first + i]:
                    texts.append(b"\n".join(raw[x.starts[j] : x.ends[j]] for j in a + np.flatnonzero(~drop[a:b])))
                else:
                    texts.append(raw[x.starts[a] : x.ends[b - 1]])
        return (
            docs.drop_columns(["text", "chunk"])
            .append_column("text", pa.array(texts, pa.binary()).cast(pa.string()))
            .append_column("n_lines", pa.array(n_lines)).append_column("n_dropped", pa.array(n_dropped))
            .append_column("kept_sha256", pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()))
        )

    return rewrite


def drop_shared_lines(docs: DataFrame, least: int = 10, keep: list[str] | None = None) -> DataFrame:
    """Drop from every document the lines whose key has at least `least` code
    points and is held by several documents, except in the smallest doc_id.

    docs: doc_id, text.  keep: further columns to carry along.  Returns doc_id,
    those columns, text (without the lines), n_lines (before), n_dropped, kept_sha256."""
    n = chunk_count(docs)
    shards = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes(docs) // SHARD_BYTES), 1)
    extra = [c for c in keep or [] if c not in ("doc_id", "text", "chunk", "n_lines", "n_dropped", "kept_sha256")]
    rows = with_chunk(docs.select(F.col("doc_id").cast("long").alias("doc_id"), *extra, F.col("text").cast("string").alias("text")), n)
    offers = materialize(rows.select("chunk", "doc_id", "text").groupBy("chunk").applyInArrow(_offer(least, shards), OFFERS), "line-offers")
    arrays = materialize(offers.groupBy("shard").applyInArrow(_build, ARRAYS), "line-arrays")
    asked = offers.select("chunk", "shard", "keys", "prints")
    answers = asked.groupBy("shard").cogroup(arrays.groupBy("shard")).applyInArrow(_probe, ANSWERS)
    fields = [f"`{name}` {kind}" for name, kind in rows.dtypes if name not in ("text", "chunk")]
    schema = ", ".join([*fields, "text string, n_lines long, n_dropped long, kept_sha256 string"])
    return rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_rewrite(least, shards), schema)
