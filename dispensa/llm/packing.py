"""Best-fit packing of tokenized documents into sequences of fixed length.

Method: hierarchical residual packing.  Every partition packs its pieces
best-fit, longest first, and emits nearly full bins.  Underfull bins become
items of a tree: the bins of FAN partitions meet in one node, are packed
best-fit again, and so on up to a single root.  Two bins that are both at most
half full never leave a node apart, so a node keeps at most one of these; a bin
over half full can only take one of them, so a node hands up no more such bins
than there are partitions (those with the most room), and emits the others.
The root's input is therefore bounded by the number of partitions, not of
documents.  Partitions grow in number with the pieces (PART_PIECES each).

Null and empty texts are one end token.  Repeated rows are packed once each.
An empty table gives an empty result.  Extra columns are ignored."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import materialize

PIECES = "row_id long, doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", part int, bin long, offset long, fill long, up boolean"
BINS = "part int, bin long, fill long"
MOVES = "part int, bin long, to_bin long, shift long, fill long, up boolean"
FAN = 16
#: Pieces that one partition packs at once.
PART_PIECES = 200_000
#: A bin with at most this many free places counts as nearly full.
SLACK = 16


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: whole documents that fit stay whole, of longer ones only the first piece may be short."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end_id: int) -> Iterator[pa.RecordBatch]:
    encoder = tokens.encoder(path)
    end = np.array([end_id], "<u4").tobytes()
    for batch in batches:
        out: dict[str, list] = {k: [] for k in ("row_id", "doc_id", "piece", "start", "length", "ids_crc32")}
        for row, doc, ids in zip(batch.column("row_id").to_pylist(), batch.column("doc_id").to_pylist(), encoder.documents(batch.column("text")), strict=True):
            raw = ids.astype("<u4").tobytes() + end
            for k, (start, length) in enumerate(cut(len(raw) // 4, capacity)):
                for name, value in zip(out, (row, doc, k, start, length, zlib.crc32(raw[4 * start : 4 * (start + length)])), strict=True):
                    out[name].append(value)
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int32() if k == "piece" else pa.int64()) for k, v in out.items()], names=list(out))


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Best-fit decreasing: (bin, offset) of each item and the fill of each bin.

    Open bins are kept by free room; a bit mask of the rooms in use finds the
    tightest bin in constant time."""
    order = np.argsort(-sizes, kind="stable")
    bin_of, offset, fill = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    used = 0
    for i, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        fits = used >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                used &= ~(1 << room)
        else:
            room, b = capacity, len(fill)
            fill.append(0)
        bin_of[i], offset[i] = b, fill[b]
        fill[b] += size
        if room > size:
            by_room[room - size].append(b)
            used |= 1 << (room - size)
    return bin_of, offset, fill


def handed_up(fill: np.ndarray, capacity: int, slack: int, parts: int) -> np.ndarray:
    """Which bins of a node go up: the half-empty ones, and of the others under
    capacity - slack those with the most room, one for each other partition."""
    up = fill * 2 <= capacity
    big = np.flatnonzero(~up & (fill < capacity - slack))
    up[big[np.argsort(fill[big], kind="stable")[:parts]]] = True
    return up


def _local(pdf: pd.DataFrame, capacity: int, slack: int, parts: int) -> pd.DataFrame:
    pdf = pdf.sort_values(["length", "doc_id", "row_id", "piece"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
    bin_of, offset, fill = best_fit(pdf["length"].to_numpy(), capacity)
    fills = np.asarray(fill, np.int64)
    up = handed_up(fills, capacity, slack, parts) if parts > 1 else np.zeros(len(fills), bool)
    part = int(pdf["part"].iloc[0])
    return pdf.assign(bin=(part << 40) + bin_of, offset=offset, fill=fills[bin_of], up=up[bin_of])


def _node(pdf: pd.DataFrame, capacity: int, slack: int, parts: int, last: bool) -> pd.DataFrame:
    pdf = pdf.sort_values(["fill", "bin"], ascending=[False, True]).reset_index(drop=True)
    bin_of, shift, fill = best_fit(pdf["fill"].to_numpy(), capacity)
    fills, first = np.asarray(fill, np.int64), np.zeros(len(fill), np.int64)
    first[bin_of[::-1]] = pdf["bin"].to_numpy()[::-1]
    up = np.zeros(len(fills), bool) if last else handed_up(fills, capacity, slack, parts)
    return pd.DataFrame({"part": pdf["part"] // FAN, "bin": pdf["bin"], "to_bin": first[bin_of], "shift": shift, "fill": fills[bin_of], "up": up[bin_of]})


def _nodes(capacity: int, slack: int, parts: int, last: bool):
    return lambda pdf: _node(pdf, capacity, slack, parts, last)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, slack: int = SLACK, partitions: int | None = None) -> DataFrame:
    """Pieces of all documents with their sequence and their place in it.

    docs: doc_id, text.  Returns doc_id, piece, start, length, ids_crc32,
    sequence_id, offset; offsets in a sequence are gapless from 0."""
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = rows.mapInArrow(partial(_pieces, path=tokenizer, capacity=capacity, end_id=end_id), PIECES)
    pieces = materialize(pieces, "pieces")
    parts = partitions or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-pieces.count() // PART_PIECES))
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("row_id", "piece"), F.lit(parts)).cast("int"))
    placed = materialize(dealt.groupBy("part").applyInPandas(lambda pdf: _local(pdf, capacity, slack, parts), PLACED), "placed")

    bins, width, moves = placed.where("up").select("part", "bin", "fill").distinct(), parts, []
    where = placed.select("doc_id", "piece", "start", "length", "ids_crc32", "bin", "offset")
    while width > 1:
        width = -(-width // FAN)
        nodes = bins.withColumn("node", F.floor(F.col("part") / FAN)).groupBy("node")
        moved = materialize(nodes.applyInPandas(_nodes(capacity, slack, parts, width == 1), MOVES), "moves")
        moves.append(moved)
        bins = moved.where("up").select("part", F.col("to_bin").alias("bin"), "fill").distinct()
    for moved in moves:
        step = moved.where("bin <> to_bin or shift <> 0").select("bin", "to_bin", "shift")
        where = where.join(step, "bin", "left").select(
            "doc_id", "piece", "start", "length", "ids_crc32",
            F.coalesce("to_bin", "bin").alias("bin"), (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
        )
    return where.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset")
