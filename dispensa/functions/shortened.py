"""Hashes of texts without some of their characters, and a filter by them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What array columns of pieces hold: a number that tells kinds of pieces apart, a text, and how many characters (0 to 2) it is to lose.
PIECES = "array<struct<kind:int,text:string,times:int>>"
#: A filter has 2 ** 27 bits (16 MB) at most, whatever the list; a fuller one only lets more pass.
FEWEST, MOST = 15, 27
_CELLS = 500_000  # hashes made at once
_BASE = 0x9E3779B97F4A7C15  # odd, hence invertible
_BACK = pow(_BASE, -1, 2**64)


def piece(kind: Column, text: Column, times: Column) -> Column:
    return F.struct(kind.cast("int").alias("kind"), text.alias("text"), times.cast("int").alias("times"))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _codes(texts: pa.Array, n: int) -> np.ndarray:
    """A row of mixed characters for each text, all of n characters."""
    return _mixed(np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), "<u4").reshape(len(texts), n).astype(np.uint64) + np.uint64(_BASE))


def _hashes(codes: np.ndarray, kinds: np.ndarray, times: int) -> np.ndarray:
    """A row for each text, all of one length: hashes of what is left without any so many characters, in no order."""
    n, back = codes.shape[1], np.uint64(_BACK)
    powers = np.array([pow(_BASE, k, 2**64) for k in range(n)], np.uint64)
    sums = np.zeros((len(codes), n + 1), np.uint64)
    np.cumsum(codes * powers, axis=1, out=sums[:, 1:])  # of the text up to each place; what follows a lost character moves down one power
    if times == 0:
        found = sums[:, n:]
    elif times == 1:
        found = sums[:, :n] + (sums[:, n:] - sums[:, 1:]) * back
    else:
        i, j = np.triu_indices(n, 1)
        found = sums[:, i] + (sums[:, j] - sums[:, i + 1]) * back + (sums[:, n:] - sums[:, j + 1]) * (back * back)
    return _mixed(found + (kinds.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))[:, None])


@dataclass(frozen=True)
class Slices:
    """Pieces of a text column that only depend on a text's length: by length their kinds, first places (from 0), lengths and how many characters they are to lose."""

    text: str
    of: dict[int, list[tuple[int, int, int, int]]]


def _sliced(texts: pa.Array, of: dict[int, list[tuple[int, int, int, int]]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    size = pc.fill_null(pc.utf8_length(texts), -1).to_numpy(zero_copy_only=False)
    for n in np.unique(size).tolist():
        pieces = [x for x in dict.fromkeys(of.get(n, [])) if 0 <= x[3] <= min(x[2], 2)]
        at = np.flatnonzero(size == n) if pieces else np.zeros(0, np.int64)
        step = max(1, _CELLS // max(1, n * (n - 1) // 2))
        for some in (at[k : k + step] for k in range(0, len(at), step)):
            codes = _codes(texts.take(pa.array(some)), n)
            for kind, start, length, times in pieces:
                yield some, _hashes(codes[:, start : start + length], np.full(len(some), kind), times)


def _listed(found: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    place = pc.list_parent_indices(found).to_numpy()
    kinds, texts, times = found.flatten().flatten()
    kinds, times, size = kinds.to_numpy(), times.to_numpy(), pc.utf8_length(texts).to_numpy()
    usable = (times >= 0) & (times <= np.minimum(size, 2))
    group = np.where(usable, size.astype(np.int64) * 3 + times, -1)
    order = np.argsort(group, kind="stable")
    order = order[np.count_nonzero(~usable) :]
    for some in np.split(order, np.flatnonzero(np.diff(group[order])) + 1) if len(order) else []:
        n, t = divmod(int(group[some[0]]), 3)
        step = max(1, _CELLS // max(1, (1, n, n * (n - 1) // 2)[t]))
        for part in (some[k : k + step] for k in range(0, len(some), step)):
            yield place[part], _hashes(_codes(texts.take(pa.array(part)), n), kinds[part], t)


def forms(df: DataFrame, pieces: Column | Slices, seen: Hashes | None = None) -> DataFrame:
    """df with `_k`: a row for each different hash of a row's pieces, of which those not `seen` may be left out.

    Equal kinds and texts left over have equal hashes; others seldom do."""
    out = T.StructType([*df.schema.fields, T.StructField("_k", T.LongType())])
    held = seen.held if seen else None
    slices = pieces if isinstance(pieces, Slices) else None

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = np.frombuffer(held.value, np.uint8) if held else None
        for batch in batches:
            rest = batch if slices else batch.drop_columns(["_x"])
            rows: list[np.ndarray] = []
            keys: list[np.ndarray] = []
            held_rows = 0

            def flush(rows=rows, keys=keys, rest=rest) -> pa.RecordBatch:
                at, key = np.concatenate(rows), np.concatenate(keys)
                rows.clear()
                keys.clear()
                return pa.RecordBatch.from_arrays([*rest.take(pa.array(at)).columns, pa.array(key.view(np.int64))], names=[*rest.schema.names, "_k"])

            for place, h in _sliced(batch.column(slices.text), slices.of) if slices else _listed(batch.column("_x")):
                if filled is None:
                    h.sort(axis=1)
                    new = np.ones(h.shape, bool)
                    new[:, 1:] = h[:, 1:] != h[:, :-1]
                    r, c = np.nonzero(new)
                    at, key = place[r], h[r, c]
                else:
                    bit = h & np.uint64(len(filled) * 8 - 1)
                    r, c = np.nonzero(filled[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1)
                    at, key = place[r], h[r, c]
                    by = np.lexsort((key, at))
                    at, key = at[by], key[by]
                    new = np.ones(len(at), bool)
                    new[1:] = (at[1:] != at[:-1]) | (key[1:] != key[:-1])
                    at, key = at[new], key[new]
                rows.append(at)
                keys.append(key)
                held_rows += len(at)
                if held_rows >= _CELLS:
                    yield flush()
                    held_rows = 0
            if held_rows:
                yield flush()

    return (df if slices else df.withColumn("_x", pieces)).mapInArrow(made, out)


class Hashes:
    """Which hashes a table's `_k` may hold: one bit for each by its last bits, in a string of bounded size that every worker gets."""

    def __init__(self, table: DataFrame):
        spark = table.sparkSession
        self.bits = min(MOST, max(FEWEST, (16 * table.count()).bit_length()))
        bit = F.col("_k").bitwiseAND(F.lit((1 << self.bits) - 1)) + 1
        made = table.groupBy(F.bitmap_bucket_number(bit).alias("number")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
        filled = np.zeros(1 << self.bits >> 3, np.uint8)
        for r in made.collect():  # at most 4,096 rows of 4 KB
            filled[(r["number"] - 1) * 4096 :][:4096] = np.frombuffer(r["bits"], np.uint8)
        self.held = spark.sparkContext.broadcast(filled.tobytes())
