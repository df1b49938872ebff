"""Vectorised text primitives over Arrow string columns.

A column is seen as one byte array with document offsets.  White space of the
contracts is ASCII ([\\x20\\x09-\\x0D]), so splitting bytes equals splitting code
points.  Segments (words, lines) get 64-bit hashes from prefix sums of
table[byte] * base**position, so the cost is a few array passes, not a loop."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext

U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bytes handled in one slice: bounds the temporary arrays (about 8 bytes each).
SLICE_BYTES = 2 << 20

_rng = np.random.default_rng(20240607)
RAW = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
LOWER = RAW.copy()
LOWER[65:91] = RAW[97:123]  # A-Z hash as a-z
SECOND = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)  # of a second hash, A-Z as a-z
SECOND[65:91] = SECOND[97:123]
_BASE = U(0x9E3779B97F4A7C15)
_BASE_INV = U(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers: dict[str, np.ndarray] = {"up": np.ones(1, U), "down": np.ones(1, U)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) <= n:
        size = max(n + 1, SLICE_BYTES + (1 << 17))
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            steps = np.full(size, base, U)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


#: glibc's numbers of the settings, and from how many bytes on an array is a mapping of its own.
TRIM_THRESHOLD, MMAP_THRESHOLD, MAPPED = -1, -3, 4 << 20


@cache
def _allocator():
    """The C library of a Python worker, told to return freed arrays to the system; None where it isn't glibc."""
    libc = ctypes.CDLL(None)
    if not hasattr(libc, "malloc_trim"):
        return None
    libc.mallopt(MMAP_THRESHOLD, MAPPED)
    libc.mallopt(TRIM_THRESHOLD, MAPPED)
    pa.set_memory_pool(pa.system_memory_pool())
    return libc


def give_back() -> None:
    """Returns memory that earlier tasks have freed: a worker lives through all stages of a job, and several share an executor's memory."""
    if TaskContext.get() is not None and _allocator() is not None:
        _allocator().malloc_trim(0)


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    give_back()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays([c.cast(pa.large_string()) for c in column.chunks]) if column.num_chunks else pa.array([], pa.large_string())
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def slices(data: np.ndarray, off: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, end, bytes, offsets) of runs of whole documents of about `limit` bytes; a longer document is alone."""
    first, n = 0, len(off) - 1
    while first < n:
        end = max(first + 1, int(np.searchsorted(off, off[first] + limit, "right")) - 1)
        yield first, end, data[off[first] : off[end]], off[first : end + 1] - off[first]
        first = end


def runs(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of True that do not cross documents."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(len(inside) + 1, bool)
    cut[off] = True
    before = np.empty(len(inside), bool)
    before[0] = True
    np.logical_not(inside[:-1], out=before[1:])
    before |= cut[:-1]
    after = np.empty(len(inside), bool)
    after[-1] = True
    np.logical_not(inside[1:], out=after[:-1])
    after |= cut[1:]
    return np.flatnonzero(inside & before), np.flatnonzero(inside & after) + 1


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document numbers of all words."""
    starts, ends = runs(~SPACE[data], off)
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = RAW) -> np.ndarray:
    """64-bit hashes of data[start:end] for each segment."""
    up, down = powers(len(data))
    prefix = np.zeros(len(data) + 1, U)
    np.cumsum(table[data] * up[: len(data)], out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))


def code_points(data: np.ndarray) -> np.ndarray:
    """Prefix counts of code points: the count in data[a:b] is out[b] - out[a]."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out
