"""String similarities that have no built-in: Arrow functions over distinct pairs."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import DoubleType


@F.pandas_udf(DoubleType())
def block_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio of a to b (the order of arguments matters)."""
    return pd.Series([SequenceMatcher(None, x or "", y or "").ratio() if x or y else 1.0 for x, y in zip(a, b, strict=True)], dtype="float64")


def best_ratios(pairs: DataFrame, word: str, other: str, cutoff: float, reverse: bool = False) -> DataFrame:
    """For each word the pairs of highest ratio at or above the cutoff: word, sim and the others' columns.

    Rows are dealt as they come: each batch keeps the best rows of every word it
    holds, so a word with many candidates is no group of one task, and the caller
    takes the best of a few rows per word.  Of a batch, pairs are compared in
    order of an upper bound (their common subsequence), until none can be better.
    The ratio is block_ratio(word, other), or of (other, word) if `reverse`."""
    schema = T.StructType([*pairs.schema.fields, T.StructField("sim", T.DoubleType())])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, others = batch.column(word).to_pylist(), batch.column(other).to_pylist()
            by_word: dict[str, list[tuple[float, int]]] = {}
            for i, (x, y) in enumerate(zip(words, others, strict=True)):
                bound = 2.0 * _common(x, y) / (len(x) + len(y)) if x or y else 1.0
                if bound >= cutoff:
                    by_word.setdefault(x, []).append((bound, i))
            kept, sims = [], []
            for x, rows in by_word.items():
                top, found = cutoff, []
                for bound, i in sorted(rows, key=lambda r: -r[0]):
                    if bound < top:
                        break
                    a, b = (others[i], x) if reverse else (x, others[i])
                    sim = SequenceMatcher(None, a, b).ratio()
                    if sim >= top:
                        top = sim
                        found.append((sim, i))
                kept += [i for sim, i in found if sim == top]
                sims += [sim for sim, i in found if sim == top]
            yield pa.RecordBatch.from_arrays([*batch.take(pa.array(kept, pa.int64())).columns, pa.array(sims, pa.float64())], names=[*batch.schema.names, "sim"])

    return pairs.mapInArrow(best, schema)


def top_ratios(pairs: DataFrame, group: str, word: str, other: str, each: int) -> DataFrame:
    """pairs with sim = block_ratio(word, other), only those that may be among the `each` most similar of their group.

    Each batch keeps its best and what equals them; an upper bound spares most ratios, as in best_ratios."""
    schema = T.StructType([*pairs.schema.fields, T.StructField("sim", T.DoubleType())])

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_group: dict[object, list[tuple[float, int, str, str]]] = {}
            for i, (g, x, y) in enumerate(zip(batch.column(group).to_pylist(), batch.column(word).to_pylist(), batch.column(other).to_pylist(), strict=True)):
                x, y = x or "", y or ""
                by_group.setdefault(g, []).append((2.0 * _common(x, y) / (len(x) + len(y)) if x or y else 1.0, i, x, y))
            kept, sims = [], []
            for rows in by_group.values():
                least: list[float] = []  # the best ratios so far, the smallest first
                found = []
                for bound, i, x, y in sorted(rows, key=lambda r: -r[0]):
                    if len(least) == each and bound < least[0]:
                        break
                    sim = SequenceMatcher(None, x, y).ratio()
                    (heapq.heappushpop if len(least) == each else heapq.heappush)(least, sim)
                    found.append((sim, i))
                kept += [i for sim, i in found if sim >= least[0]]
                sims += [sim for sim, i in found if sim >= least[0]]
            yield pa.RecordBatch.from_arrays([*batch.take(pa.array(kept, pa.int64())).columns, pa.array(sims, pa.float64())], names=[*batch.schema.names, "sim"])

    return pairs.mapInArrow(top, schema)


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, with one bit per character of a."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    open_ = full
    for c in b:
        hit = open_ & places.get(c, 0)
        open_ = ((open_ + hit) | (open_ - hit)) & full
    return len(a) - open_.bit_count()


@F.pandas_udf(DoubleType())
def indel_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Similarity by insertions and deletions, 0 to 100."""
    return pd.Series([None if x is None or y is None else 100.0 if not x + y else 200.0 * _common(x, y) / (len(x) + len(y)) for x, y in zip(a, b, strict=True)], dtype="float64")
