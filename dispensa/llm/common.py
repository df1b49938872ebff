"""Helpers shared by the operators: sizing and chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import materialize, scratch_dir, scratch_path

__all__ = ["CHUNK_BYTES", "chunk_count", "input_bytes", "materialize", "scratch_dir", "scratch_path", "with_chunk"]

#: Bytes of input that one chunk (a group of documents handled together) holds.
CHUNK_BYTES = 6 << 20


def input_bytes(df: DataFrame) -> int:
    """Size of df as the optimizer estimates it from file sizes (no job is run)."""
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # Spark Connect has no plan to ask
        return 0
    return size if size < 1 << 50 else 0


def chunk_count(df: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> int:
    """Chunks grow with the input, so that each stays of bounded size."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(parts, -(-input_bytes(df) // chunk_bytes), 1)


def with_chunk(df: DataFrame, n: int, key: str = "doc_id", chunk: str = "chunk") -> DataFrame:
    """Number every row with a chunk that depends on its key alone.

    Rows without a key are spread by their text, so that they do not meet in one chunk."""
    spread = F.when(F.col(key).isNull(), F.xxhash64("text")).otherwise(F.xxhash64(key))
    return df.withColumn(chunk, F.pmod(spread, F.lit(n)).cast("int"))
