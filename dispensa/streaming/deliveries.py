"""Continuous matching of arriving delivery files.

Targets are static and parsed once, when the query starts, so matching keeps no
state; every micro-batch is classified and appended, and consolidated from what
was written.  What a batch writes to the shared folder is deleted at its end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.numbers import parse_decimal
from ..operators.matching import classify, matched_quantities, target_index
from ..scratch import scratch_scope

EVENT_SCHEMA = "descripcion string, codigo string, cantidad string, mes string"


def read_events(spark: SparkSession, folder: str, sep: str = ";", max_files: int = 100) -> DataFrame:
    return spark.readStream.schema(EVENT_SCHEMA).option("header", True).option("sep", sep).option("maxFilesPerTrigger", max_files).csv(folder)


def match_stream(events: DataFrame, primary: DataFrame, secondary: DataFrame | None, out: str, checkpoint: str) -> StreamingQuery:
    """Starts the query; rows go to out/batch=N, so a repeated batch overwrites itself."""
    first, second = target_index(primary), target_index(secondary) if secondary is not None else None

    def handle(batch: DataFrame, number: int) -> None:
        with scratch_scope(batch.sparkSession):
            rows = classify(batch.withColumn("cantidad", parse_decimal(F.col("cantidad"))), first, second)
            rows.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return events.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def consolidated(spark: SparkSession, out: str) -> DataFrame:
    """Quantities by list, target and month of all batches so far."""
    return matched_quantities(spark.read.parquet(out))
