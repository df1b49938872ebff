"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_written: list[list[str]] = []


def scratch_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a folder in the warehouse, or of a session in one process (tests) a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if spark.sparkContext.master.startswith("local"):
            found = tempfile.mkdtemp(prefix="scratch-")
            atexit.register(shutil.rmtree, found, ignore_errors=True)
        else:
            found = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for scope in _written:
        scope.append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it again: cuts lineage
    in a way that survives lost executors and is computed once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of any store that Spark reads."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what was written to the shared folder meanwhile: for jobs that have written their results by then."""
    scope: list[str] = []
    _written.append(scope)
    try:
        yield
    finally:
        _written.remove(scope)
        for path in scope:
            fs, where = hadoop_path(spark, path)
            fs.delete(where, True)
