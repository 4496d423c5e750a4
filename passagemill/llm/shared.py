"""Intermediate tables in the folder that driver and executors share.

Plans are cut by writing a table and reading it back: unlike a cached or local copy, it survives lost executors.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of rows that Spark hands to a Python worker at once; a single longer row goes alone.
BATCH_BYTES = 4 << 20

_made: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Where it is unset, local sessions get a temporary folder; clusters raise."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="passagemill-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/passagemill/{uuid.uuid4().hex}/{name}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """pyarrow's file system for a URI and the path on it: file, hdfs, gs, abfss, s3 (also as s3a or s3n)."""
    scheme, mark, rest = uri.partition("://")
    return fs.FileSystem.from_uri(f"s3://{rest}" if mark and scheme in ("s3a", "s3n") else uri)


def store(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written and read back."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(spark: SparkSession) -> int:
    """Delete what this application stored; frames that still read it fail from then on. Returns the number of folders."""
    paths = _made.pop(spark.sparkContext.applicationId, [])
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return len(paths)


def row_key(*columns: str) -> Column:
    """128 bits (hex) that tell rows with different values in ``columns`` apart, nulls included; equal rows have equal keys."""
    values = [F.struct(F.col(c).isNull(), F.col(c)) for c in columns]
    halves = (F.lpad(F.hex(F.xxhash64(F.lit(half), *values)), 16, "0") for half in (1, 2))
    return F.concat(*halves).alias("row_key")


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs run inside the block; the caller's come back after it."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def store_from_python(df: DataFrame, name: str) -> DataFrame:
    """``store`` for a plan with Python stages: their batches are bounded by bytes, so long texts do not pile up."""
    with settings(df.sparkSession, {"spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}):
        return store(df, name)
