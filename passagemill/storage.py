"""Stored tables: what a job keeps between its stages.

A plan is cut by writing a table and reading it back, in a folder that driver and executors share, so the table survives
lost executors.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Writes a table under a name and returns it as read back.
Store = Callable[[DataFrame, str], DataFrame]


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Where it is unset, a local session gets a temporary folder and a cluster an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return "file://" + tempfile.mkdtemp(prefix="passagemill-")


def store_in(folder: str) -> Store:
    """A ``Store`` that writes below ``folder``, each table into a folder of its own."""

    def store(df: DataFrame, name: str) -> DataFrame:
        path = f"{folder}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    return store


def default_store(spark: SparkSession) -> Store:
    return store_in(f"{shared_folder(spark)}/{uuid.uuid4().hex}")
