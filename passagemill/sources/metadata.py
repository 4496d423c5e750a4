"""Scan of the source-metadata text file."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passagemill import schemas
from passagemill.operators.parse import parse_sources


def read_metadata_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of one text file, UTF-8 if all of it is valid UTF-8, else Latin-1."""
    options = {"ignoreCorruptFiles": "false", "ignoreMissingFiles": "false"}  # whatever the session's: no lines are lost unseen
    lines = spark.read.options(**options).text(path)
    utf8 = lines.select(F.bool_and(F.is_valid_utf8("value"))).scalar()
    latin1 = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    return lines.select(F.when(utf8, F.col("value")).otherwise(latin1).alias("value"))


def scan_sources(spark: SparkSession, path: str, missing_ok: bool = False) -> DataFrame:
    """The sources table. A missing file is an error, or an empty table with ``missing_ok``."""
    try:
        return parse_sources(read_metadata_lines(spark, path))
    except AnalysisException as error:
        if missing_ok and error.getCondition() == "PATH_NOT_FOUND":
            return schemas.empty(spark, schemas.SOURCES)
        raise
