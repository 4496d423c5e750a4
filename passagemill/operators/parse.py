"""Line parsing: tagged content lines and source-metadata lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagemill import schemas
from passagemill.functions.text import WS, strip_ws

# Fixed values of the input formats.
MARKER = "@@"
SOURCE_FIELDS = schemas.SOURCES.fieldNames()
REJECT_WIDTH = 80


def is_marked(stripped: Column) -> Column:
    return F.startswith(stripped, F.lit(MARKER))


def _id_end(line: Column) -> Column:
    """1-based position of the first U+0020 after the marker, 0 if there is none."""
    return F.locate(" ", line, len(MARKER) + 1)


def has_id(line: Column) -> Column:
    return _id_end(line) > 0


def line_id(line: Column) -> Column:
    """The id of a stripped tagged line that ``has_id``."""
    start = len(MARKER) + 1
    return F.substring(line, F.lit(start), _id_end(line) - start)


def marker_lines(df: DataFrame, column: str = "value") -> DataFrame:
    """Keep lines that start with the marker once stripped; ``line`` is the stripped text."""
    return df.withColumn("line", strip_ws(F.col(column))).where(is_marked(F.col("line")))


def parse_lines(df: DataFrame, column: str = "line") -> DataFrame:
    """Split ``@@<id> <text>`` into id and content; a line without a space after its id is dropped."""
    line = F.col(column)
    return df.where(has_id(line)).select(
        line_id(line).alias("id"),
        F.substring(line, _id_end(line) + 1, F.lit(2**31 - 1)).alias("content"),
        *[c for c in df.columns if c != column],
    )


def _source_parts(column: str) -> tuple[Column, Column]:
    line = strip_ws(F.col(column))
    return line, F.split(line, f"(?:{WS})+", len(SOURCE_FIELDS))


def source_states(df: DataFrame, column: str = "value") -> tuple[Column, Column]:
    """Whether a metadata line is loaded, and whether it is rejected; a blank one is neither."""
    line, parts = _source_parts(column)
    whole = F.size(parts) == len(SOURCE_FIELDS)
    return (line != "") & whole, (line != "") & ~whole


def parse_sources(df: DataFrame, column: str = "value") -> DataFrame:
    """Seven whitespace-separated fields per line; the last keeps its inner blanks.

    Blank lines and lines with fewer fields are left out (see ``source_rejects``).
    """
    line, parts = _source_parts(column)
    return (
        df.select(line.alias("line"), parts.alias("parts"))
        .where((F.col("line") != "") & (F.size("parts") == len(SOURCE_FIELDS)))
        .select(*[F.get("parts", F.lit(i)).alias(name) for i, name in enumerate(SOURCE_FIELDS)])
    )


def source_rejects(df: DataFrame, column: str = "value") -> DataFrame:
    """The malformed lines that ``parse_sources`` leaves out, shortened for display."""
    line, parts = _source_parts(column)
    return (
        df.select(line.alias("line"), F.size(parts).alias("fields"))
        .where((F.col("line") != "") & (F.col("fields") < len(SOURCE_FIELDS)))
        .select(F.left("line", F.lit(REJECT_WIDTH)).alias("line"), F.col("fields").cast("long").alias("fields"))
    )
