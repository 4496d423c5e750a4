"""Chat-format records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The wording of a record.
PROMPT = "Given the following example text, use dialectal markers to identify the country of origin: "
REPLY = "The sample you provided "
REPLY_YEAR = "appears to be from "
REQUIRED = ("content", "source", "year", "title", "id")


def year_reply(year: Column) -> Column:
    """The reply names the year if there is one, and ends with exactly one added period."""
    known = year.isNotNull() & ~year.isin("", "nan")
    reply = F.concat(F.lit(REPLY), F.when(known, F.concat(F.lit(REPLY_YEAR), year)).otherwise(F.lit("")))
    return F.when(F.endswith(reply, F.lit(".")), reply).otherwise(F.concat(reply, F.lit(".")))


def format_conversations(
    df: DataFrame, prompt: str = PROMPT, reply: Column | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """One record per row: conversations (human, gpt), source, score, and the columns in ``keep``."""
    missing = [c for c in REQUIRED if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    if reply is None:
        reply = year_reply(F.col("year").cast("string"))

    def message(sender: str, text: Column) -> Column:
        return F.struct(F.lit(sender).alias("from"), text.alias("value"))

    human = message("human", F.concat(F.lit(prompt), F.col("content").cast("string")))
    return df.select(
        F.array(human, message("gpt", reply)).alias("conversations"),
        F.col("source").cast("string").alias("source"),
        F.lit(0).cast("long").alias("score"),
        *keep,
    )
