"""Positions and running totals in a global order, without a task that sees all rows or all rows of a group.

The rows are range-partitioned by the order, stored, and numbered inside their partitions. What lies in the partitions before
is the prefix sum of one row per partition, or per partition and group where the count starts anew in each group; a group
with most of the rows is many partitions. Hand in narrow rows: they are sorted and stored once.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from passagemill.storage import Store, default_store

_ROW_BITS = 33  # of monotonically_increasing_id, below the number of the partition
_PART, _AT = "_part", "_at"


def _in_order(df: DataFrame, order: Sequence[Column | str], store: Store) -> DataFrame:
    """``df`` with the partition and the row within it that each row has in the order, stored."""
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    stored = store(placed, "in_order")
    row = F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return stored.withColumn(_PART, F.shiftright("_id", _ROW_BITS)).withColumn(_AT, row).drop("_id")


def number_rows(
    df: DataFrame, order: Sequence[Column | str], within: Sequence[str] = (), name: str = "position", store: Store | None = None
) -> DataFrame:
    """Add ``name``: the place of each row in the order, from 0, counted anew in each group of the columns ``within``.

    ``within`` must not hold nulls. Rows that the order does not tell apart get consecutive places in any order.
    """
    store = store or default_store(df.sparkSession)
    rows = _in_order(df, [*within, *order], store)
    if not within:
        sizes = sorted((r[_PART], r["n"]) for r in rows.groupBy(_PART).agg(F.count("*").alias("n")).collect())  # one per partition
        before = accumulate((n for _, n in sizes), initial=0)
        offsets = df.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(sizes, before)], f"{_PART} long, _before long")
        placed = rows.join(F.broadcast(offsets), _PART).withColumn(name, F.col("_before") + F.col(_AT))
        return placed.select(*df.columns, name)
    earlier = Window.partitionBy(*within).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    pieces = rows.groupBy(*within, _PART).agg(F.count("*").alias("_n"), F.min(_AT).alias("_first"))
    offsets = pieces.select(*within, _PART, (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_before"))
    placed = rows.join(store(offsets, "offsets"), [*within, _PART]).withColumn(name, F.col("_before") + F.col(_AT))
    return placed.select(*df.columns, name)


def running_totals(
    df: DataFrame, order: Sequence[Column | str], values: Sequence[str], within: Sequence[str], store: Store | None = None
) -> DataFrame:
    """Add ``<value>_before`` for each of ``values``: its sum over the rows of the same group that come earlier in the order.

    ``within`` must not hold nulls; a null value counts as 0.
    """
    store = store or default_store(df.sparkSession)
    rows = _in_order(df, [*within, *order], store)
    in_part = Window.partitionBy(_PART, *within).orderBy(_AT).rowsBetween(Window.unboundedPreceding, -1)
    over_parts = Window.partitionBy(*within).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)

    def before(value: str, window) -> Column:
        return F.coalesce(F.sum(value).over(window), F.lit(0))

    pieces = rows.groupBy(*within, _PART).agg(*(F.sum(v).alias(v) for v in values))
    offsets = store(pieces.select(*within, _PART, *(before(v, over_parts).alias(f"_{v}") for v in values)), "offsets")
    inner = rows.select("*", *(before(v, in_part).alias(f"{v}_before") for v in values))
    total = {f"{v}_before": F.col(f"{v}_before") + F.col(f"_{v}") for v in values}
    return inner.join(offsets, [*within, _PART]).withColumns(total).select(*df.columns, *total)
