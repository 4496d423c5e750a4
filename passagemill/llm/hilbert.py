"""Sharding along a Hilbert curve over several metadata columns, for files that can be pruned by any of them.

Each column is quantised into cells of about equal numbers of rows, by cut points: numbers by a sketch, text by the cumulated
counts of its different values, whole ones. The cells are numbered along the curve, and the rows are
sorted by that number and cut into runs whose sizes differ by at most one row (the law ``rows``). Neighbours on the curve are
neighbours in every column, so a shard covers a narrow range of each.

The sort is a range partition by curve index and a hash of the row, so a cell with a third of all rows is spread over many
tasks; a row's place is its place in its partition plus the sizes of the partitions before.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import NumericType

from passagemill.llm.shared import store, store_from_python
from passagemill.operators.ordering import running_totals

BITS = 8
_PLACE_BITS = 33  # of monotonically_increasing_id, below the partition's number


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place on the curve of each row of ``cells`` (n x dimensions, below 2^bits), by Skilling's transform."""
    axes = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    for level in range(bits - 1, 0, -1):
        bit, below = 1 << level, (1 << level) - 1
        for i, axis in enumerate(axes):
            turned = (axis & bit) != 0
            swap = np.where(turned, 0, (axes[0] ^ axis) & below)
            axes[0] = np.where(turned, axes[0] ^ below, axes[0] ^ swap)
            axes[i] = axes[0] if i == 0 else axis ^ swap
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    flip = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(axes[-1] & (1 << level), (1 << level) - 1, 0)
    index = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            index = (index << 1) | (((axis ^ flip) >> level) & 1)
    return index


def number_cuts(df: DataFrame, names: list[str], bits: int = BITS) -> dict[str, list]:
    """2^bits - 1 rising cut points per numeric column, from one mergeable sketch each; none for a column of nulls."""
    if not names:
        return {}
    at = [k / (1 << bits) for k in range(1, 1 << bits)]
    row = df.agg(*(F.percentile_approx(F.col(n).cast("double"), at, 10_000).alias(n) for n in names)).first()
    return {n: sorted(row[n] or []) for n in names}


def text_cuts(df: DataFrame, name: str, bits: int = BITS) -> list[str]:
    """2^bits - 1 rising cut points of a column by whole values, in their bytewise order: what stands where the cumulated counts
    of the different values pass each share of the rows. At most as many rows reach the driver."""
    values = df.select(F.col(name).cast("string").alias("value")).where("value IS NOT NULL").groupBy("value").agg(F.count("*").alias("n"))
    placed = running_totals(values.withColumn("all", F.lit(0)), ["value"], ["n"], ["all"], store)
    total = values.agg(F.sum("n")).first()[0]
    if total is None:
        return []
    cell = F.floor(F.col("n_before") * F.lit(1 << bits) / F.lit(total)).cast("int").alias("cell")
    firsts = sorted(placed.groupBy(cell).agg(F.min("value")).collect())
    cuts: list[str] = []
    for cell_, value in firsts:  # a cell without a value of its own begins where the next one does
        cuts += [value] * (cell_ - len(cuts))
    return cuts


def _curve(kinds: list[str], cuts: list[list], bits: int) -> Column:
    def cells(values: pd.Series, kind: str, edges: list) -> np.ndarray:
        if kind == "number":
            found = np.searchsorted(np.array(edges, float), values.to_numpy(float), side="right")
        else:  # code points and UTF-8 have the same order
            code, different = pd.factorize(values)
            found = np.array([*(bisect_right(edges, v) for v in different), 0], np.int64)[code]
        return np.where(values.isna(), 0, found)

    @pandas_udf("long")
    def place(values: pd.DataFrame) -> pd.Series:
        columns = [cells(v, kind, edges) for (_, v), kind, edges in zip(values.items(), kinds, cuts)]
        return pd.Series(hilbert_index(np.stack(columns, axis=1), bits))

    return place(F.struct(*(f"d{i}" for i in range(len(kinds)))))


def shard_rows(df: DataFrame, dimensions: list[str], n_shards: int, tie: str, bits: int = BITS) -> DataFrame:
    """``df`` with curve_index, shard (0 to n_shards - 1) and slot (gapless from 0 in each shard); columns of these names are replaced.

    Shard sizes differ by at most one row. Rows of equal index are ordered by the column ``tie``, then by a hash of all simple
    columns; repeated rows keep their number. A null dimension is in the first cell. Fewer rows than shards leave shards empty;
    empty input: no rows. ``dimensions`` x ``bits`` may be 62 at most.
    """
    if len(dimensions) * bits > 62:
        raise ValueError("the curve index does not fit a long")
    df = df.drop("curve_index", "shard", "slot")
    kinds = ["number" if isinstance(df.schema[d].dataType, NumericType) else "text" for d in dimensions]
    numbers = number_cuts(df, [d for d, kind in zip(dimensions, kinds) if kind == "number"], bits)
    cuts = [numbers[d] if kind == "number" else text_cuts(df, d, bits) for d, kind in zip(dimensions, kinds)]
    own = (F.col(d).cast("double" if kind == "number" else "string").alias(f"d{i}") for i, (d, kind) in enumerate(zip(dimensions, kinds)))
    numbered = df.select(F.struct("*").alias("row"), *own)
    placed = store_from_python(numbered.select("row", _curve(kinds, cuts, bits).alias("curve_index")), "curve")
    order = ["curve_index", F.col(f"row.{tie}"), F.xxhash64("row")]
    in_order = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    in_order = store(in_order.withColumn("at", F.monotonically_increasing_id()), "in_order")
    part = F.shiftright("at", _PLACE_BITS)
    sizes = sorted(in_order.groupBy(part.alias("part")).count().collect())  # one row per partition
    before = np.cumsum([0] + [s["count"] for s in sizes])
    total = int(before[-1])
    offsets = df.sparkSession.createDataFrame([(s["part"], int(b)) for s, b in zip(sizes, before)], "part long, before long")
    place = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    ranked = in_order.withColumn("part", part).join(F.broadcast(offsets), "part").select("row", "curve_index", place.alias("place"))
    # shard s starts at ceil(s * total / n): the first place whose place * n / total reaches s
    shard = F.expr(f"(place * {n_shards}) div {max(total, 1)}")
    first = F.expr(f"(shard * {total} + {n_shards - 1}) div {n_shards}")
    dealt = ranked.withColumn("shard", shard.cast("int")).withColumn("slot", (F.col("place") - first).cast("long"))
    return dealt.select("row.*", "curve_index", "shard", "slot")


def write_shards(sharded: DataFrame, path: str) -> None:
    """Parquet with one folder per shard, rows in curve order, so that readers skip shards and row groups by their ranges."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
