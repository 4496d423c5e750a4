"""Joining content to its sources, and union of tables."""

from __future__ import annotations

from functools import reduce
from math import ceil, isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# An id is hot when it holds more than this share of the rows of one side. At most 1 / HOT_SHARE ids
# per side can, which bounds what is broadcast about them.
HOT_SHARE = 1e-4

# Ids that a sketch tracks: of every id with more than HOT_SHARE of all rows it then knows that it is one.
TRACKED_IDS = 98_304

# Sources of one id that a packed row holds, about.
PACK_RUN = 1000

# Size up to which a table is broadcast.
BROADCAST_BYTES = 256 << 20

# Copies of one row that are unfolded at once.
COPY_RUN = 1 << 16


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the rows of ``df`` take at most ``limit`` bytes. Runs a job: meant for stored tables."""
    strings = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if f.dataType == StringType()]
    row = reduce(Column.__add__, strings, F.lit(16 * (len(df.columns) + 1)))
    return (df.agg(F.sum(row.cast("long"))).first()[0] or 0) <= limit


def _with_string_id(df: DataFrame) -> DataFrame:
    return df if df.schema["id"].dataType == StringType() else df.withColumn("id", F.col("id").cast("string"))


def _hot(df: DataFrame, share: float, name: str) -> DataFrame:
    """Ids above ``share`` of the rows, and the number of parts to cut each into."""
    counts = df.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    limit = F.greatest(counts.select(F.sum("n")).scalar() * F.lit(share), F.lit(1.0))
    return counts.where(F.col("n") > limit).select("id", F.ceil(F.col("n") / limit).cast("int").alias(name))


def id_sketch(column: str) -> Column:
    """Aggregate: a mergeable sketch of the frequent values of ``column``, nulls left out; of bounded size."""
    return F.expr(f"approx_top_k_accumulate({column}, {TRACKED_IDS}) FILTER (WHERE {column} IS NOT NULL)")


def hot_in_sketches(sketches: DataFrame, rows: str, share: float = HOT_SHARE) -> DataFrame:
    """What ``attach_sources`` takes as ``content_hot``, from a stored table of sketches (``sketch``) of ``rows`` rows each.

    Sketches are merged in two steps, so that one task merges about the square root of their number. A count is at most the
    sketches' error too low or high, which moves the number of parts of an id and nothing else.
    """
    groups = max(1, isqrt(sketches.count()))
    merge = F.expr(f"approx_top_k_combine(sketch, {TRACKED_IDS})").alias("sketch")
    group = F.pmod(F.xxhash64(*[c for c in sketches.columns if c != "sketch"]), F.lit(groups)).alias("group")
    partial = sketches.groupBy(group).agg(merge, F.sum(rows).alias("n"))
    merged = partial.agg(merge, F.sum("n").alias("n"))
    found = merged.select("n", F.explode(F.expr(f"approx_top_k_estimate(sketch, {ceil(1 / share)})")).alias("found"))
    limit = F.greatest(F.col("n") * F.lit(share), F.lit(1.0))
    hot = found.where(F.col("found.count") > limit)
    return hot.select(F.col("found.item").alias("id"), F.ceil(F.col("found.count") / limit).cast("int").alias("content_parts"))


def pack_sources(sources: DataFrame, run: int = PACK_RUN) -> DataFrame:
    """id, members: the other columns of the sources of an id, about ``run`` sources to a row. Rows must be distinct.

    A line meets packed rows, and so is moved and cleaned once for each ``run`` of its sources. The dealing in between lets Spark
    split a hot id in the join with the counts.
    """
    columns = [c for c in sources.columns if c != "id"]
    runs = sources.groupBy("id").agg(F.ceil(F.count(F.lit(1)) / run).alias("_runs"))
    dealt = sources.join(runs, "id").withColumn("_run", F.pmod(F.xxhash64(*columns), F.col("_runs"))).repartition("id", "_run")
    return dealt.groupBy("id", "_run").agg(F.collect_list(F.struct(*columns)).alias("members")).select("id", "members")


def _part(parts: str) -> Column:
    """Part of a row within its id, by the row's content, so that a task that is run again agrees."""
    return F.expr(f"cast(pmod(row_hash, {parts}) as int)")


def attach_sources(
    content: DataFrame, sources: DataFrame, how: str = "auto", hot_share: float = HOT_SHARE, content_hot: DataFrame | None = None
) -> DataFrame:
    """Inner join on ``id``: the content columns, then the source columns.

    ``how='auto'`` leaves the strategy to Catalyst and AQE. ``'broadcast'`` is for sources whose size
    the caller has checked. ``'salted'`` is for sources too large for that: ids that are hot on either
    side are cut into parts, and each part of one side meets each part of the other, so no task holds
    all rows of a hot id. ``content_hot`` (see ``hot_in_sketches``) spares reading the content for that; without it its ids are counted.
    """
    content, sources = _with_string_id(content), _with_string_id(sources)
    columns = content.columns + [c for c in sources.columns if c != "id"]
    if how == "auto":
        return content.join(sources, "id").select(*columns)
    if how == "broadcast":
        return content.join(F.broadcast(sources), "id").select(*columns)
    if how != "salted":
        raise ValueError(f"how must be 'auto', 'broadcast' or 'salted', not {how!r}")

    hot = (
        (_hot(content, hot_share, "content_parts") if content_hot is None else content_hot)
        .join(_hot(sources, hot_share, "source_parts"), "id", "full")
        .na.fill(1, ["content_parts", "source_parts"])
    )

    def salted(df: DataFrame, own: str, other: str) -> DataFrame:
        hashed = df.withColumn("row_hash", F.xxhash64(*df.columns))
        joined = hashed.join(F.broadcast(hot), "id", "left").na.fill(1, ["content_parts", "source_parts"])
        return (
            joined.withColumn(own, _part(own + "s"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other + "s") - 1)))
            .drop("row_hash", "content_parts", "source_parts")
        )

    left = salted(content, "content_part", "source_part")
    right = salted(sources, "source_part", "content_part")
    return left.join(right, ["id", "content_part", "source_part"]).select(*columns)


def number_copies(df: DataFrame, name: str = "copy", run: int = COPY_RUN) -> DataFrame:
    """Number the exact copies of each row from 1, which makes every row distinct.

    Copies are counted before the shuffle and unfolded after it. A row with more than ``run`` copies is cut into runs
    of that many, which are dealt out before they are unfolded: no array or task holds more of a row than its runs.
    """
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    few = counted.where(F.col("_copies") <= run)
    few = few.select(*df.columns, F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias(name))
    runs = F.explode(F.sequence(F.lit(0), F.expr(f"(_copies - 1) div {run}"))).alias("_run")
    many = counted.where(F.col("_copies") > run).select("*", runs).repartition("_run", *df.columns)
    first, last = F.col("_run") * run + 1, F.least((F.col("_run") + 1) * run, F.col("_copies"))
    return few.union(many.select(*df.columns, F.explode(F.sequence(first, last)).alias(name)))


def union_batches(batches: list[DataFrame]) -> DataFrame:
    """All rows of tables with the same columns."""
    return reduce(DataFrame.unionByName, batches)


def ordered_merge(merged: DataFrame) -> DataFrame:
    """Merged rows in corpus order; rows of one line follow their source columns."""
    ties = [c for c in ("words", "genre", "year", "source", "title", "pubInfo") if c in merged.columns]
    return merged.orderBy("file_order", "line_num", *ties)
