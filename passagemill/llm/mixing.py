"""Temperature mixing of sources, with DataFrame functions only.

A source's weight is its token share raised to an exponent, normalised. The exponent is found by bisection (64 sections
per round, one aggregation each): the largest that meets the target entropy, raised if some source would otherwise be
repeated more often than the limit. A weight becomes a token budget, a budget so many whole passes over the source and a
part of one more; that part takes the source's blocks in a seeded permutation until its budget is used up.

A document finds its block by hash, so blocks are formed without sorting, and a partial pass is a prefix of the
permutation: one cut value per source says which blocks are in it. Documents therefore only meet one row of their source.
Sums are combined before each shuffle; the cut is found in a histogram of ``BINS`` bins per source, then within one bin.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from passagemill.llm.shared import store

ENTROPY_SHARE = 0.95
MAX_PASSES = 2.0
BLOCK_TOKENS = 1 << 14
SEED = 17
BINS = 1024
#: Exponents are multiples of 1 / GRID.
GRID = 1 << 18
SECTIONS = 64


def count_words(text: Column) -> Column:
    """Runs of characters other than blank and U+0009 to U+000D; null: 0."""
    parts = F.split(F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r")), r"[\x20\x09-\x0D]+")
    return F.when(parts[0] == "", 0).otherwise(F.size(parts)).cast("long")


def _key(source: Column) -> Column:
    """Joins on it treat a null source as one of its own."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def _own(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id", "source", _key(F.col("source")).alias("source_key"), count_words(F.col("text")).alias("n_tokens"),
        F.xxhash64("doc_id", "text", F.lit(SEED)).alias("row_key"),
    )


def _unit(*parts: Column) -> Column:
    """A hash of the parts, evenly spread over [0, 1)."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def _block(row_key: Column, n_blocks: Column) -> Column:
    return F.pmod(row_key, n_blocks)


def _turn(epoch: Column) -> Column:
    """Where a block stands in the permutation of a pass."""
    return _unit(F.col("source_key"), F.col("block"), epoch, F.lit(SEED))


def find_exponent(totals: DataFrame, entropy_share: float, max_passes: float, budget: int | None) -> float:
    """The exponent for ``totals`` (source_key, tokens > 0), a multiple of 1/GRID between 0 and 1."""

    def holds(low: int, step: int) -> list[tuple[int, bool, bool]]:
        grid = F.explode(F.sequence(F.lit(low), F.lit(min(GRID, low + SECTIONS * step)), F.lit(step))).alias("at")
        raised = totals.select("tokens", grid).withColumn("log_w", F.col("at") / GRID * F.ln("tokens"))
        peak = math.log(top)
        w = F.exp(F.col("log_w") - F.col("at") / GRID * peak)  # at most 1 each
        stats = raised.groupBy("at").agg(
            F.sum(w).alias("z"), F.sum(w * F.ln(w)).alias("wlnw"), F.count("*").alias("n"),
            F.max(w / F.col("tokens")).alias("most"), F.min(w / F.col("tokens")).alias("least"),
        )
        entropy = F.ln("z") - F.col("wlnw") / F.col("z")
        passes = F.col("most") / F.col("least") if budget is None else F.col("most") * budget / F.col("z")
        even = entropy >= entropy_share * F.ln(F.col("n").cast("double")) - 1e-9
        return sorted((r.at, r.even, r.few) for r in stats.select("at", even.alias("even"), (passes <= max_passes + 1e-9).alias("few")).collect())

    top = totals.agg(F.max("tokens")).first()[0]
    found = []
    for which in (1, 2):  # entropy falls with the exponent, so does the largest number of passes
        low, step = 0, GRID // SECTIONS
        while True:
            points = holds(low, step)
            fits = [p[0] for p in points if p[which]]
            best = (max(fits, default=0) if which == 1 else min(fits, default=GRID))
            if step == 1:
                break
            low = best if which == 1 else max(0, best - step)
            step //= SECTIONS
        found.append(best)
    return max(found) / GRID


def plan_sources(
    own: DataFrame, entropy_share: float = ENTROPY_SHARE, max_passes: float = MAX_PASSES, budget: int | None = None,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per source: source_key, tokens, weight, passes, whole (passes), n_blocks, cut.

    ``own``: source_key, n_tokens, row_key. ``budget``: tokens of the mixture; None: the smallest one that takes no source
    less than once. A source without tokens gets weight 0 and one pass. ``cut`` bounds the blocks of the partial pass.
    """
    totals = store(own.groupBy("source_key").agg(F.sum("n_tokens").alias("tokens")), "totals")
    spoken = totals.where("tokens > 0")
    if spoken.isEmpty():
        exponent, norm, scale = 1.0, 1.0, 0.0
    else:
        exponent = find_exponent(spoken, entropy_share, max_passes, budget)
        raised = F.exp(exponent * F.ln("tokens"))
        norm, rarest = spoken.agg(F.sum(raised), F.min(raised / F.col("tokens"))).first()
        scale = norm / rarest if budget is None else float(budget)
    weight = F.when(F.col("tokens") > 0, F.exp(exponent * F.ln("tokens")) / norm).otherwise(0.0)
    passes = F.when(F.col("tokens") > 0, F.col("weight") * scale / F.col("tokens")).otherwise(1.0)
    plan = totals.withColumn("weight", weight).withColumn("passes", F.round(passes, 6))
    plan = plan.withColumn("whole", F.floor("passes")).withColumn(
        "n_blocks", F.greatest(F.lit(1), F.ceil(F.col("tokens") / block_tokens)).cast("long")
    )
    plan = store(plan.withColumn("rest", ((F.col("passes") - F.col("whole")) * F.col("tokens")).cast("long")), "plan")
    cut = plan.join(_cuts(own, plan), "source_key", "left").withColumn("cut", F.coalesce("cut", F.lit(-1.0))).drop("rest")
    return store(cut, "sources")  # its size is known from here on: Spark broadcasts it if it is small


def _cuts(own: DataFrame, plan: DataFrame) -> DataFrame:
    """source_key, cut: the last block's place in the permutation that the partial budget still pays for."""
    wanted = plan.where("rest > 0").select("source_key", "n_blocks", "whole", "rest")
    placed = own.join(wanted, "source_key").withColumn("block", _block(F.col("row_key"), F.col("n_blocks")))
    blocks = placed.groupBy("source_key", "block", "whole", "rest").agg(F.sum("n_tokens").alias("tokens"))
    turn = _turn(F.col("whole"))
    blocks = store(blocks.select("source_key", "rest", "tokens", turn.alias("turn"), F.floor(turn * BINS).alias("bin")), "blocks")
    bins = blocks.groupBy("source_key", "rest", "bin").agg(F.sum("tokens").alias("tokens"), F.max("turn").alias("turn"))
    in_order = Window.partitionBy("source_key").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    bins = bins.withColumn("until", F.sum("tokens").over(in_order)).withColumn("paid", F.col("until") <= F.col("rest"))
    whole = bins.groupBy("source_key").agg(
        F.max(F.when(F.col("paid"), F.col("turn"))).alias("last_bin"),
        F.min(F.when(~F.col("paid"), F.col("bin"))).alias("bin"),
        F.coalesce(F.max(F.when(F.col("paid"), F.col("until"))), F.lit(0)).alias("spent"),
    )
    by_turn = Window.partitionBy("source_key").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    split = blocks.join(whole.where("bin IS NOT NULL").select("source_key", "bin", "spent"), ["source_key", "bin"])
    split = split.withColumn("until", F.col("spent") + F.sum("tokens").over(by_turn)).where("until <= rest")
    within = split.groupBy("source_key").agg(F.max("turn").alias("turn"))
    both = whole.join(within, "source_key", "left")
    return both.select("source_key", F.coalesce("turn", "last_bin").alias("cut"))


def _epochs() -> Column:
    """The passes that a document of the block is in, from 0."""
    partial = F.when(_turn(F.col("whole")) <= F.col("cut"), 1).otherwise(0)
    n = (F.col("whole") + partial).cast("int")
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def mix(docs: DataFrame, **limits) -> DataFrame:
    """doc_id, source, n_tokens, epoch, block, place: one row for each time that a document is in the mixture.

    Needs doc_id, text and source, whatever else there is. ``limits`` go to :func:`plan_sources`. Sorting by ``place`` (0 to 1)
    gives the training order: every source is spread evenly, its blocks permuted anew in each pass. A null source is a source of
    its own; null and empty texts have no tokens and are in every pass of their block. Repeated rows share a block and stay
    repeated; rows without doc_id find theirs by text. Empty input: no rows.
    """
    own = store(_own(docs), "sized")
    placed = _with_epochs(own, plan_sources(own, **limits))
    place = (F.col("epoch") + _turn(F.col("epoch"))) / F.greatest("passes", F.col("epoch") + 1)
    return placed.select("doc_id", "source", "n_tokens", "epoch", "block", place.alias("place"))


def _with_epochs(rows: DataFrame, plan: DataFrame) -> DataFrame:
    met = rows.join(plan, "source_key").withColumn("block", _block(F.col("row_key"), F.col("n_blocks")))
    return met.select("*", F.explode(_epochs()).alias("epoch"))


def repeat_documents(docs: DataFrame, **limits) -> DataFrame:
    """``docs`` with each row as often as the mixture holds it, columns unchanged (for cases see :func:`mix`)."""
    own = store(_own(docs), "sized")
    plan = plan_sources(own, **limits)
    keys = [_key(F.col("source")).alias("source_key"), F.xxhash64("doc_id", "text", F.lit(SEED)).alias("row_key")]
    return _with_epochs(docs.select(F.struct("*").alias("row"), *keys), plan).select("row.*")
