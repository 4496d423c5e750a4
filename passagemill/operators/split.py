"""Seeded shuffle and exact-count split without a global sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Default share of training rows and default seed.
TRAIN_RATIO = 0.8
SEED = 42

KEY = "shuffle_key"
_BUCKET_DIGITS = 4  # hex digits: 65,536 buckets


def shuffle_key(by: Sequence[str], seed: int = SEED) -> Column:
    """Order key of the shuffle: a hash of the seed and the columns that identify a row.

    Each value goes in with its length, a null as ``-``, so that different rows never spell the same text.
    """
    values = [F.col(c).cast("string") for c in by]
    spelled = [F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    return F.md5(F.concat(F.lit(f"{seed}:"), *spelled))


def key_position() -> Column:
    """Place of the key in the hash range, from 0 to 1; keys are spread evenly over it."""
    return F.conv(F.substring(KEY, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def first_eval_key(keyed: DataFrame, ratio: float = TRAIN_RATIO) -> DataFrame:
    """One row with the key at rank ``floor(n * ratio)``, or no row if that is past the end.

    A histogram over key prefixes (at most 65,536 rows) finds the bucket that holds the rank; only
    that bucket, one row in 65,536, is sorted.
    """
    bucketed = keyed.select(KEY, F.substring(KEY, 1, _BUCKET_DIGITS).alias("bucket"))
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    histogram = (
        bucketed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .withColumn("cut", F.floor(F.sum("n").over(Window.partitionBy()) * F.lit(float(ratio))))
    )
    boundary = histogram.where(
        (F.col("before") <= F.col("cut")) & (F.col("cut") < F.col("before") + F.col("n"))
    ).select("bucket", (F.col("cut") - F.col("before")).alias("skip"))
    # ``boundary`` has at most one row, whatever the data.
    in_bucket = bucketed.join(F.broadcast(boundary), "bucket")
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy(KEY))
    return in_bucket.withColumn("rank", rank).where(F.col("rank") == F.col("skip") + 1).select(KEY)


def label_keyed(keyed: DataFrame, ratio: float = TRAIN_RATIO) -> DataFrame:
    """Add ``split`` to rows that carry a unique ``shuffle_key``: 'train' for the first
    ``floor(n * ratio)`` of them in key order, 'eval' for the others.

    The input is read three times, twice for the key only: hand in a stored table when it is costly
    to compute.
    """
    cut = first_eval_key(keyed, ratio).scalar()
    in_train = F.coalesce(F.col(KEY) < cut, F.lit(True))
    return keyed.withColumn("split", F.when(in_train, "train").otherwise("eval"))


def label_split(
    df: DataFrame, ratio: float = TRAIN_RATIO, seed: int = SEED, by: Sequence[str] = ("sequence",)
) -> DataFrame:
    """Add ``shuffle_key`` and ``split``.

    ``by`` must tell any two rows apart (``number_copies`` sees to that where rows may repeat).
    """
    return label_keyed(df.withColumn(KEY, shuffle_key(by, seed)), ratio)


def exact_split(
    df: DataFrame, ratio: float = TRAIN_RATIO, seed: int = SEED, by: Sequence[str] = ("sequence",)
) -> tuple[DataFrame, DataFrame]:
    """(train, eval): disjoint, complete, with exact sizes; both keep ``shuffle_key``."""
    labelled = label_split(df, ratio, seed, by)
    train, rest = (labelled.where(F.col("split") == side).drop("split") for side in ("train", "eval"))
    return train, rest
