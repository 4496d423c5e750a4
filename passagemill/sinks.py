"""Parquet output and preview."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passagemill.operators.split import KEY, key_position
from passagemill.schemas import RECORD, conform

# Rows of a preview, and bytes that a record takes besides its texts.
PREVIEW_ROWS = 5
RECORD_BYTES = 192


def in_shuffled_order(df: DataFrame, partitions: int, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """Rows in ``shuffle_key`` order over ``partitions`` consecutive partitions, key dropped.

    The key is a hash, so equal slices of its range [low, high) hold equally many rows; the partition
    follows from the key and no sampling pass over the data is needed.
    """
    slot = F.floor((key_position() - F.lit(low)) / F.lit(max(high - low, 1e-9)) * F.lit(partitions))
    slot = F.least(F.greatest(slot, F.lit(0)), F.lit(partitions - 1)).cast("int")
    return df.repartitionById(partitions, slot).sortWithinPartitions(KEY).drop(KEY)


def row_bytes(records: DataFrame) -> int:
    """What records take as rows, about. A stored table is smaller, by far where texts repeat, and tells little of what a task reads
    of it in a shuffle. Runs a job: meant for stored tables."""
    texts = F.aggregate(
        "conversations", F.lit(0).cast("long"), lambda total, message: total + F.coalesce(F.octet_length(message["value"]), F.lit(0))
    )
    row = RECORD_BYTES + texts + F.coalesce(F.octet_length("source"), F.lit(0))
    return records.agg(F.sum(row)).first()[0] or 0


def _location(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it knows it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def require_free(spark: SparkSession, base: str, mode: str) -> None:
    """Raise if the mode forbids to write over what is there."""
    if mode in ("error", "errorifexists"):
        for side in ("train", "eval"):
            files, where = _location(spark, f"{base}_{side}.parquet")
            if files.exists(where):
                raise FileExistsError(f"{base}_{side}.parquet")


def remove(spark: SparkSession, path: str) -> None:
    files, where = _location(spark, path)
    files.delete(where, True)


def write_datasets(
    train: DataFrame, held_out: DataFrame, base: str, ratio: float, partitions: int, mode: str = "errorifexists"
) -> list[str]:
    """Write ``<base>_train.parquet`` and ``<base>_eval.parquet``, in the declared schema; an empty side is not written.

    Both sides are written beside their places and then renamed: a job that fails leaves what was there before, both sides of it.
    With ``overwrite`` an earlier pair goes, also its side that is empty now; with ``errorifexists`` both paths are looked at before
    either is written; ``append`` adds to them in place, and ``ignore`` leaves a side that is there.

    Both inputs carry ``shuffle_key``. ``partitions`` is the number of files of both sides together.
    """
    spark = train.sparkSession
    require_free(spark, base, mode)
    sides = {}
    for df, side, low, high in ((train, "train", 0.0, ratio), (held_out, "eval", ratio, 1.0)):
        if not df.isEmpty():
            files = max(1, round(partitions * (high - low)))
            sides[side] = conform(in_shuffled_order(df, files, low, high), RECORD).write.option("compression", "snappy")
    places = {side: f"{base}_{side}.parquet" for side in ("train", "eval")}
    if mode not in ("error", "errorifexists", "overwrite"):
        for side, writer in sides.items():
            writer.mode(mode).parquet(places[side])
        return [places[side] for side in sides]
    beside = f"{base}_unfinished-{uuid4().hex}"
    try:
        for side, writer in sides.items():
            writer.parquet(f"{beside}/{side}")
        _swap_in(spark, {places[s]: f"{beside}/{s}" if s in sides else None for s in places}, beside)
    finally:
        remove(spark, beside)
    return [places[side] for side in sides]


def _swap_in(spark: SparkSession, new: dict[str, str | None], aside: str) -> None:
    """Put each new folder in its place (None: nothing), what was there aside; if that fails, everything goes back."""
    moved: list[tuple[str, str]] = []

    def move(source: str, target: str) -> None:
        files, where = _location(spark, source)
        if not files.rename(where, _location(spark, target)[1]):
            raise OSError(f"cannot move {source} to {target}")
        moved.append((source, target))

    try:
        for i, (place, folder) in enumerate(new.items()):
            files, where = _location(spark, place)
            if files.exists(where):
                _location(spark, aside)[0].mkdirs(_location(spark, aside)[1])
                move(place, f"{aside}/old-{i}")
            if folder is not None:
                move(folder, place)
    except Exception:
        for source, target in reversed(moved):
            files, where = _location(spark, target)
            files.rename(where, _location(spark, source)[1])
        raise


def preview(df: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    """Source and message count of the first ``n`` records."""
    messages = F.concat(F.lit("["), F.size("conversations").cast("string"), F.lit(" messages]"))
    return df.select("source", messages.alias("conversations")).limit(n)
