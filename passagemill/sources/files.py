"""Scan of a directory tree of text files: decoding, line numbers and the global line sequence.

A text scan gives no line numbers and no per-file encoding, and neither can be had from one task
per file once files are large. Both come from a small table with one row per file block (what one
scan task reads of one file), built in a first pass:

    read_lines  ->  file_blocks   (per block: lines, tagged lines, valid UTF-8?
         |               |         per file:  encoding, offsets of its blocks)
         +------ join ---+  ->  number_lines

The second pass must see the same blocks as the first. The block keys carry the task and the byte
range, and a tagged line that finds no block stops the job instead of getting a wrong number. Files that
shrink, grow or vanish between the passes show in ``changed_files``, which ``run_job`` consults.

Order and offsets are distributed prefix sums (``operators.ordering``): no task sees all files, or all
blocks of a file. Lines meet their block in their scan task, from a broadcast if the block table is
small, else from a table that each task reads by its own number: the text is not shuffled at any size.

Files that cannot be read whole fail the job, or with ``file_outcomes`` are left out whole and listed.
"""

from __future__ import annotations

from typing import NamedTuple
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from passagemill.functions.text import strip_ws
from passagemill.operators.ordering import number_rows, running_totals
from passagemill.operators.parse import MARKER, has_id, is_marked, line_id
from passagemill.operators.relate import fits_broadcast, id_sketch
from passagemill.sources.side_table import look_up, write_side_table
from passagemill.storage import Store, default_store, shared_folder

# Fixed value: distance between the sequence numbers of the first lines of consecutive files.
SEQUENCE_GAP = 2_000_000

BLOCK = ["uri", "task", "block_start", "block_length"]
_PLAINLY_TAGGED = rf"^[\t-\r\x1c-\x20]*+{MARKER}[\x21-\x7e]*+ [\t-\r\x1c-\x20]*+[\x21-\x7e]"
_SCAN_OPTIONS = {
    "recursiveFileLookup": "true",
    "pathGlobFilter": "*.[tT][xX][tT]",
    # A file that cannot be read, or is gone, fails the job, whatever the session's setting: no lines are lost unseen.
    "ignoreCorruptFiles": "false",
    "ignoreMissingFiles": "false",
}


def file_path(uri: Column) -> Column:
    """Plain path of a file URI: percent escapes decoded, a ``file:`` scheme dropped."""
    decoded = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "/")


def list_files(spark: SparkSession, root: str, store: Store | None = None) -> DataFrame:
    """The ``.txt`` files under ``root``: uri, file, file_order.

    Files are numbered from 0, directories top-down with sorted names, then names within one
    directory. Only paths are read; their order is a distributed sort.
    """
    uri = F.col("_metadata.file_path")
    files = spark.read.format("binaryFile").options(**_SCAN_OPTIONS).load(root).select(uri.alias("uri"), file_path(uri).alias("file"))
    directory = F.split(F.regexp_replace("file", "/[^/]*$", ""), "/")
    return number_rows(files, [directory, "file"], (), "file_order", store)


def file_states(spark: SparkSession, root: str) -> DataFrame:
    """uri, length and modified of the ``.txt`` files under ``root``; only the listing is read."""
    listed = spark.read.format("binaryFile").options(**_SCAN_OPTIONS).load(root)
    return listed.select(
        F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def changed_files(before: DataFrame, after: DataFrame) -> DataFrame:
    """uri of each file that was added, removed or rewritten between two ``file_states``."""
    same = ["uri", "length", "modified"]
    return before.select(*same).exceptAll(after.select(*same)).union(after.select(*same).exceptAll(before.select(*same))).select("uri").distinct()


def file_outcomes(spark: SparkSession, root: str, store: Store | None = None) -> DataFrame:
    """One row per ``.txt`` file under ``root``, stored: uri, length, outcome.

    A pass over the bytes that goes on after errors. ``read``: all bytes of the file came. ``cut short``: fewer, an error ended it.
    ``unreadable``: none. ``changed``: the file was rewritten or removed meanwhile. Lines are cut at line feeds only, so their
    bytes and breaks add up to the length, one more without a break at the end, three fewer with a byte-order mark.
    """
    store = store or default_store(spark)
    listed = store(file_states(spark, root), "file_states")
    tolerant = _SCAN_OPTIONS | {"ignoreCorruptFiles": "true", "ignoreMissingFiles": "true", "lineSep": "\n"}
    lines = spark.read.options(**tolerant).text(root).select(F.col("_metadata.file_path").alias("uri"), "value")
    came = lines.groupBy("uri").agg(F.sum(F.octet_length("value").cast("long") + 1).alias("came"))
    after = file_states(spark, root).select("uri", F.struct("length", "modified").alias("now"))
    lost = F.col("length") - F.coalesce("came", F.lit(0))
    outcome = (
        F.when(F.col("now").isNull() | (F.col("now") != F.struct("length", "modified")), "changed")
        .when(F.col("came").isNull(), F.when(F.col("length") == 0, "read").otherwise("unreadable"))
        .when(lost.isin(-1, 0, 2, 3), "read").otherwise("cut short")
    )
    return store(listed.join(came, "uri", "left").join(after, "uri", "left").select("uri", "length", outcome.alias("outcome")), "file_outcomes")


def read_lines(spark: SparkSession, path: str, tolerant: bool = False) -> DataFrame:
    """Every line of the text files under ``path``, as raw bytes in a string, with its block.

    ``pos`` grows by one from line to line within a block. ``tolerant`` goes on where a file cannot be read: only for use with
    the ``file_outcomes`` that say which files to leave out.
    """
    options = _SCAN_OPTIONS | ({"ignoreCorruptFiles": "true", "ignoreMissingFiles": "true"} if tolerant else {})
    pin_split_size(spark)
    return spark.read.options(**options).text(path).select(
        F.col("_metadata.file_path").alias("uri"),
        F.spark_partition_id().alias("task"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col("_metadata.file_block_length").alias("block_length"),
        F.monotonically_increasing_id().alias("pos"),
        "value",
    )


def pin_split_size(spark: SparkSession) -> None:
    """Keep file splits from depending on how many executors happen to be up.

    For small inputs Spark derives the split size from the current number of cores, which dynamic
    allocation may change between the two passes.
    """
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", spark.sparkContext.defaultParallelism)


def _latin1(value: Column) -> Column:
    return F.decode(value.cast("binary"), "ISO-8859-1")


def count_blocks(lines: DataFrame, store: Store | None = None, with_ids: bool = False) -> DataFrame:
    """One row per block, stored: its lines, its tagged lines in either encoding, and whether it is valid UTF-8.

    ``with_ids`` adds ``sketch``, of the ids of its lines (see ``operators.relate.id_sketch``).
    """
    value = F.col("value")
    as_utf8, as_latin1 = strip_ws(value), strip_ws(_latin1(value))
    # Most lines tell without decoding: no marker at all, or marker, id and text that starts in ASCII.
    untagged = ~F.contains(value, F.lit(MARKER))
    plain = F.rlike(value, F.lit(_PLAINLY_TAGGED))

    def count(test: Column) -> Column:
        return F.count_if(F.when(untagged, False).when(plain, True).otherwise(test))

    sketch = []
    if with_ids:
        line = strip_ws(F.when(F.is_valid_utf8(value), value).otherwise(_latin1(value)))
        lines = lines.withColumn("id", F.when(~untagged & is_marked(line) & has_id(line), line_id(line)))
        sketch = [id_sketch("id").alias("sketch")]
    blocks = lines.groupBy(*BLOCK).agg(
        F.min("pos").alias("first_pos"),
        F.count(F.lit(1)).alias("n_lines"),
        F.bool_and(F.is_valid_utf8(value)).alias("valid"),
        count(is_marked(as_utf8)).alias("marked_utf8"),
        count(is_marked(as_latin1)).alias("marked_latin1"),
        count(is_marked(as_utf8) & has_id(as_utf8)).alias("parsed_utf8"),
        count(is_marked(as_latin1) & has_id(as_latin1)).alias("parsed_latin1"),
        *sketch,
    )
    return (store or default_store(lines.sparkSession))(blocks, "block_counts")


def file_blocks(lines: DataFrame, store: Store | None = None) -> DataFrame:
    """One row per block: its file's encoding, and the lines and tagged lines in front of it. Reads the lines at once."""
    store = store or default_store(lines.sparkSession)
    return ordered_blocks(count_blocks(lines, store), store)


def ordered_blocks(blocks: DataFrame, store: Store) -> DataFrame:
    """``file_blocks`` from the stored counts.

    A line is valid UTF-8 exactly if its bytes are, since line breaks never fall inside a character,
    so a file is UTF-8 if all lines of all its blocks are; otherwise all of it is Latin-1.
    """
    encoding = blocks.groupBy("uri").agg(F.bool_and("valid").alias("utf8"))
    known = blocks.join(encoding, "uri").select(
        *BLOCK, "first_pos", "n_lines", "utf8",
        F.when(F.col("utf8"), F.col("marked_utf8")).otherwise(F.col("marked_latin1")).alias("n_marked"),
        F.when(F.col("utf8"), F.col("parsed_utf8")).otherwise(F.col("parsed_latin1")).alias("n_parsed"),
    )
    placed = running_totals(known, ["block_start"], ["n_lines", "n_marked"], ["uri"], store)
    return placed.withColumnsRenamed({"n_lines_before": "lines_before", "n_marked_before": "marked_before"})


_CHANGED = "file blocks changed between the two passes"


def decode_fallback(lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """Lines with their block's columns and ``value`` decoded with the encoding of their whole file."""
    def checked(name: str) -> Column:
        return F.when(F.col("first_pos").isNull(), F.raise_error(F.lit(_CHANGED))).otherwise(F.col(name)).alias(name)

    met = lines.join(blocks, BLOCK, "left")
    # whatever is used of a line first, be it a filter on its block, stops the job if there is no block
    return _decoded(met.withColumns({name: checked(name) for name in ("value", "skipped") if name in met.columns}))


def _decoded(lines: DataFrame) -> DataFrame:
    return lines.withColumn("value", F.when(F.col("utf8"), F.col("value")).otherwise(_latin1(F.col("value"))))


def place_blocks(blocks: DataFrame, files: DataFrame, outcomes: DataFrame | None = None) -> DataFrame:
    """Add ``file`` and ``file_order`` to each block, ``skipped`` (its file is one to leave out, by its outcome, and counts no
    tagged lines) and the tagged lines in front of it in its scan task."""
    placed = blocks.join(files.select("uri", "file", "file_order"), "uri")
    if outcomes is None:
        placed = placed.withColumn("skipped", F.lit(False))
    else:
        bad = outcomes.where("outcome <> 'read'").select("uri", F.lit(True).alias("bad"))
        placed = placed.join(bad, "uri", "left").withColumn("skipped", F.col("bad").isNotNull()).drop("bad")
        kept = {n: F.when(F.col("skipped"), 0).otherwise(F.col(n)).cast("long") for n in ("n_marked", "n_parsed")}
        placed = placed.withColumns(kept)
    # a scan task has few blocks: each counts as spark.sql.files.openCostInBytes of its size at least
    in_task = Window.partitionBy("task").orderBy("first_pos").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("marked_before_in_task", F.coalesce(F.sum("n_marked").over(in_task), F.lit(0)))


#: What a line takes over from its block.
_TAKEN = {
    "utf8": "boolean", "skipped": "boolean", "first_pos": "long", "file_order": "long", "lines_before": "long", "marked_before": "long",
    "marked_before_in_task": "long",
}


def number_lines(lines: DataFrame, blocks: DataFrame, map_side: bool = False, side_table: str | None = None) -> DataFrame:
    """Tagged lines with their place: line (stripped), file, file_order, line_num, sequence. Lines of skipped files are left out.

    ``line_num`` counts all lines of the file from 0; ``sequence`` is the file's base plus the running
    number of tagged lines from 1.

    With ``map_side=True`` the lines stay in their scan task, of which ``lines`` must come straight, and the running number is
    the position after the filter. ``blocks`` is broadcast (the caller has checked its size), or read from ``side_table``, the path
    of a table made by ``write_side_table``, by each task for itself. Otherwise the lines are shuffled by block and ranked inside
    it; a block is never larger than a file split.
    """
    # A line without the bytes of the marker is untagged in either encoding: it need not meet its block.
    told = lines.where(F.contains("value", F.lit(MARKER)))
    if side_table is not None:
        met = told.withColumn("block", look_up(side_table, BLOCK, _TAKEN)).select("*", "block.*").withColumn("file", file_path(F.col("uri")))
        decoded = _decoded(met)
    else:
        decoded = decode_fallback(told, F.broadcast(blocks) if map_side else blocks)
    marked = decoded.where("NOT skipped").withColumn("line", strip_ws(F.col("value"))).where(is_marked(F.col("line")))
    if map_side or side_table is not None:
        # Lower 33 bits of the id: row position in the task.
        position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        rank = position + 1 - F.col("marked_before_in_task")
    else:
        rank = F.row_number().over(Window.partitionBy(*BLOCK).orderBy("pos"))
    base = F.col("file_order").cast("long") * F.lit(SEQUENCE_GAP)
    return marked.select(
        "line",
        "file",
        F.col("file_order").cast("long").alias("file_order"),
        (F.col("lines_before") + F.col("pos") - F.col("first_pos")).cast("long").alias("line_num"),
        (base + F.col("marked_before") + rank).cast("long").alias("sequence"),
    )


def number_in_place(lines: DataFrame, blocks: DataFrame, folder: str, limit: int | None = None) -> DataFrame:
    """``number_lines`` without a shuffle, for lines straight from ``read_lines`` and a stored table of their blocks.

    The table is broadcast if it has at most ``limit`` bytes (default: ``BROADCAST_BYTES``), else written below ``folder`` for the
    tasks to read their own part of it.
    """
    if fits_broadcast(blocks) if limit is None else fits_broadcast(blocks, limit):
        return number_lines(lines, blocks, map_side=True)
    path = f"{folder}/side_table-{uuid4().hex}"
    write_side_table(blocks, BLOCK, path)
    return number_lines(lines, blocks, map_side=True, side_table=path)


class FirstPass(NamedTuple):
    """What the first pass over a corpus leaves; all but the lines is stored, outcomes only with ``skip_bad_files``."""

    lines: DataFrame
    files: DataFrame
    blocks: DataFrame
    outcomes: DataFrame | None
    counts: DataFrame


def first_pass(spark: SparkSession, root: str, store: Store, skip_bad_files: bool = False, with_ids: bool = False) -> FirstPass:
    """List the files and read the lines once; ``with_ids`` as for ``count_blocks``."""
    outcomes = file_outcomes(spark, root, store) if skip_bad_files else None
    lines = read_lines(spark, root, tolerant=skip_bad_files)
    files = store(list_files(spark, root, store), "files")
    counts = count_blocks(lines, store, with_ids)
    blocks = store(place_blocks(ordered_blocks(counts, store), files, outcomes), "blocks")
    return FirstPass(lines, files, blocks, outcomes, counts)


def scan_corpus(spark: SparkSession, root: str, skip_bad_files: bool = False) -> DataFrame:
    """Tagged lines of all ``.txt`` files under ``root``: line, file, file_order, line_num, sequence.

    The first pass over the corpus runs at once; the rows come from a second one. With ``skip_bad_files`` files that cannot be
    read whole are left out whole (see ``file_outcomes``).
    """
    seen = first_pass(spark, root, default_store(spark), skip_bad_files)
    return number_in_place(seen.lines, seen.blocks, shared_folder(spark))
