"""From a corpus folder and a source-metadata file to train and eval data sets."""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from passagemill.functions.text import clean_text
from passagemill.operators.conversations import format_conversations
from passagemill.operators.parse import parse_lines, parse_sources, source_states
from passagemill.operators.relate import attach_sources, fits_broadcast, hot_in_sketches, number_copies, pack_sources
from passagemill.operators.split import KEY, SEED, TRAIN_RATIO, exact_split, first_eval_key, key_position, shuffle_key
from passagemill.plans.audit import Audit
from passagemill.schemas import MERGED, conform
from passagemill.sinks import preview, remove, require_free, row_bytes, write_datasets
from passagemill.sources.files import (
    BLOCK, changed_files, count_blocks, file_states, first_pass, number_in_place, number_lines, ordered_blocks, place_blocks,
)
from passagemill.sources.metadata import read_metadata_lines
from passagemill.storage import Store, default_store, shared_folder, store_in

# What tells two merged rows apart: the line, and the source row joined to it.
SPLIT_BY = ("file_order", "line_num", "words", "genre", "year", "source", "title", "pubInfo", "copy")
SLICE_MARGIN = 0.01
TARGET_FILE_BYTES = 512 << 20


class NoDataError(Exception):
    """A stage of the job has no rows."""


class CorpusChangedError(Exception):
    """A corpus file was added, removed or rewritten between the passes over the corpus."""


@dataclass
class Datasets:
    train: DataFrame
    eval: DataFrame
    audit: DataFrame


@dataclass
class JobResult:
    paths: list[str]
    audit: DataFrame
    preview: DataFrame | None
    staging: str
    skipped: DataFrame | None = None


def assemble(
    lines: DataFrame, sources: DataFrame, how: str = "auto", mode: str = "parser", content_hot: DataFrame | None = None
) -> DataFrame:
    """Parse, clean and join: the merged table, with any further columns of ``sources``.

    Only lines that have a source are cleaned. Broadcast sources are joined twice, first as a
    filter, so that a line is cleaned once even if its id has several sources. For a salted join ``sources`` come from
    ``pack_sources``: a line is moved and cleaned before it meets the single sources.
    """
    parsed = parse_lines(lines)
    cleaned = clean_text(F.col("content"), mode)
    if how == "broadcast":
        wanted = parsed.join(F.broadcast(sources.select("id")), "id", "left_semi")
        return attach_sources(wanted.withColumn("content", cleaned), sources, how)
    if how == "salted":
        met = attach_sources(parsed, sources, how, content_hot=content_hot).withColumn("content", cleaned)
        return met.select(*parsed.columns, F.inline("members"))
    return attach_sources(parsed, sources, how).withColumn("content", cleaned)


def keyed_lines(lines: DataFrame, sources: DataFrame, seed: int = SEED, audit: Audit | None = None) -> DataFrame:
    """Lines with their sources and ``shuffle_key``, parsed but not cleaned. ``sources`` come from ``number_copies``."""
    parsed = parse_lines(lines) if audit is None else audit.watch(parse_lines(audit.watch(lines, "lines_collected")), "rows_before_join")
    joined = attach_sources(parsed, sources)
    return (joined if audit is None else audit.watch(joined, "rows_after_join")).withColumn(KEY, shuffle_key(SPLIT_BY, seed))


def build_datasets(
    spark: SparkSession, corpus: str, sources: str, ratio: float = TRAIN_RATIO, seed: int = SEED,
    mode: str = "parser",
) -> Datasets:
    """The data sets as lazy DataFrames, each of which scans the corpus once and cleans its own lines only.

    What they need to know is found at once: a first pass over the corpus for encodings and line numbers, and one that joins
    ids and sources, without the texts, for the keys and with them the cut. The audit was counted during that pass.
    """
    store, audit = default_store(spark), Audit()
    metadata = read_metadata_lines(spark, sources)
    loaded, rejected = source_states(metadata)
    metadata = audit.watch(metadata, sources_loaded=loaded, sources_rejected=rejected)
    source_table = store(number_copies(parse_sources(metadata)), "sources")
    seen = first_pass(spark, corpus, store)
    numbered = number_in_place(seen.lines, seen.blocks, shared_folder(spark))
    keys = store(keyed_lines(numbered, source_table, seed, audit).select(KEY), "keys")
    cut = first_eval_key(keys, ratio).first()
    in_train = F.lit(True) if cut is None else F.col(KEY) < cut[KEY]
    train_rows, total = keys.agg(F.count_if(in_train), F.count("*")).first()
    audit.note(files_found=seen.files.count(), train_rows=train_rows, eval_rows=total - train_rows)
    merged = keyed_lines(numbered, source_table, seed)
    sides = (
        format_conversations(merged.where(side).withColumn("content", clean_text(F.col("content"), mode)))
        for side in (in_train, ~in_train)
    )
    return Datasets(*sides, audit.table(spark))


def _require(rows: int, what: str) -> int:
    if rows == 0:
        raise NoDataError(what)
    return rows


def staging_folder(spark: SparkSession, fallback: str) -> str:
    """A new folder for stored tables: under ``spark.checkpoint.dir`` if that is set."""
    return f"{spark.conf.get('spark.checkpoint.dir', None) or fallback}/{uuid4().hex}"


@dataclass
class Prepared:
    """Formatted records with ``shuffle_key`` and ``slice``, the key of the first eval record (None if
    there is none), and the counts on the way."""

    records: DataFrame
    cut: str | None
    counts: dict[str, int]
    ratio: float

    def side(self, name: str) -> DataFrame:
        """The records of 'train' or 'eval'."""
        if self.cut is None:
            return self.records if name == "train" else self.records.where("false")
        cut_slice = sum(int(self.cut[:8], 16) / (1 << 32) >= e for e in _slice_edges(self.ratio))
        if name == "train":
            return self.records.where((F.col("slice") <= cut_slice) & (F.col(KEY) < self.cut))
        return self.records.where((F.col("slice") >= cut_slice) & (F.col(KEY) >= self.cut))


def _slice_edges(ratio: float) -> list[float]:
    return [ratio - SLICE_MARGIN, ratio + SLICE_MARGIN]


def prepare_records(
    lines: DataFrame, files: DataFrame, sources: DataFrame, staging: str, ratio: float = TRAIN_RATIO,
    seed: int = SEED, mode: str = "parser",
) -> Prepared:
    """Everything up to the split, for lines in the shape of ``read_lines`` from wherever, with stored tables below ``staging``."""
    store = store_in(staging)
    joined = _stored_sources(sources, store)
    counts = count_blocks(lines, store, with_ids=joined.packed is not None)
    blocks = store(place_blocks(ordered_blocks(counts, store), files), "blocks")
    return _records(number_lines(lines, blocks), blocks, counts, joined, staging, ratio, seed, mode)


@dataclass
class StoredSources:
    """The number of sources, and their table: single if it can be broadcast, else packed."""

    rows: int
    single: DataFrame
    packed: DataFrame | None


def _stored_sources(sources: DataFrame, store: Store) -> StoredSources:
    table = store(number_copies(sources), "sources")
    return StoredSources(table.count(), table, None if fits_broadcast(table) else store(pack_sources(table), "packed_sources"))


def _records(
    numbered: DataFrame, blocks: DataFrame, block_counts: DataFrame, sources: StoredSources, staging: str, ratio: float, seed: int, mode: str
) -> Prepared:
    """The records as a stored table. The size of the sources has decided on their broadcast; if they are packed, the first pass
    has left sketches of the ids."""
    spark, audit = numbered.sparkSession, Audit()

    def stored(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
        df.write.partitionBy(*partition_by).parquet(f"{staging}/{name}")
        return spark.read.schema(df.schema).parquet(f"{staging}/{name}")

    n_sources = _require(sources.rows, "no source line could be read")
    read = blocks.where("NOT skipped").agg(
        F.count_distinct("uri").alias("files"), F.sum("n_marked").alias("marked"), F.sum("n_parsed").alias("parsed")
    ).first()
    _require(read["marked"] or 0, "no tagged line was found")
    _require(read["parsed"] or 0, "no tagged line could be parsed")

    numbered = audit.watch(numbered, "lines_numbered")
    if sources.packed is None:
        merged = assemble(numbered, sources.single, "broadcast", mode)
    else:
        hot = stored(hot_in_sketches(block_counts.select(*BLOCK, "parsed_utf8", "sketch"), "parsed_utf8"), "hot_ids")
        merged = assemble(numbered, sources.packed, "salted", mode, hot)
    # Stored in three slices: surely train, around the cut, surely eval. Each side reads its own
    # slices only; which rows it takes is decided by the exact key.
    keyed = conform(merged, StructType([*MERGED, StructField("copy", LongType())])).withColumn(KEY, shuffle_key(SPLIT_BY, seed))
    slices = sum(((key_position() >= e).cast("int") for e in _slice_edges(ratio)), F.lit(0))
    records = stored(format_conversations(keyed.withColumn("slice", slices), keep=[KEY, "slice"]), "records", "slice")
    if audit.count("lines_numbered") < read["marked"]:  # more than there are can be counted when tasks run again, never fewer
        raise CorpusChangedError("lines seen by the first pass over the corpus were not seen by the second")
    n_records = _require(records.count(), "no line has a source")  # from the files' footers
    cut = first_eval_key(records, ratio).first()
    counts = {
        "files_processed": read["files"],
        "lines_collected": read["marked"],
        "sources_loaded": n_sources,
        "rows_before_join": read["parsed"],
        "rows_after_join": n_records,
    }
    return Prepared(records, cut and cut[KEY], counts, ratio)


def run_job(
    spark: SparkSession, corpus: str, sources: str, output_base: str, ratio: float = TRAIN_RATIO,
    seed: int = SEED, mode: str = "parser", target_file_bytes: int = TARGET_FILE_BYTES,
    write_mode: str = "errorifexists", keep_staging: bool = True, skip_bad_files: bool = False,
) -> JobResult:
    """Run everything and write ``<output_base>_train.parquet`` and ``<output_base>_eval.parquet``, both or none.

    Tables stored on the way stay in ``JobResult.staging`` unless ``keep_staging`` is false, then they go also if the job fails. A
    corpus file that is added, removed or rewritten while the job reads stops it: ``CorpusChangedError``. A file that cannot be
    read stops it too, or with ``skip_bad_files`` is left out whole: ``JobResult.skipped`` lists them (uri, length, outcome).
    The corpus is read twice, three times with ``skip_bad_files``; its text is shuffled once, into output order. The task that writes
    a file reads and sorts rows of about ``target_file_bytes``; the file is as much smaller as Parquet packs them.
    """
    require_free(spark, output_base, write_mode)
    staging = staging_folder(spark, f"{output_base}_staging")
    try:
        return _run(spark, corpus, sources, output_base, staging, ratio, seed, mode, target_file_bytes, write_mode, keep_staging, skip_bad_files)
    finally:
        if not keep_staging:
            remove(spark, staging)


def _run(spark, corpus, sources, output_base, staging, ratio, seed, mode, target_file_bytes, write_mode, keep_staging, skip_bad_files) -> JobResult:
    store, audit = store_in(staging), Audit()
    before = store(file_states(spark, corpus), "listing")
    metadata = read_metadata_lines(spark, sources)
    loaded, rejected = source_states(metadata)
    metadata = audit.watch(metadata, sources_read=loaded, sources_rejected=rejected)
    sources_read = _stored_sources(parse_sources(metadata), store)
    lines, _, blocks, outcomes, block_counts = first_pass(spark, corpus, store, skip_bad_files, with_ids=sources_read.packed is not None)
    numbered = number_in_place(lines, blocks, staging)
    prepared = _records(numbered, blocks, block_counts, sources_read, staging, ratio, seed, mode)
    changed = changed_files(before, file_states(spark, corpus)).limit(3).collect()
    if changed:
        raise CorpusChangedError("the corpus changed while it was read: " + ", ".join(r.uri for r in changed))
    sides = {name: prepared.side(name).drop("slice") for name in ("train", "eval")}
    partitions = max(1, -(-row_bytes(prepared.records) // target_file_bytes))
    paths = write_datasets(sides["train"], sides["eval"], output_base, ratio, partitions, write_mode)

    written = {path: spark.read.parquet(path).count() for path in paths}  # from the files' footers
    train_path, eval_path = (f"{output_base}_{side}.parquet" for side in ("train", "eval"))
    n_files = before.count()
    counts = prepared.counts | {
        "files_found": n_files,
        "files_skipped": n_files - prepared.counts["files_processed"],
        "sources_rejected": audit.count("sources_rejected"),
        "train_rows": written.get(train_path, 0),
        "eval_rows": written.get(eval_path, 0),
    }
    skipped = None
    if outcomes is not None:
        bad = outcomes.where("outcome <> 'read'")
        counts["files_unreadable"] = bad.count()
        skipped = bad if keep_staging else spark.createDataFrame(bad.collect(), bad.schema)
    table = spark.createDataFrame(list(counts.items()), "metric string, value long")
    shown = preview(spark.read.parquet(train_path)) if train_path in written else None
    return JobResult(paths, table, shown, staging, skipped)
