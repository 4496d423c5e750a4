"""One query per operator over the driver's tables.

The tables hold no tagged files, so three inputs are derived from ``documents``: ``tagged_lines``
(its text cut into lines; a document stands for a file), ``source_lines`` (one metadata line per
document) and ``tokenised`` (text with blanks around punctuation and some words redacted, which makes
the cleanup rules fire).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from passagemill.functions.markup import html_unescape, strip_markup
from passagemill.functions.text import apply_rules, clean_text, collapse_ws, mask_redactions, strip_ws
from passagemill.operators.conversations import format_conversations
from passagemill.operators.ordering import number_rows
from passagemill.operators.parse import marker_lines, parse_lines, parse_sources, source_rejects, source_states
from passagemill.operators.relate import attach_sources, number_copies, ordered_merge, union_batches
from passagemill.operators.split import label_keyed, label_split
from passagemill.plans.audit import Audit
from passagemill.plans.job import SPLIT_BY, build_datasets, keyed_lines, prepare_records, run_job, staging_folder
from passagemill.sinks import preview
from passagemill.sources.files import decode_fallback as decode_lines
from passagemill.sources.files import file_blocks, file_outcomes, list_files, place_blocks, scan_corpus as scan_files
from passagemill.sources.files import number_lines as number_file_lines
from passagemill.storage import store_in

BLOCK_LINES = 40


_splits: dict[str, int] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table. One that has fewer splits than the session has cores is spread over the cores."""
    path = f"{sf_dir}/{name}.parquet"
    df = spark.read.parquet(path)
    if path not in _splits:
        _splits[path] = df.rdd.getNumPartitions()
    cores = spark.sparkContext.defaultParallelism
    return df if _splits[path] >= cores else df.repartition(cores)


def documents(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents")


def text_lines(spark, sf_dir) -> DataFrame:
    """doc_id, lang, pos, value: every line of every text."""
    return documents(spark, sf_dir).select("doc_id", "lang", F.posexplode(F.split("text", "\n")).alias("pos", "value"))


def tagged(value: Column) -> Column:
    """All lines but every fifth carry the mark, with blanks in front."""
    marked = F.concat(F.lit(" \t@@"), F.col("doc_id"), F.lit(" "), value)
    return F.when(F.col("pos") % 5 == 4, value).otherwise(marked)


def tagged_lines(spark, sf_dir) -> DataFrame:
    return text_lines(spark, sf_dir).withColumn("value", tagged(F.col("value")))


def as_file_lines(lines: DataFrame) -> DataFrame:
    """Document lines in the shape of a file scan: a document is a file, cut into blocks of lines."""
    start = F.floor(F.col("pos") / BLOCK_LINES) * BLOCK_LINES
    return lines.select(
        F.col("doc_id").cast("string").alias("uri"), F.col("doc_id").alias("task"), start.alias("block_start"),
        F.lit(BLOCK_LINES).alias("block_length"), F.col("pos").cast("long").alias("pos"), "value",
    )


def document_files(spark, sf_dir) -> DataFrame:
    name = F.col("doc_id").cast("string")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select(name.alias("uri"), name.alias("file"), F.col("doc_id").alias("file_order"))


def scratch(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``; only a local session may do without that setting."""
    if spark.conf.get("spark.checkpoint.dir", None) is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return staging_folder(spark, "/tmp/passagemill")


def numbered_lines(spark, sf_dir) -> DataFrame:
    """line, file, file_order, line_num, sequence."""
    lines = as_file_lines(tagged_lines(spark, sf_dir))
    return number_file_lines(lines, place_blocks(file_blocks(lines), document_files(spark, sf_dir)))


def source_lines(spark, sf_dir) -> DataFrame:
    """One metadata line per document; the Spanish ones lack their last fields."""
    head = F.concat_ws("  ", F.lit(" "), "doc_id", "n_chars", "lang", F.lit(1990) + F.col("doc_id") % 30)
    tail = F.concat_ws("\t", "source", F.concat(F.lit("T"), F.col("doc_id")), F.concat(F.lit("about  "), "source"))
    line = F.concat(head, F.lit("\t"), F.when(F.col("lang") == "es", F.lit("")).otherwise(tail), F.lit(" "))
    return documents(spark, sf_dir).select(line.alias("value"))


def sources(spark, sf_dir) -> DataFrame:
    return parse_sources(source_lines(spark, sf_dir))


def label_sources(spark, sf_dir) -> DataFrame:
    """Two sources for each labelled document, one per label; spelled with colons in a row, they are alike."""
    labels = table(spark, sf_dir, "labels")
    named = F.stack(F.lit(2), F.lit("quality"), F.col("quality"), F.lit("toxic"), F.col("toxic"))
    return labels.select("doc_id", named.alias("label", "mark")).select(
        F.col("doc_id").cast("string").alias("id"), F.col("mark").cast("string").alias("words"),
        F.col("label").alias("genre"), F.when(F.col("label") == "quality", "2000").alias("year"), F.lit("s").alias("source"),
        F.when(F.col("label") == "quality", "t:u").otherwise("t").alias("title"),
        F.when(F.col("label") == "quality", "p").otherwise("u:p").alias("pubInfo"),
    )


def tokenised(spark, sf_dir) -> DataFrame:
    spaced = F.regexp_replace("text", "([.,;:!?()'&*])", " $1 ")
    return documents(spark, sf_dir).select("doc_id", F.regexp_replace(spaced, " (the|und|le|la) ", " @ @ ").alias("text"))


# Queries


def marker_filter(spark, sf_dir):
    return marker_lines(tagged_lines(spark, sf_dir)).select("doc_id", F.col("pos").cast("long").alias("pos"), "line")


def parsed_lines(spark, sf_dir):
    return parse_lines(marker_filter(spark, sf_dir))


def rejects(spark, sf_dir):
    return source_rejects(source_lines(spark, sf_dir))


def strip_collapse(spark, sf_dir):
    text = F.concat(F.lit("  \n"), F.col("text"), F.lit(" \t"))
    return documents(spark, sf_dir).select(
        "doc_id", strip_ws(text).alias("stripped"), collapse_ws(text).alias("collapsed")
    )


def redactions(spark, sf_dir):
    return tokenised(spark, sf_dir).select("doc_id", mask_redactions(F.col("text")).alias("masked"))


def rules(spark, sf_dir):
    return tokenised(spark, sf_dir).select("doc_id", apply_rules(F.col("text")).alias("text"))


def cleaned(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", clean_text(F.col("text")).alias("content"))


def cleaned_tokenised(spark, sf_dir):
    return tokenised(spark, sf_dir).select("doc_id", clean_text(F.col("text")).alias("content"))


def page_text(mode: str):
    def query(spark, sf_dir):
        return table(spark, sf_dir, "pages").select("page_id", strip_markup(F.col("html"), mode).alias("text"))

    return query


def page_clean(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", clean_text(F.col("html")).alias("content"))


def unescaped(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", html_unescape(F.col("html")).alias("text"))


def line_numbers(spark, sf_dir):
    return numbered_lines(spark, sf_dir).select("file", "file_order", "line_num", "sequence", "line")


def decode_fallback(spark, sf_dir):
    """French and German texts as Latin-1 bytes, the others as UTF-8; all come back as they were."""
    latin1 = F.encode(F.col("value"), "ISO-8859-1").cast("string")
    encoded = F.when(F.col("lang").isin("fr", "de"), latin1).otherwise(F.col("value"))
    lines = as_file_lines(text_lines(spark, sf_dir).withColumn("value", encoded))
    return decode_lines(lines, file_blocks(lines)).select(
        F.col("uri").cast("long").alias("doc_id"), "pos", F.col("value").alias("line")
    )


def tagged_files(spark, sf_dir) -> DataFrame:
    """The texts with marks in front of their lines, to be written as text files."""
    lines = F.transform(
        F.split("text", "\n"),
        lambda value, pos: F.when(pos % 5 == 4, value).otherwise(F.concat(F.lit(" \t@@"), F.col("doc_id"), F.lit(" "), value)),
    )
    return documents(spark, sf_dir).select(F.array_join(lines, "\n").alias("value"))


def scan_corpus(spark, sf_dir):
    """The texts written as a tree of tagged text files, then scanned.

    Which file a document lands in is up to the tasks that write, so places are given relative to the
    first tagged line of the document.
    """
    root = scratch(spark)
    tagged_files(spark, sf_dir).write.text(root)
    parsed = parse_lines(scan_files(spark, root))
    document = Window.partitionBy("id")
    return parsed.select(
        "id", "content",
        (F.col("line_num") - F.min("line_num").over(document)).alias("line_num"),
        (F.col("sequence") - F.min("sequence").over(document)).alias("sequence"),
    )


def content(spark, sf_dir) -> DataFrame:
    return parse_lines(numbered_lines(spark, sf_dir))


def attached(spark, sf_dir):
    return attach_sources(content(spark, sf_dir), sources(spark, sf_dir))


def attach_duplicates(how: str):
    def query(spark, sf_dir):
        return attach_sources(content(spark, sf_dir), label_sources(spark, sf_dir), how, hot_share=1e-3)

    return query


def merged_in_order(spark, sf_dir):
    merged = attach_sources(content(spark, sf_dir), label_sources(spark, sf_dir))
    return ordered_merge(merged).select("sequence", "id", "genre", "words")


def split(spark, sf_dir):
    """Whole merged rows, several sources to a line, with nulls and colons in them."""
    merged = attach_sources(content(spark, sf_dir), number_copies(label_sources(spark, sf_dir)))
    return label_split(merged, by=SPLIT_BY)


def merged_documents(spark, sf_dir) -> DataFrame:
    """A document as one passage with its source."""
    passages = documents(spark, sf_dir).select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("content"))
    return attach_sources(passages, sources(spark, sf_dir))


def records(spark, sf_dir):
    year = F.when(F.col("genre") == "fr", F.lit(None)).when(F.col("genre") == "de", "c.").otherwise(F.col("year"))
    return format_conversations(merged_documents(spark, sf_dir).withColumn("year", year), keep=["id"])


def flat(df: DataFrame, *keep: Column | str) -> DataFrame:
    one, two = F.get("conversations", F.lit(0)), F.get("conversations", F.lit(1))
    return df.select(
        *keep, "source", "score", one["from"].alias("from1"), one["value"].alias("value1"),
        two["from"].alias("from2"), two["value"].alias("value2"), F.size("conversations").cast("long").alias("messages"),
    )


def records_flat(spark, sf_dir):
    return flat(records(spark, sf_dir), "id")


def batches(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "lang", "n_chars", "source", "text")
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", F.lit("label").alias("lang"), F.col("quality").cast("long").alias("n_chars"),
        F.col("toxic").cast("string").alias("source"), F.lit("").alias("text"),
    )
    return union_batches([docs, docs.select("n_chars", "text", "doc_id", "lang", "source"), labels])


def first_records(spark, sf_dir):
    return preview(records(spark, sf_dir).orderBy(F.col("id").cast("long")))


def audit(spark, sf_dir):
    """All counts while two tables are written: the sources, and the keys of the merged rows."""
    counts, store = Audit(), store_in(scratch(spark))
    metadata = source_lines(spark, sf_dir)
    loaded, rejected = source_states(metadata)
    watched = counts.watch(metadata, sources_loaded=loaded, sources_rejected=rejected)
    source_table = store(number_copies(parse_sources(watched)), "sources")
    keys = store(keyed_lines(numbered_lines(spark, sf_dir), source_table, audit=counts).select("shuffle_key"), "keys")
    in_train = F.col("split") == "train"
    counts.watch(label_keyed(keys), train_rows=in_train, eval_rows=~in_train).write.format("noop").mode("overwrite").save()
    return counts.table(spark)


def corpus_to_datasets(spark, sf_dir):
    """Tagged lines and source lines to records, with the side each record goes to."""
    lines = as_file_lines(tagged_lines(spark, sf_dir))
    prepared = prepare_records(lines, document_files(spark, sf_dir), sources(spark, sf_dir), scratch(spark))
    sides = [prepared.side(name).withColumn("split", F.lit(name)) for name in ("train", "eval")]
    return flat(union_batches(sides), "split")


def written_tree(spark, sf_dir) -> str:
    """The texts as files ``lang=../bucket=../``, one per folder, in the order of doc_id; returns their root.

    Every fifth line is untagged. Lines of even buckets end in CR and LF, French and German files are Latin-1.
    """
    root = f"{scratch(spark)}/corpora"
    bucket = F.lpad((F.col("doc_id") % 40).cast("string"), 2, "0")
    lines = F.transform(
        F.split("text", "\n"),
        lambda value, pos: F.when(pos % 5 == 4, value).otherwise(F.concat(F.lit(" \t@@"), F.col("doc_id"), F.lit(" "), value)),
    )
    value = F.when(F.col("doc_id") % 40 % 2 == 0, F.array_join(lines, "\r\n")).otherwise(F.array_join(lines, "\n"))
    encoded = F.when(F.col("lang").isin("fr", "de"), F.encode(value, "ISO-8859-1").cast("string")).otherwise(value)
    docs = documents(spark, sf_dir).select("doc_id", "lang", bucket.alias("bucket"), encoded.alias("value"))
    one_task_each = docs.repartition("lang", "bucket").sortWithinPartitions("lang", "bucket", "doc_id")
    one_task_each.select("lang", "bucket", "value").write.partitionBy("lang", "bucket").text(root)
    return root


def folder_of(file: str) -> Column:
    return F.regexp_extract(file, "(lang=[^/]*/bucket=[^/]*)/[^/]*$", 1)


def listed_files(spark, sf_dir):
    """The files of a tree with several levels, in order, by their folders."""
    return list_files(spark, written_tree(spark, sf_dir)).select(folder_of("file").alias("folder"), "file_order")


def tree_lines(spark, sf_dir):
    """A tree of files in two encodings and with two kinds of line ends, scanned: places and lineage as the library gives them."""
    return scan_files(spark, written_tree(spark, sf_dir)).withColumn("file", folder_of("file"))


def spoil(spark: SparkSession, uri: str) -> None:
    """Flip the first byte of a file behind the back of the file system, which keeps checksums (a local one; others do not let us)."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
    raw = path.getFileSystem(spark._jsc.hadoopConfiguration()).getRawFileSystem()
    read = raw.open(path)
    data = bytes(read.readAllBytes())
    read.close()
    out = raw.create(path, True)
    out.write(bytearray([data[0] ^ 1]) + bytearray(data[1:]))
    out.close()


def without_bad_files(spark, sf_dir):
    """A tree whose first file cannot be read, scanned with bad files left out; with the outcome of the file of each line."""
    root = written_tree(spark, sf_dir)
    first = list_files(spark, root).where("file_order = 0").first()
    spoil(spark, first["uri"])
    bad = {r["uri"]: r["outcome"] for r in file_outcomes(spark, root).where("outcome <> 'read'").collect()}
    lines = scan_files(spark, root, skip_bad_files=True).select(folder_of("file").alias("folder"), "file_order", "line_num", "line")
    return lines.withColumn("left_out", F.lit(", ".join("first" if uri == first["uri"] else uri for uri in sorted(bad))))


def source_file(spark, sf_dir) -> str:
    """A metadata file in Latin-1 with a blank line behind each line."""
    path = f"{scratch(spark)}/sources"
    value = F.encode(F.concat("value", F.lit("\n \t")), "ISO-8859-1").cast("string")
    source_lines(spark, sf_dir).select(value).write.text(path)
    return path


def datasets(spark, sf_dir):
    """The lazy data sets of a tree of files, with the side of each record."""
    found = build_datasets(spark, written_tree(spark, sf_dir), source_file(spark, sf_dir))
    return flat(union_batches([df.withColumn("split", F.lit(side)) for side, df in (("train", found.train), ("eval", found.eval))]), "split")


def job(spark, sf_dir):
    """A tree of files and a metadata file, the public job over them, and both outputs read back: side and place of each record."""
    result = run_job(spark, written_tree(spark, sf_dir), source_file(spark, sf_dir), f"{scratch(spark)}/out", keep_staging=False)
    sides = []
    for path in result.paths:
        rows = flat(spark.read.parquet(path), F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
        placed = number_rows(rows, ["file", "row"], (), "place").drop("file", "row")
        sides.append(placed.withColumn("split", F.lit(path.rpartition("_")[2].removesuffix(".parquet"))))
    return union_batches(sides)


QUERIES = {
    "marker_filter": marker_filter,
    "parse_lines": parsed_lines,
    "parse_sources": sources,
    "source_rejects": rejects,
    "strip_collapse": strip_collapse,
    "mask_redactions": redactions,
    "apply_rules": rules,
    "clean_text": cleaned,
    "clean_tokenised": cleaned_tokenised,
    "clean_pages": page_clean,
    "strip_markup": page_text("parser"),
    "strip_markup_native": page_text("native"),
    "html_unescape": unescaped,
    "number_lines": line_numbers,
    "decode_fallback": decode_fallback,
    "scan_corpus": scan_corpus,
    "attach_sources": attached,
    "attach_duplicates": attach_duplicates("auto"),
    "attach_duplicates_salted": attach_duplicates("salted"),
    "ordered_merge": merged_in_order,
    "exact_split": split,
    "format_conversations": records,
    "format_conversations_flat": records_flat,
    "union_batches": batches,
    "preview": first_records,
    "audit_counts": audit,
    "corpus_to_datasets": corpus_to_datasets,
    "run_job": job,
    "build_datasets": datasets,
    "list_files": listed_files,
    "scan_tree": tree_lines,
    "skip_bad_files": without_bad_files,
}
