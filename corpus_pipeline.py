"""The corpus pipeline: stages over ``documents``, each written as Parquet and read back as the next one's input.

Rows are told apart by what they hold, never by doc_id alone: rows that share a doc_id, or have none, are judged each for itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passagemill.llm import decontaminate, mixing, quality, simhash, token_files
from passagemill.llm.queries import END_ID, default_tokenizer
from passagemill.llm.shared import row_key, settings, store


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Low-quality and toxic documents go (op2)."""
    return quality.keep_resampled(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates stays: that with the smallest doc_id, then key; of repeated rows one (op1)."""
    keyed = docs.select(F.struct("*").alias("row"), row_key(*docs.columns))
    found = store(simhash.near_duplicates(docs, row_key(*docs.columns)).select("doc_id", "component", "row_key"), "groups")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    first = store(found.groupBy("component").agg(F.min(order).alias("first")).select("first.row_key"), "first_rows")
    gone = store(found.select("row_key").distinct().join(first, "row_key", "left_anti"), "copies")
    repeated = store(found.groupBy("row_key").count().where("count > 1").select("row_key").join(first, "row_key", "left_semi"), "repeated_rows")
    left = keyed.join(gone, "row_key", "left_anti")
    if not repeated.isEmpty():
        once = left.join(repeated, "row_key", "left_semi").dropDuplicates(["row_key"])
        left = left.join(repeated, "row_key", "left_anti").unionByName(once)
    return left.select("row.*")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, re-parameterised or not, go (op3)."""
    found = decontaminate.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    gone = store(found.select("row_key").distinct(), "contaminated_rows")
    return docs.select(F.struct("*").alias("row"), row_key("doc_id", "text")).join(gone, "row_key", "left_anti").select("row.*")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of rare sources again up to the limit on passes (op5)."""
    return mixing.repeat_documents(docs)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each row of the mixture, read back from the token files (op6)."""
    return token_files.token_digest(docs, default_tokenizer(), END_ID)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", classify),
    ("simhash_near_dedup", deduplicate),
    ("benchmark_decontamination", decontaminated),
    ("source_mixing", mixed),
    ("token_files", tokenised),
]

#: No SQL states the fingerprints and the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            with settings(spark, {"spark.sql.parquet.compression.codec": "zstd"}):  # whole texts, kept until the run is over
                docs = store(docs, name)
    return docs
