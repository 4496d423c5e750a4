"""Headline queries, timed: one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the cores. Every
query runs to the end with its rows discarded; one untimed run on the smallest tables warms up the JVM
and the Python workers.
"""

from __future__ import annotations

import json
import os
import re
import time
from pathlib import Path

from pyspark.sql import SparkSession

from verification.queries import QUERIES

HEADLINE = (
    "corpus_to_datasets", "clean_text", "clean_tokenised", "apply_rules", "strip_markup", "clean_pages", "number_lines",
    "scan_corpus", "attach_sources", "attach_duplicates", "exact_split", "format_conversations", "parse_lines", "audit_counts", "run_job",
)


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.time()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.time() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("passagemill-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    smallest = str(Path(sf_dir).parent / "sf0.001")
    for name in HEADLINE:
        run(spark, name, smallest if os.path.isdir(smallest) else sf_dir)
    seconds = {name: round(run(spark, name, sf_dir), 3) for name in HEADLINE}
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    result = {
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else None,
        "cpus": int(cpus),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
