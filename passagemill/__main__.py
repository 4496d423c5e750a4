"""Run the job: ``spark-submit --py-files passagemill.zip passagemill/__main__.py`` or ``python -m passagemill``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from passagemill.operators.split import SEED, TRAIN_RATIO
from passagemill.plans.job import run_job


def main() -> None:
    parser = argparse.ArgumentParser(prog="passagemill", description="Tagged text files to train and eval data sets.")
    parser.add_argument("--corpus", default="corpora", help="folder of .txt files with @@ lines")
    parser.add_argument("--sources", default="sources.txt", help="source-metadata file")
    parser.add_argument("--output", default="output", help="base name of the two data sets")
    parser.add_argument("--ratio", type=float, default=TRAIN_RATIO, help="share of training rows")
    parser.add_argument("--seed", type=int, default=SEED)
    parser.add_argument("--markup", choices=("parser", "native"), default="parser")
    parser.add_argument("--overwrite", action="store_true")
    args = parser.parse_args()

    spark = SparkSession.builder.appName("passagemill").getOrCreate()
    result = run_job(
        spark, args.corpus, args.sources, args.output, args.ratio, args.seed, args.markup,
        write_mode="overwrite" if args.overwrite else "errorifexists",
    )
    result.audit.show(100, truncate=False)
    if result.preview is not None:
        result.preview.show(truncate=False)


if __name__ == "__main__":
    main()
