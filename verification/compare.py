"""Run queries on Spark and their SQL on DuckDB and compare the rows.

    python -m verification.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from verification.oracle import ORACLE
from verification.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def plain(value):
    """Rows and structs as plain dicts and lists, the same from both engines."""
    if hasattr(value, "asDict"):
        return plain(value.asDict())
    if isinstance(value, dict):
        return tuple((k, plain(v)) for k, v in value.items())
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def spark_rows(spark: SparkSession, name: str, sf_dir: str) -> tuple[list[str], Counter]:
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    return columns, Counter(tuple(plain(v) for v in row) for row in df.select(*columns).collect())


def duck_rows(name: str, sf_dir: str) -> tuple[list[str], Counter]:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    cursor = con.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = Counter(tuple(plain(row[i]) for i in order) for row in cursor.fetchall())
    return [names[i] for i in order], rows


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "16g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        columns, ours = spark_rows(spark, name, sf_dir)
        seconds = time.time() - start
        expected_columns, expected = duck_rows(name, sf_dir)
        same = columns == expected_columns and ours == expected
        failed += not same
        print(f"{'ok  ' if same else 'FAIL'} {name:28s} rows={ours.total():8d} {seconds:6.2f}s", flush=True)
        if not same:
            print("  columns", columns, expected_columns)
            for label, diff in (("spark only", ours - expected), ("sql only", expected - ours)):
                print(f"  {label}: {diff.total()}", *[repr(r)[:300] for r in list(diff)[:2]], sep="\n    ")
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
