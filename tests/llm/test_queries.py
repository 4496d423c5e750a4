"""The registered queries: against SQL where there is one, else against the rows they promise."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from passagemill.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_one_query_per_operator_and_the_pipeline():
    names = set(contract.queries())
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14)) and names >= {*QUERIES, "pipeline"}
    assert set(contract.oracle_sql()) <= names


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    cursor = con.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    found = QUERIES[name](spark, SF)
    assert sorted(found.columns) == sorted(columns)
    assert Counter(tuple(r) for r in found.select(*columns).collect()) == Counter(cursor.fetchall())


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith(("op1_", "op2_", "op6_", "op9_", "op11_", "op13_"))))
def test_one_row_per_document(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = [r.doc_id for r in QUERIES[name](spark, SF).select("doc_id").collect()]
    assert sorted(found) == sorted(r.doc_id for r in docs.select("doc_id").collect())
