"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from verification.compare import duck_rows, spark_rows
from verification.oracle import ORACLE
from verification.queries import QUERIES

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@needs_tables
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    columns, rows = spark_rows(spark, name, SF)
    expected_columns, expected = duck_rows(name, SF)
    assert columns == expected_columns and rows == expected and rows


@needs_tables
def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "split" in df.columns
