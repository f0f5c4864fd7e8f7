"""Every query of the suite against its SQL on DuckDB; those of the subpackage llm have tests of their own."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from barloom.suite import QUERIES
from barloom.suite_sql import SQL

SF_DIR = os.environ.get("SUITE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in sorted(os.listdir(SF_DIR)):
        if file.endswith(".parquet"):
            connection.execute(f"create view {file[:-8]} as select * from '{SF_DIR}/{file}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_every_query_is_registered():
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    relation = duck.execute(f"select {', '.join(chr(34) + c + chr(34) for c in columns)} from ({SQL[name]})")
    kinds = {c[0]: str(c[1]) for c in relation.description}
    assert kinds == {f.name: KINDS[f.dataType.simpleString()] for f in df.schema}
    key = lambda row: tuple((v is None, v) for v in row)
    expected = sorted(relation.fetchall(), key=lambda row: repr(key(row)))
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda row: repr(key(row)))
    assert len(got) == len(expected) > 0
    assert got == expected
