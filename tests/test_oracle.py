"""Each registered query against its SQL in DuckDB, on the same tables."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as registered

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
# DuckDB's name of each Spark type that the queries return.
TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS FROM '{FOLDER}/{name}.parquet'")
    yield connection
    connection.close()


def _rows(table, columns):
    return Counter(zip(*[table.column(name).to_pylist() for name in columns]))


def test_every_query_of_the_library_itself_has_sql():
    own = {name for module in registered.LIBRARY for name in module.QUERIES}
    assert own <= set(registered.oracle_sql()) <= set(registered.queries())


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_query_equals_sql(spark, database, name):
    result = registered.queries()[name](spark, FOLDER)
    relation = database.sql(registered.oracle_sql()[name])
    expected_types = dict(zip(relation.columns, map(str, relation.types)))
    assert {column: TYPES[kind] for column, kind in result.dtypes} == expected_types

    columns = sorted(result.columns)
    found = _rows(result.toArrow(), columns)
    wanted = _rows(relation.to_arrow_table(), columns)
    assert found.total() > 0
    assert found == wanted
