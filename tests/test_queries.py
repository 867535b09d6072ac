"""Every registered query against its SQL, value by value."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = contract.queries(), contract.oracle_sql()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "array<string>": "VARCHAR[]", "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return [plain(v) for v in value] if isinstance(value, (list, tuple)) else repr(value)


def table(columns, rows):
    order = sorted(columns)
    places = [columns.index(c) for c in order]
    return order, sorted(([plain(r[p]) for p in places] for r in rows), key=repr)


def test_every_query_has_its_sql():
    from tierline.fixtures.queries import QUERIES as own

    assert set(own) <= set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, database, name):
    df = QUERIES[name](spark, SF)
    result = database.execute(ORACLE[name])
    sql_columns = [c[0] for c in result.description]
    assert table(df.columns, df.collect()) == table(sql_columns, result.fetchall())
    kinds = {c[0]: str(c[1]) for c in result.description}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == kinds


def test_entry(spark):
    assert contract.entry(spark).count() > 0
