"""Every registered query against its SQL on the same tables, exact values."""

import os

import pytest

import __spark_entry__ as entry
from compare import connect, duck_rows, spark_rows
from trackside.plans.stand_in_sql import SQL
from trackside.plans.stand_ins import QUERIES

FOLDER = os.environ.get("QUERY_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "FLOAT": "float",
    "VARCHAR": "string",
    "TIMESTAMP": "timestamp_ntz",
}


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    described = con.execute("DESCRIBE " + entry.oracle_sql()[name]).fetchall()
    assert dict(df.dtypes) == {row[0]: TYPES.get(row[1], row[1]) for row in described}
    columns, rows = spark_rows(df)
    want_columns, want = duck_rows(con, entry.oracle_sql()[name])
    assert columns == want_columns
    assert len(rows) == len(want)
    wrong = [(a, b) for a, b in zip(rows, want) if a != b]
    assert not wrong, (len(wrong), wrong[:5])


def test_entry(spark):
    assert entry.entry(spark).count() > 0
