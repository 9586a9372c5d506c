"""The queries of this package that SQL can express, against an independent engine on the smallest test set."""

import os

import duckdb
import pytest

import __spark_entry__ as registered
from ebbtide.llm import queries, sql
from tests.conftest import DATA


@pytest.mark.parametrize("name", sorted(sql.SQL))
def test_same_rows_as_sql(spark, name):
    connection = duckdb.connect()
    for file in os.listdir(DATA):
        connection.sql(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{DATA}/{file}'")
    mine, theirs = registered.queries()[name](spark, DATA), connection.sql(registered.oracle_sql()[name])
    columns = sorted(mine.columns)
    assert columns == sorted(theirs.columns)
    places = [theirs.columns.index(c) for c in columns]
    found = sorted((tuple(r[c] for c in columns) for r in mine.collect()), key=repr)
    assert found == sorted((tuple(r[i] for i in places) for r in theirs.fetchall()), key=repr) and found


def test_every_operator_is_registered():
    names = registered.queries()
    assert set(queries.QUERIES) < set(names) and "pipeline" in names
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]
