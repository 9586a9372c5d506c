"""Every registered query with SQL, against an independent engine on the smallest test set."""

import math
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as registered
from tests.conftest import DATA

QUERIES = registered.core_queries()
SQL = {name: sql for name, sql in registered.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in os.listdir(DATA):
        connection.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{DATA}/{name}'")
    return connection


def _sorted(rows):
    return sorted(
        (tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in row) for row in rows), key=repr
    )


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, duck, name):
    mine = QUERIES[name](spark, DATA)
    theirs = duck.sql(SQL[name])
    columns = sorted(mine.columns)
    assert columns == sorted(theirs.columns)
    places = [theirs.columns.index(column) for column in columns]
    found = _sorted(tuple(row[column] for column in columns) for row in mine.collect())
    assert found == _sorted(tuple(row[i] for i in places) for row in theirs.fetchall())
    assert found


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_scores_cover_everyone(spark):
    rows = QUERIES["score_batch"](spark, DATA).collect()
    assert len({r.customer_unique_id for r in rows}) == len(rows) == registered.entry(spark).count()
    assert all(r.is_probability and r.prediction_fits and r.risk_fits for r in rows)


def test_the_library_works_where_the_training_data_package_cannot_be_imported():
    code = "import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'churn_gold' in e.queries())"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    said = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout.split()
    assert said[0] == said[1] == str(len(registered.core_queries())) and said[2] == "True"
