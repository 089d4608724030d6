"""Every registered query against its SQL, at the smallest scale."""

import math
import pathlib

import duckdb
import pytest

import __spark_entry__ as contract
from tradeloom.plans import catalog

DIRECTORY = contract.SMOKE_DIR
TABLES = sorted(path.stem for path in pathlib.Path(DIRECTORY).glob("*.parquet"))


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{DIRECTORY}/{table}.parquet'")
    yield connection
    connection.close()


def _sorted_rows(columns, rows):
    order = [columns.index(name) for name in sorted(columns)]
    plain = [tuple(None if isinstance(row[i], float) and math.isnan(row[i]) else row[i] for i in order) for row in rows]
    return sorted(plain, key=lambda row: [(value is not None, value if value is not None else 0) for value in row])


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, DIRECTORY)
    actual = _sorted_rows(df.columns, [tuple(row) for row in df.collect()])
    cursor = duck.execute(contract.oracle_sql()[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert actual == _sorted_rows(columns, cursor.fetchall())


def test_every_job_has_sql():
    assert set(catalog.queries()) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
