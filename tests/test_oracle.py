"""Every registered query against its SQL on the smallest given tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import NAMES, table

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in NAMES:
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    columns, rows = table(df.columns, [tuple(r) for r in df.collect()])
    if name not in entry.oracle_sql():
        assert rows
        return
    result = con.execute(entry.oracle_sql()[name])
    wanted = table([d[0] for d in result.description], result.fetchall())
    assert (columns, rows) == wanted


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
