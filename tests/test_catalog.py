"""Registered queries against their SQL on the small test tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracle import ordered

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables absent")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for path in glob.glob(os.path.join(FOLDER, "*.parquet")):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 4


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    df = entry.queries()[name](spark, FOLDER)
    result = db.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert ordered(df.columns, [tuple(r) for r in df.collect()]) == ordered(names, result.fetchall())


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_query_without_sql_gives_rows(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0
