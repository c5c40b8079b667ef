"""Every registered query against its SQL, on the smallest given tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from check import normal
from tidemark.catalog import ORACLES, QUERIES

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    frame = entry.queries()[name](spark, str(FOLDER))
    result = duck.execute(entry.oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(frame.columns) == sorted(names)
    assert normal(frame.columns, frame.collect()) == normal(names, result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
