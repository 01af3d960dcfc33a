"""Every registered query against its reference SQL on the smallest test tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from salesmart.verification.oracle import ORACLE
from salesmart.verification.queries import registered

SF_DIR = Path("/root/testdata/sf0.001")
QUERIES = registered()

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    yield connection
    connection.close()


def test_every_query_has_reference_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_reference_sql(spark, duck, name):
    got = QUERIES[name](spark, str(SF_DIR))
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(got.columns)
    expected = [tuple(row[names.index(c)] for c in got.columns) for row in result.fetchall()]
    actual = [tuple(row) for row in got.collect()]
    assert actual
    assert sorted(map(repr, actual)) == sorted(map(repr, expected))


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
