"""Every registered query against its SQL, on the smallest of the given scales."""

from pathlib import Path

import duckdb
import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries
from newsloom.workload.oracles import ORACLES
from newsloom.workload.queries import QUERIES

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data here")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in check.TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    verdict, _, _ = check.compare(spark, con, name, str(DATA))
    assert verdict.startswith("ok"), verdict


def test_entry(spark):
    assert entry(spark).columns == ["bucket", "ticker", "score"]
