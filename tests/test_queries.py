"""Every named query against its SQL counterpart in DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from eventweir.plans import catalog, oracles

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["orders", "events", "documents"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def ordered(rows):
    return sorted(tuple((v is not None, str(v)) for v in row) for row in rows)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(oracles.oracle_sql())
    assert set(catalog.QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", catalog.QUERIES)
def test_query(spark, duck, name):
    result = contract.queries()[name](spark, SF_DIR)
    columns = sorted(result.columns)
    expected = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in expected.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    want = ordered([row[p] for p in places] for row in expected.fetchall())
    got = ordered(result.select(*[f"`{c}`" for c in columns]).collect())
    assert got == want and got


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.columns == ["session_id", "timestamp", "item_id", "price", "quantity"]
    assert rows.count() == 154
