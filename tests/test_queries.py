"""Every registered query against its SQL."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from showloom import plans

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = {name: build for name, build in contract.queries().items() if name in plans.QUERIES}
SQL = contract.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in os.listdir(FOLDER):
        table = name.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{name}'")
    return connection


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    got = QUERIES[name](spark, FOLDER)
    columns = sorted(got.columns)
    rows = Counter(tuple(r) for r in got.select(*columns).collect())
    result = duck.execute(SQL[name])
    order = sorted(range(len(result.description)), key=lambda i: result.description[i][0])
    assert columns == [result.description[i][0] for i in order]
    assert rows == Counter(tuple(r[i] for i in order) for r in result.fetchall())


def test_contract(spark):
    assert set(SQL) <= set(contract.queries())
    assert contract.entry(spark).count() > 0
