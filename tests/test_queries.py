"""Registered queries against their SQL on the smallest tables."""

import os

import duckdb
import pytest

import workbench
from check_queries import TABLES, normalised

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="no test data")

NAMES = list(workbench.QUERIES)


def test_every_query_has_sql():
    assert set(workbench.QUERIES) == set(workbench.ORACLES)


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    df = workbench.QUERIES[name](spark, SF)
    mine = normalised(df.columns, [tuple(r) for r in df.collect()])
    if name in workbench.ORACLES:
        cursor = con.execute(workbench.ORACLES[name])
        assert mine == normalised([d[0] for d in cursor.description], cursor.fetchall())
