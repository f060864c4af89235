"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from millrace.plans import oracle_sql, queries
from millrace.tables import SCHEMAS
from tools.check import compare

FOLDER = os.environ.get("MILLRACE_TEST_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for table in SCHEMAS:
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, name):
    df = queries()[name](spark, FOLDER)
    rows = [tuple(r) for r in df.collect()]
    sql = oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    result = duck.execute(sql)
    verdict = compare(df.columns, rows, [d[0] for d in result.description], result.fetchall())
    assert verdict.startswith("ok"), verdict
