"""Every registered query against its SQL on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as contract  # noqa: E402
from compare import table  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


def test_sql_belongs_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = table(df.columns, df.collect())
    if name in ORACLES:
        cur = duck.execute(ORACLES[name])
        assert got == table([d[0] for d in cur.description], cur.fetchall())
    else:
        assert got[1]


def test_entry(spark):
    assert contract.entry(spark).count() > 0
