"""Every catalogued query with an oracle equals its DuckDB SQL (row count,
column names and order-insensitive values) on the smallest data set."""

import pytest

from conftest import SF_ORACLE

import __spark_entry__ as entry
from tools.oracle_check import canon, duck_connect

ORACLES = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SF_ORACLE)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_ORACLE)
    rows = df.collect()
    cur = duck.execute(ORACLES[key])
    drows = cur.fetchall()
    dcols = [d[0] for d in cur.description]
    sc, sr = canon(df.columns, rows)
    dc, dr = canon(dcols, drows)
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr


def test_every_query_has_a_builder():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) >= 200


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["category", "total", "alerts", "alert_rate_pct"]
    assert df.count() >= 0
