"""Every relational query against its DuckDB twin (sf0.001 here; the
driver repeats this at sf0.01)."""

import pytest

from conftest import SF_SMALL
from keelson.plans.queries import SQL_QUERIES
from oracle import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", sorted(SQL_QUERIES))
def test_query_matches_oracle(spark, con, key):
    fn, sql = SQL_QUERIES[key]
    got = fn(spark, SF_SMALL).toPandas()
    want = con.sql(sql).df()
    ok, msg = compare(got, want)
    assert ok, f"{key}: {msg}"


def test_entry_contract(spark):
    import __spark_entry__ as E

    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0]["r2"] > 0.9
