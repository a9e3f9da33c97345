"""Every registered query against its DuckDB oracle on the smallest tables
(the full sf0.01 comparison is ``python tests/oracle_harness.py``)."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_harness import compare, duck

NAMES = sorted(entry.plans.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    missing = set(entry.plans.QUERIES) - set(entry.oracle_sql())
    assert missing == {"sample_random10"}


def test_entry_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "avg_price" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(got) == 10
        return
    res = con.execute(sql)
    err = compare(got, df.columns, res.fetchall(), [c[0] for c in res.description])
    assert err is None, err
