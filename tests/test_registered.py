"""Every registered query runs; those with SQL agree with it."""

import pytest
from oracle import connect, difference

from __spark_entry__ import SMOKE_DIR, entry, oracle_sql, queries


@pytest.fixture(scope="module")
def duck():
    return connect(SMOKE_DIR)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, name):
    df = queries()[name](spark, SMOKE_DIR)
    sql = oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert difference(df, duck, sql) is None


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and {"query_id", "rank", "id", "score", "strategy"} <= set(df.columns)
