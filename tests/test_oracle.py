"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from opsloom.plans import oracle, registry
from oracle_check import connect, difference

ROWS_ONLY = {"latency_approx"}


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_query_has_a_twin():
    assert set(registry.queries()) - set(oracle.oracle_sql()) == ROWS_ONLY
    assert set(oracle.oracle_sql()) <= set(registry.queries())
    assert set(registry.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, sf, name):
    df = entry.queries()[name](spark, sf)
    if name in ROWS_ONLY:
        assert df.count() > 0
    else:
        assert difference(df, con, entry.oracle_sql()[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "priority_score" in df.columns
