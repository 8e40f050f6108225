"""Queries that SQL can express, against their twins."""

import pytest

from opsloom.llm.queries import oracle_sql, queries
from oracle_check import connect, difference


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_twin(spark, sf, name):
    assert difference(queries()[name](spark, sf), connect(sf), oracle_sql()[name]) is None
