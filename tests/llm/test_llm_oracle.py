"""Queries with SQL, against DuckDB on the test tables."""

import pytest

from quayside.llm import ORACLES, QUERIES
from tests.oracle import difference


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, folder, duck, name):
    assert difference(QUERIES[name](spark, folder), duck, ORACLES[name]) is None
