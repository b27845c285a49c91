"""Every query with SQL gives what DuckDB gives."""
import pytest

import __spark_entry__ as entry_points
from tests.oracle import difference

SQL = entry_points.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, folder, name):
    assert difference(entry_points.queries()[name](spark, folder), duck, SQL[name]) is None


def test_entry_has_rows(spark):
    rows = entry_points.entry(spark).collect()
    assert rows and rows[0].engaged_users > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry_points.queries())
