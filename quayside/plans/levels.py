"""Small results used by a large table: category levels that become columns or literals."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

MAX_LEVELS = 10_000
MAX_BROADCAST_ROWS = 200_000


def level_counts(df: DataFrame, col: str, limit: int = MAX_LEVELS) -> dict:
    """Rows per non-null value. Levels become columns or literals, so more than ``limit`` is an error.

    ``features.one_hot_vector`` and ``multi_hot_vector`` take any number of levels.
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    found = counts.limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"{col} has more than {limit} distinct values; keep it in long form instead")
    return {row.v: row.n for row in found}


def category_levels(df: DataFrame, col: str, limit: int = MAX_LEVELS) -> list:
    """Sorted non-null values of a category column."""
    return sorted(level_counts(df, col, limit))


def fetch_small(df: DataFrame, limit: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """The same rows, computed once and kept as literals; more than ``limit`` of them is an error."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows where a small table is expected")
    return df.sparkSession.createDataFrame(rows, df.schema)
