"""The registered queries and their oracle SQL.

``rounded`` names the double columns that are rounded on both sides: sums of doubles differ in the last
digits with the order of addition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, rounded: dict[str, int] | None = None):
    """Register a query; adding 0.0 turns a rounded -0.0 into 0.0."""
    rounded = rounded or {}

    def add(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            df = fn(spark, folder)
            return df.withColumns({c: F.round(c, p) + F.lit(0.0) for c, p in rounded.items()})

        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            text = sql.strip()
            if rounded:
                parts = ", ".join(f"round({c}, {p}) + 0.0 AS {c}" for c, p in rounded.items())
                text = f"SELECT * REPLACE ({parts}) FROM (\n{text}\n)"
            ORACLES[name] = text
        return fn

    return add
