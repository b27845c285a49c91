"""Wide to long, long to wide."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F


def melt(df: DataFrame, ids: list[str], values: list[str] | None = None, var: str = "variable",
         val: str = "value") -> DataFrame:
    """One row per id and value column. Columns of different types are stacked as text."""
    values = list(values) if values is not None else [c for c in df.columns if c not in ids]
    types = {df.schema[c].dataType for c in values}
    if len(types) > 1:
        df = df.withColumns({c: F.col(c).cast("string") for c in values})
    return df.unpivot(list(ids), values, var, val)


def pivot_counts(df: DataFrame, keys: list[str], kind_col: str, kinds: list[str],
                 fill_zero: bool = False) -> DataFrame:
    """Rows per key and kind, with one column per kind; a kind that does not occur is null or 0.

    The kinds are given, so the plan and the schema are fixed, and counts per (key, kind) are formed before
    the pivot.
    """
    wide = df.groupBy(*keys).pivot(kind_col, list(kinds)).agg(F.count(F.lit(1)))
    return wide.fillna(0, subset=[str(k) for k in kinds]) if fill_zero else wide


def matrix_to_pairs(df: DataFrame, name_col: str, out: tuple[str, str, str] = ("var1", "var2", "value")
                    ) -> DataFrame:
    """Square matrix with a name column to (row name, column name, value) rows."""
    cols = [c for c in df.columns if c != name_col]
    return df.withColumnRenamed(name_col, out[0]).unpivot([out[0]], cols, out[1], out[2])


def concat_columns(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """Source columns with derived ones beside them, in one projection (no join on position)."""
    return df.select("*", *[e.alias(name) for name, e in exprs.items()])


def strip_prefix(df: DataFrame, col: str, prefix: str) -> DataFrame:
    return df.withColumn(col, F.regexp_replace(F.col(col), "^" + re.escape(prefix), ""))
