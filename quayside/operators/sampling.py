"""Order, first and last rows, samples, stacking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from quayside.functions.scalars import stable_hash
from quayside.plans.blocks import row_rank


def sort_by(df: DataFrame, keys: list[str], ascending: list[bool] | bool = True,
            nulls: str = "last") -> DataFrame:
    if isinstance(ascending, bool):
        ascending = [ascending] * len(keys)

    def key(name: str, up: bool) -> Column:
        c = F.col(name)
        if nulls == "last":
            return c.asc_nulls_last() if up else c.desc_nulls_last()
        return c.asc_nulls_first() if up else c.desc_nulls_first()

    return df.orderBy(*[key(k, up) for k, up in zip(keys, ascending)])


def head_n(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    return sort_by(df, order).limit(n)


def tail_n(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """Last n in the order, shown in the order."""
    return sort_by(sort_by(df, order, False, nulls="first").limit(n), order)


def top_bottom_k(df: DataFrame, col: str, k: int, tie: list[str]) -> DataFrame:
    """The k highest and the k lowest rows by a measure, marked in ``end`` (a row may be in both)."""
    rows = df.filter(F.col(col).isNotNull())
    top = rows.orderBy(F.desc(col), *tie).limit(k).withColumn("end", F.lit("top"))
    bottom = rows.orderBy(F.asc(col), *tie).limit(k).withColumn("end", F.lit("bottom"))
    return top.unionByName(bottom)


def head_fraction(df: DataFrame, ts: str, fraction: float, tie: list[str], blocks: int | None = None
                  ) -> DataFrame:
    """The earliest share of rows by time: floor(fraction * rows) of them. Rows without a time come last, by ``tie``."""
    late = df.withColumn("_late", F.col(ts).isNull().cast("int"))
    first = row_rank(late.filter("_late = 0"), [], [ts, *tie], "_rank", blocks)
    last = row_rank(late.filter("_late = 1"), [], list(tie), "_rank", blocks)
    timed = df.agg(F.count(ts).alias("n")).scalar()
    size = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    ranked = first.unionByName(last.withColumn("_rank", F.col("_rank") + timed))
    return ranked.filter(F.col("_rank") <= F.floor(size * F.lit(fraction))).drop("_rank", "_late")


def sample_n(df: DataFrame, n: int, key: str, seed: int) -> DataFrame:
    """n rows at random, the same ones on every run and on any cluster."""
    return df.orderBy(stable_hash(F.col(key), seed), key).limit(n)


def sample_columns_independently(df: DataFrame, cols: list[str], n: int, key: str, seed: int) -> DataFrame:
    """n made-up rows, each column drawn from that column's own rows."""
    out = None
    for i, c in enumerate(cols):
        draw = df.select(stable_hash(F.col(key), f"{seed}.{i}").alias("_h"), key, c)
        draw = draw.orderBy("_h", key).limit(n)
        # n rows, the size asked for, are numbered here; the table itself is not.
        numbered = draw.select(F.row_number().over(W.orderBy("_h", key)).alias("row"), c)
        out = numbered if out is None else out.join(numbered, "row")
    return out


def union_all(*dfs: DataFrame) -> DataFrame:
    """Stack frames whose column names and types agree."""
    first = dict(dfs[0].dtypes)
    for df in dfs[1:]:
        if dict(df.dtypes) != first:
            raise ValueError(f"columns differ: {dfs[0].dtypes} and {df.dtypes}")
    out = dfs[0]
    for df in dfs[1:]:
        out = out.unionByName(df)
    return out


def distinct_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """How many different combinations of the columns occur."""
    return df.select(*cols).distinct().agg(F.count(F.lit(1)).alias("n"))


def split_back(df: DataFrame, source_col: str, sources: list) -> dict:
    """The parts of a stacked frame, by a column that says where a row came from.

    No row is lost: those of other kinds, or of none, are a part named None, which keeps the column.
    """
    listed = F.coalesce(F.col(source_col).isin(list(sources)), F.lit(False))
    parts = {s: df.filter(F.col(source_col) == s).drop(source_col) for s in sources}
    return {**parts, None: df.filter(~listed)}
