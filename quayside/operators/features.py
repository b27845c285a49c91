"""Encoding, scaling, splitting, weighting."""

from __future__ import annotations

import math

from pyspark.ml.feature import CountVectorizer, OneHotEncoder, StringIndexer
from pyspark.sql import DataFrame, functions as F

from quayside.functions.scalars import stable_hash
from quayside.operators.aggregates import column_profile
from quayside.operators.windows import require_date
from quayside.plans.blocks import row_rank
from quayside.plans.levels import MAX_BROADCAST_ROWS, category_levels


def one_hot(df: DataFrame, col: str, prefix: str, levels: list | None = None) -> DataFrame:
    """Add a 0/1 column ``<prefix><value>`` per level, sorted. Without ``levels`` they are read first."""
    levels = category_levels(df, col) if levels is None else list(levels)
    hit = {f"{prefix}{v}": F.coalesce((F.col(col) == F.lit(v)).cast("int"), F.lit(0)) for v in levels}
    return df.select("*", *[c.alias(name) for name, c in hit.items()])


def multi_hot(df: DataFrame, array_col: str, prefix: str, levels: list | None = None) -> DataFrame:
    """Add a 0/1 column per element that occurs in an array column."""
    if levels is None:
        levels = category_levels(df.select(F.explode(array_col).alias("level")), "level")
    hit = {f"{prefix}{v}": F.coalesce(F.array_contains(array_col, v).cast("int"), F.lit(0)) for v in levels}
    return df.select("*", *[c.alias(name) for name, c in hit.items()])


def one_hot_vector(df: DataFrame, col: str, out: str) -> tuple[DataFrame, list]:
    """Add a sparse 0/1 vector with a place per level, for any number of levels; and the levels in order of place.

    A missing value has no 1. Levels are ordered by frequency, then by name, and are text.
    """
    at, text = f"_{out}_at", f"_{out}_text"
    index = StringIndexer(inputCol=text, outputCol=at, handleInvalid="keep")
    indexed = df.withColumn(text, F.col(col).cast("string"))
    model = index.fit(indexed)
    # "keep" gives a missing value the place after the last, which the encoder drops.
    hot = OneHotEncoder(inputCol=at, outputCol=out, dropLast=True)
    placed = model.transform(indexed)
    return hot.fit(placed).transform(placed).drop(at, text), list(model.labels)


def multi_hot_vector(df: DataFrame, array_col: str, out: str) -> tuple[DataFrame, list[str]]:
    """The same for the elements of an array column; a missing or empty array has no 1."""
    text = f"_{out}_text"
    listed = df.withColumn(text, F.coalesce(F.filter(F.col(array_col).cast("array<string>"), lambda v: v.isNotNull()),
                                            F.array().cast("array<string>")))
    model = CountVectorizer(inputCol=text, outputCol=out, binary=True, vocabSize=2 ** 31 - 1).fit(listed)
    return model.transform(listed).drop(text), list(model.vocabulary)


def min_max_params(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row with a (lo, hi) pair per column."""
    return df.agg(*[F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")).alias(c)
                    for c in cols])


def min_max_scale(df: DataFrame, cols: list[str], params: DataFrame | None = None
                  ) -> tuple[DataFrame, DataFrame]:
    """(x - min) / (max - min); a constant column becomes 0. ``params`` of an earlier call scale new data."""
    params = min_max_params(df, cols) if params is None else params
    p = params.select(F.struct(*cols).alias("p")).scalar()

    def scaled(c):
        lo, hi = F.col("_p")[c]["lo"], F.col("_p")[c]["hi"]
        return (F.col(c) - lo) / F.when(hi > lo, hi - lo).otherwise(F.lit(1.0))

    return df.withColumn("_p", p).withColumns({c: scaled(c) for c in cols}).drop("_p"), params


def z_score_params(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row with a (mean, std) pair per column."""
    return df.agg(*[F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("std")).alias(c) for c in cols])


def z_score(df: DataFrame, cols: list[str], params: DataFrame | None = None) -> DataFrame:
    """(x - mean) / sample standard deviation; null for a constant column.

    ``params`` (of ``z_score_params``) scale rows by the statistics of others, as test rows by those of the train rows.
    """
    params = z_score_params(df, cols) if params is None else params
    stats = params.select(F.struct(*cols).alias("p")).scalar()
    return df.withColumn("_p", stats).withColumns(
        {c: F.try_divide(F.col(c) - F.col("_p")[c]["mean"], F.col("_p")[c]["std"]) for c in cols}).drop("_p")


def columns_out_of_unit(df: DataFrame, cols: list[str]) -> DataFrame:
    """The columns with a value below 0 or above 1, with their ends."""
    ends = min_max_params(df, cols).unpivot([], list(cols), "variable", "ends")
    return ends.select("variable", "ends.lo", "ends.hi").filter((F.col("lo") < 0) | (F.col("hi") > 1))


def auto_category(df: DataFrame, threshold: int = 110) -> DataFrame:
    """The columns to treat as categories: fewer distinct values than the threshold, and not a time."""
    return column_profile(df, threshold).filter("to_category").select("variable", "n_distinct")


def split_random(df: DataFrame, key: str, test: float = 0.25, seed: int = 48, label: str | None = None
                 ) -> tuple[DataFrame, DataFrame]:
    """Train and test parts, the same on every run.

    Without a label each row is decided by the hash of its key alone, with no shuffle. With one, exactly
    round(test * rows) rows of each label go to the test part.
    """
    if label is None:
        in_test = F.pmod(stable_hash(F.col(key), seed), F.lit(10_000)) < F.lit(round(test * 10_000))
        return df.filter(~in_test), df.filter(in_test)
    marked = _ranked_in_level(df, key, label, seed)
    sizes = marked.groupBy("_level").agg(F.floor(F.count(F.lit(1)) * F.lit(test) + 0.5).alias("_wanted"))
    marked = marked.join(sizes, "_level")
    in_test = F.col("_rank") <= F.col("_wanted")
    return (marked.filter(~in_test).select(*df.columns), marked.filter(in_test).select(*df.columns))


def _ranked_in_level(df: DataFrame, key: str, label: str, seed: int) -> DataFrame:
    """Add the rank by hash among the rows with the same label; rows without a label are a level of their own."""
    level = F.to_json(F.struct(F.col(label).alias("v")))  # '{}' where it is missing
    rows = df.withColumns({"_h": stable_hash(F.col(key), seed), "_level": level})
    return row_rank(rows, ["_level"], ["_h", key], "_rank")


def split_time(df: DataFrame, time_col: str, train: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """The first share of the dates, and the rest.

    The distinct dates, which the calendar bounds, are fetched; the cut-off is then a literal that reaches
    the scan as a pushed filter.
    """
    require_date(df, time_col)
    dates = category_levels(df, time_col, MAX_BROADCAST_ROWS)
    last = F.lit(dates[max(0, math.floor(len(dates) * train + 0.5) - 1)])
    return df.filter(F.col(time_col) <= last), df.filter(F.col(time_col) > last)


def fold_assign(df: DataFrame, key: str, k: int = 5, label: str | None = None, seed: int = 48,
                out: str = "fold") -> DataFrame:
    """Add a fold number 0 … k-1. With a label the folds of each label differ by at most one row."""
    if label is None:
        return df.withColumn(out, F.pmod(stable_hash(F.col(key), seed), F.lit(k)).cast("int"))
    ranked = _ranked_in_level(df, key, label, seed)
    return ranked.withColumn(out, F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int")).select(*df.columns, out)


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Add n / (classes * rows of the class), so that each class weighs the same in total; null without a label."""
    sizes = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("_size"))
    every = sizes.agg((F.sum("_size") / F.count(F.lit(1))).alias("s")).scalar()
    weights = sizes.select(label, (F.lit(1.0) / F.col("_size")).alias("_share"))
    return (df.join(weights, label, "left").withColumn(out, every * F.col("_share"))
            .select(*df.columns, out))
