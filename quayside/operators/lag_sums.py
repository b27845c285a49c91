"""Products of lagged columns added up per series and model: what regressions on lags need of the rows.

Each day of a series gets the values of the days before it as an array, by a window over the series, which the calendar
bounds. The tasks add up z'z of the columns z that a model makes of these rows, and only the sums, one small matrix per
(series, unit), meet to be solved. A unit is a number of lags or an order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

Design = Callable[[pd.DataFrame, np.ndarray], Iterator[tuple[int, np.ndarray]]]


def lagged(days: DataFrame, keep: int, differences: list[int], center: Callable[[int], bool]) -> DataFrame:
    """Rows (series, d, i, n, x, past) of daily (series, ds, y): the i-th value x of the d times differenced series of n
    values, less its mean where ``center(d)`` says so, the mean, and the ``keep`` values before it, 0 before the first."""
    known = days.filter(F.nanvl("y", F.lit(None)).isNotNull()).select("series", "ds", "y")
    order, out = W.partitionBy("series").orderBy("ds"), None
    for d in differences:
        w: Column | str = "y"
        rows = known
        for _ in range(d):
            rows = rows.withColumn("y", F.col("y") - F.lag("y").over(order)).filter(F.col("y").isNotNull())
        whole = W.partitionBy("series")
        mean = F.avg(w).over(whole) if center(d) else F.lit(0.0)
        rows = rows.select("series", "ds", F.lit(d).alias("d"), F.count(F.lit(1)).over(whole).alias("n"),
                           (F.row_number().over(order) - 1).alias("i"), mean.alias("mean"), F.col(w).alias("y"))
        rows = rows.withColumn("x", F.col("y") - F.col("mean"))
        if keep:
            before = F.collect_list("x").over(order.rowsBetween(-keep, -1))
            rows = rows.withColumn("past", before)
            rows = rows.withColumn("past", F.concat(F.array_repeat(F.lit(0.0), keep - F.size("past")), "past"))
        else:
            rows = rows.withColumn("past", F.array().cast("array<double>"))
        out = rows if out is None else out.unionByName(rows)
    return out


def lags(past: np.ndarray, first: int, last: int) -> np.ndarray:
    """Columns x[t - first] … x[t - last] of rows with their past, the latest value of which is the last."""
    width = past.shape[1]
    return past[:, [width - k for k in range(first, last + 1)]]


def per_series(pdf: pd.DataFrame) -> Iterator[tuple[object, int, pd.DataFrame, np.ndarray]]:
    """(series, d, rows, past) of the parts of a batch."""
    for (series, d), rows in pdf.groupby(["series", "d"], dropna=False, sort=False):
        yield (None if series is None or series is np.nan else series), d, rows, np.array(rows["past"].tolist(), float)


def gram_sums(rows: DataFrame, design: Design) -> DataFrame:
    """(series, unit, gram): z'z of what ``design(rows, past)`` makes of the rows of one series and d, by unit, added up.

    The last column of z is the one that is regressed on the others.
    """
    kind = rows.schema["series"].dataType.simpleString()

    def add(batches):
        total: dict = {}
        for pdf in batches:
            for series, _, part, past in per_series(pdf):
                for unit, z in design(part, past):
                    gram = z.T @ z
                    total[series, unit] = total[series, unit] + gram if (series, unit) in total else gram
        if total:
            yield pd.DataFrame({"series": [s for s, _ in total], "unit": [u for _, u in total],
                                "gram": [g.ravel().tolist() for g in total.values()]})

    summed = rows.mapInPandas(add, f"series {kind}, unit int, gram array<double>")
    entries = summed.select("series", "unit", F.posexplode("gram").alias("at", "v"))
    added = entries.groupBy("series", "unit", "at").agg(F.sum("v").alias("v"))
    return added.groupBy("series", "unit").agg(
        F.array_sort(F.collect_list(F.struct("at", "v"))).getField("v").alias("gram"))


def square(gram) -> np.ndarray:
    gram = np.asarray(gram, float)
    return gram.reshape(round(len(gram) ** 0.5), -1)


def solved(gram: np.ndarray, used: list[int]) -> tuple[np.ndarray, float, np.ndarray]:
    """Coefficients of the last column on the ``used`` ones, the sum of squared residuals, the inverse of X'X."""
    xx, xy = gram[np.ix_(used, used)], gram[used, -1]
    if not used:
        return np.zeros(0), float(gram[-1, -1]), xx
    size = np.sqrt(np.maximum(np.diag(xx), 1e-300))  # columns of one scale, for the precision
    inverse = np.linalg.pinv(xx / np.outer(size, size), rcond=1e-13, hermitian=True) / np.outer(size, size)
    beta = inverse @ xy
    beta = beta + inverse @ (xy - xx @ beta)
    return beta, max(0.0, float(gram[-1, -1] - 2 * beta @ xy + beta @ xx @ beta)), inverse
