"""Rolling, running and previous-row computations.

Those over raw rows use ordered blocks (quayside.plans.blocks), so neither a missing partition key nor a hot
one puts the rows in one task. Those over daily series use a plain window per series: their time column must
be a DATE with one row per series and day, so a series has at most one row per calendar day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from quayside.plans import blocks as B


def require_date(df: DataFrame, time_col: str) -> None:
    if df.schema[time_col].dataType.typeName() != "date":
        raise TypeError(f"{time_col} must be a DATE: a series has one row per day")


def rolling_count(df: DataFrame, ts: str, span: str = "7 days", keys: tuple[str, ...] = (),
                  out: str = "rolling_n", blocks: int | None = None) -> DataFrame:
    """Add the number of rows in (t - span, t] to each row, over all rows or per key; null without a time or key.

    A row counts from its own time until just before its time plus the span. So +1 at the one and -1 at the
    other, folded per time, give the rolling count as a running total.
    """
    keys = list(keys)
    placed = F.lit(True)
    for name in [*keys, ts]:
        placed = placed & F.col(name).isNotNull()
    rows = df.filter(placed)
    counts = rows.groupBy(*keys, ts).agg(F.count(F.lit(1)).alias("_n"))
    enter = counts.withColumn("_here", F.lit(True))
    leave = counts.select(*keys, (F.col(ts) + F.expr(f"interval {span}")).alias(ts), (-F.col("_n")).alias("_n"),
                          F.lit(False).alias("_here"))
    steps = enter.unionByName(leave).groupBy(*keys, ts).agg(F.sum("_n").alias("_n"),
                                                            F.bool_or("_here").alias("_here"))
    total = B.running_total(steps, keys, [ts], {out: F.col("_n")}, blocks, sample_from=rows)
    at = total.filter("_here").select(*keys, ts, out)
    return rows.join(at, [*keys, ts]).select(*df.columns, out).unionByName(
        df.filter(~placed).withColumn(out, F.lit(None).cast("bigint")))


def cumulative_count(df: DataFrame, ts: str, order: list[str], where: Column | None = None,
                     out: str = "cumulative_n", blocks: int | None = None) -> DataFrame:
    """Add the running number of rows by time (ties in the given order); ``where`` chooses the rows."""
    rows = df if where is None else df.filter(where)
    return B.row_rank(rows, [], [ts, *order], out, blocks)


def cumulative_sum_by_group(df: DataFrame, keys: list[str], col: str, order: list[str],
                            out: str = "cumulative", blocks: int | None = None) -> DataFrame:
    return B.running_total(df, keys, order, {out: F.coalesce(F.col(col), F.lit(0))}, blocks)


def diff_previous(df: DataFrame, col: str, order: list[str], keys: tuple[str, ...] = (), out: str = "diff",
                  blocks: int | None = None) -> DataFrame:
    """Add the change of ``col`` from the row before (days for dates, null on a first row)."""
    before = B.previous_value(df, list(keys), order, col, "_before", blocks)
    if df.schema[col].dataType.typeName() == "date":
        change = F.date_diff(F.col(col), F.col("_before"))
    else:
        change = F.col(col) - F.col("_before")
    return before.withColumn(out, change).drop("_before")


def forward_fill(df: DataFrame, keys: list[str], time_col: str, cols: list[str],
                 blocks: int | None = None) -> DataFrame:
    """Each null of ``cols`` takes the last value before it."""
    return B.last_known(df, keys, [time_col], cols, blocks)


def rank_results(df: DataFrame, score: str, out: str = "rank") -> DataFrame:
    """Rank a table of parameter sets, best score first, ties sharing the lowest rank.

    A rank is one more than the number of better rows; the table has one row per parameter set.
    """
    return df.withColumn(out, F.rank().over(W.orderBy(F.desc_nulls_last(score)))).orderBy(out)


def centered_moving_average(df: DataFrame, keys: list[str], time_col: str, col: str, period: int,
                            out: str = "trend") -> DataFrame:
    """Mean over a period around each row; an even period gives both end rows half weight.

    Null within half a period of the ends, or if a value in the window is missing.
    """
    require_date(df, time_col)
    half = period // 2
    series = W.partitionBy(*keys).orderBy(time_col)
    around = series.rowsBetween(-half, half)
    wide = 2 * half + 1
    total = F.sum(col).over(around)
    if period % 2 == 0:
        ends = F.lag(col, half).over(series) + F.lead(col, half).over(series)
        total = total - ends / 2
    return df.withColumn(out, F.when(F.count(col).over(around) == wide, total / period))


def lagged_values(df: DataFrame, keys: list[str], time_col: str, col: str, lags: int) -> DataFrame:
    """Add the values 1 … ``lags`` rows back as ``<col>_lag<k>``."""
    require_date(df, time_col)
    series = W.partitionBy(*keys).orderBy(time_col)
    return df.withColumns({f"{col}_lag{k}": F.lag(col, k).over(series) for k in range(1, lags + 1)})
