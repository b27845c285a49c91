"""Exact quantiles with linear interpolation, of many columns and groups at once, without sorting the rows.

A *cell* is a run of a group's sorted values of which only the ends, the number of rows and the rank of the first one
are known. At first each group is one cell. Each further scan splits the cells that hold a wanted rank into bins and
counts them, all columns and groups at once, until each wanted rank is the end of a cell or in a cell of equal values.
Only counts are shuffled, at most ``BINS`` for a cell and task. The first split is by magnitude, the others are even, so
columns with heavy tails need few scans more: three scans as a rule, a handful at worst.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from quayside.sources.tables import stored

#: A cell of more rows is split into so many bins, one of fewer by value.
BINS = 4096
_LARGEST = 1.7976931348623157e308
_KEY = "_key"


def _spot(size: Column, share: float) -> Column:
    """Position of the quantile among the sorted values, counted from 0."""
    return (size - 1) * F.lit(float(share))


def _between(lo: Column, hi: Column, spot: Column) -> Column:
    return lo + (hi - lo) * (spot - F.floor(spot))


def _magnitude(v: Column) -> Column:
    """A number that never falls along ``v`` and grows with its logarithm (ln of the smallest double is -744.4)."""
    return F.when(v == 0, 0.0).otherwise(F.signum(v) * (F.least(F.ln(F.abs(v)), F.lit(710.0)) + 745.0))


def _finite(v: Column) -> Column:
    return F.greatest(F.least(v, F.lit(_LARGEST)), F.lit(-_LARGEST))


def _bin(at) -> Column:
    """The bin of ``_v`` in its cell. The ends have bins of their own, so each split gets on."""
    v = F.col("_v")
    share = F.coalesce(F.try_divide(at(v) - F.col("_base"), F.col("_width")), F.lit(0.0))
    return (F.when(F.col("_n") <= BINS, v).when(v == F.col("_lo"), -1.0).when(v == F.col("_hi"), float(BINS))
            .otherwise(F.least(F.floor(share * BINS).cast("double"), F.lit(BINS - 1.0))))


def _holds(rank: Column) -> Column:
    return (F.col("_from") <= rank) & (rank < F.col("_from") + F.col("_n"))


def _known(rank: Column) -> Column:
    """The value at the rank if this cell shows it."""
    one = _holds(rank) & (F.col("_lo") == F.col("_hi"))
    return F.when(one | (rank == F.col("_from")), F.col("_lo")).when(
        rank == F.col("_from") + F.col("_n") - 1, F.col("_hi"))


def _open(ranks: Column) -> Column:
    """Whether the cell holds a wanted rank without showing its value."""
    return F.exists(ranks, lambda rank: _holds(rank) & _known(rank).isNull())


def _split(rows: DataFrame, by: list[str], cells: DataFrame, by_magnitude: bool) -> DataFrame:
    """The bins of the open cells as new cells. No group has more open cells than wanted ranks."""
    at = _magnitude if by_magnitude else _finite
    parents = cells.filter("_open").select(
        *by, "_size", "_lo", "_hi", "_n", F.col("_from").alias("_start"), at(F.col("_lo")).alias("_base"),
        (at(F.col("_hi")) - at(F.col("_lo"))).alias("_width"))
    own = rows.join(parents, by).filter((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))
    bins = (own.groupBy(*by, "_size", "_start", _bin(at).alias("_bin"))
            .agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count(F.lit(1)).alias("_n")))
    before = W.partitionBy(*by, "_start").orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
    return bins.select(*by, "_size", "_lo", "_hi", "_n",
                       (F.col("_start") + F.coalesce(F.sum("_n").over(before), F.lit(0))).alias("_from"))


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float],
                    blocks: int | None = None, *, also: dict[str, Column] | None = None) -> DataFrame:
    """One row per key with one column per entry of ``probs`` (name -> share).

    ``also`` are other aggregates (name -> column over ``value``) for the first scan to take along; the result has
    them too. ``blocks`` may be given as to the functions of ``blocks.py``; no rows are sorted here, so it has no effect.
    Rows with a null key or a null or NaN value take no part; without keys and rows the result is one row of
    nulls. The cells are stored from scan to scan, and the scans run when the function is called.
    """
    number = F.nanvl(F.col(value).cast("double"), F.lit(None))
    rows = df.select(*keys, number.alias(value), number.alias("_v")).filter(F.col("_v").isNotNull())
    for name in keys:
        rows = rows.filter(F.col(name).isNotNull())
    by, also = list(keys) or [_KEY], also or {}
    rows = rows if keys else rows.withColumn(_KEY, F.lit(0))
    spots = {name: _spot(F.col("_size"), share) for name, share in probs.items()}
    ranks = F.array(*[end(s).cast("bigint") for s in spots.values() for end in (F.floor, F.ceil)])

    whole = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_size"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"),
                                  *[column.alias(name) for name, column in also.items()])
    groups = stored(whole.withColumns({"_n": F.col("_size"), "_from": F.lit(0).cast("bigint")})
                    .withColumn("_open", _open(ranks)), "groups")
    columns = [*by, "_size", "_lo", "_hi", "_n", "_from"]
    cells, every = groups, groups.select(*columns)
    while not cells.filter("_open").isEmpty():
        bins = _split(rows.drop(value) if value not in by else rows, by, cells, by_magnitude=cells is groups)
        cells = stored(bins.withColumn("_open", _open(ranks)), "cells")
        every = every.unionByName(cells.select(*columns))

    shown = every.withColumn("_known", F.transform(ranks, _known)).groupBy(*by).agg(
        F.any_value("_size").alias("_size"), *[F.max(F.col("_known")[i]).alias(f"_{i}") for i in range(2 * len(spots))])
    marks = shown.select(*by, *[_between(F.col(f"_{2 * i}"), F.col(f"_{2 * i + 1}"), s).alias(name)
                                for i, (name, s) in enumerate(spots.items())])
    out = groups.select(*by, *also).join(marks, by).select(*by, *also, *probs)
    return out if keys else out.groupBy().agg(*[F.any_value(c).alias(c) for c in [*also, *probs]])
