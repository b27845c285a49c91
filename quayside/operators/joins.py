"""Interval, as-of, semi and lookup joins.

No side is broadcast by hint: Spark broadcasts a side whose measured size is under its threshold, and
adaptive execution splits skewed partitions of the sort-merge join otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F


def interval_join(events: DataFrame, periods: DataFrame, ts_col: str, start_col: str, end_col: str
                  ) -> DataFrame:
    """Each event with every period it falls in, start < t <= end. Periods may overlap.

    Each period is listed once per calendar day it touches, so the join is an equi-join on the day, with the
    bounds checked again. The events are neither copied nor compared with periods of other days.
    """
    days = F.sequence(F.col(start_col).cast("date"), F.col(end_col).cast("date"))
    by_day = periods.withColumn("_day", F.explode(days))
    return (events.withColumn("_day", F.col(ts_col).cast("date")).join(by_day, "_day")
            .filter((F.col(ts_col) > F.col(start_col)) & (F.col(ts_col) <= F.col(end_col)))
            .drop("_day"))


def asof_calendar(calendar: DataFrame, df: DataFrame, keys: list[str], time_col: str) -> DataFrame:
    """For each calendar row, the last row of ``df`` at or before it (the whole row, nulls and all).

    ``calendar`` has the keys and ``time_col``, a DATE. Rows of ``df`` are cut to one per key and date first,
    so a key's window is bounded by the number of days, not by the number of source rows.
    """
    values = [c for c in df.columns if c not in keys and c != time_col]
    daily = (df.filter(F.col(time_col).isNotNull())
             .groupBy(*keys, F.to_date(time_col).alias("_day"))
             .agg(F.max_by(F.struct(*values), F.struct(time_col)).alias("_row")))
    days = calendar.select(*keys, F.to_date(time_col).alias("_day"), F.lit(True).alias("_wanted"))
    both = daily.join(days, [*keys, "_day"], "full")
    upto = W.partitionBy(*keys).orderBy("_day").rowsBetween(W.unboundedPreceding, W.currentRow)
    return (both.withColumn("_row", F.last("_row", ignorenulls=True).over(upto))
            .filter(F.col("_wanted"))
            .select(*keys, F.col("_day").alias(time_col), *[F.col(f"_row.{v}").alias(v) for v in values]))


def align_on_key(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Pair two per-period results on the period."""
    return a.join(b, key)


def semi_in(dim: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Rows of ``dim`` whose key occurs in ``facts`` (whose repeats are folded before the shuffle)."""
    return dim.join(facts.select(key).distinct(), key, "left_semi")


def lookup_description(df: DataFrame, dim: DataFrame, key: str, text_col: str, order: list[str]) -> DataFrame:
    """Add the first non-null text of each key, in the given order."""
    first = (dim.filter(F.col(key).isNotNull() & F.col(text_col).isNotNull())
             .groupBy(key).agg(F.min_by(text_col, F.struct(*order)).alias(text_col)))
    return df.join(first, key, "left")


def join_rounded_geo(points: DataFrame, places: DataFrame, lat: str, lon: str, place_id: str,
                     places_at: int = 2) -> DataFrame:
    """Match points to the place at the same rounded coordinates.

    Places in one cell are folded to the lowest id and their number before the join, so a crowded cell does
    not multiply the points in it.
    """
    def cell(df):
        return df.withColumns({"cell_lat": F.bround(F.col(lat).cast("double"), places_at),
                               "cell_lon": F.bround(F.col(lon).cast("double"), places_at)})
    folded = (cell(places).groupBy("cell_lat", "cell_lon")
              .agg(F.min(place_id).alias("place_id"), F.count(F.lit(1)).alias("n_places")))
    return cell(points).join(folded, ["cell_lat", "cell_lon"])
