"""The numbers behind each chart, small enough to draw."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quayside.operators.aggregates import nunique_per_column, value_counts_all
from quayside.plans.quantiles import exact_quantiles


def _binned(df: DataFrame, cols: list[str], bins: int, keys: list[str]) -> DataFrame:
    """Rows per (key, variable, bin) of equal-width bins; the last bin includes the maximum.

    One pass for the ends, one for the counts. A constant column gets bins half a unit to either side.
    """
    values = {c: F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in cols}
    ends = df.agg(F.struct(*[F.struct(
        (F.min(v) - F.when(F.min(v) == F.max(v), 0.5).otherwise(0.0)).alias("lo"),
        (F.max(v) + F.when(F.min(v) == F.max(v), 0.5).otherwise(0.0)).alias("hi")).alias(c)
        for c, v in values.items()]).alias("e")).scalar()
    marked = df.select(*keys, *[v.alias(c) for c, v in values.items()]).withColumn("_e", ends)

    def place(c):
        lo, hi = F.col("_e")[c]["lo"], F.col("_e")[c]["hi"]
        bin_no = F.least(F.width_bucket(F.col(c), lo, hi, F.lit(bins)), F.lit(bins).cast("bigint"))
        return F.when(F.col(c).isNotNull(), F.struct(bin_no.alias("bin"), lo.alias("lo"), hi.alias("hi")))

    long = marked.select(*keys, *[place(c).alias(c) for c in cols]).unpivot(keys, list(cols), "variable", "_b")
    counted = (long.filter(F.col("_b").isNotNull()).groupBy(*keys, "variable", "_b")
               .agg(F.count(F.lit(1)).alias("n")))
    width = (F.col("_b.hi") - F.col("_b.lo")) / bins
    return counted.select(*keys, "variable", F.col("_b.bin").cast("int").alias("bin"),
                          (F.col("_b.lo") + (F.col("_b.bin") - 1) * width).alias("lo"),
                          (F.col("_b.lo") + F.col("_b.bin") * width).alias("hi"), "n")


def histogram(df: DataFrame, cols: list[str], bins: int = 20) -> DataFrame:
    """(variable, bin, lo, hi, n); empty bins are not listed."""
    return _binned(df, cols, bins, [])


def histogram_by_segment(df: DataFrame, cols: list[str], segment: str, bins: int = 20) -> DataFrame:
    """The same split by a label; all segments share the bins."""
    return _binned(df.filter(F.col(segment).isNotNull()), cols, bins, [segment])


def date_histogram(df: DataFrame, cols: list[str], bins: int = 20) -> DataFrame:
    """(variable, bin, first_day, n) over days."""
    days = df.select(*[F.unix_date(F.to_date(c)).alias(c) for c in cols])
    first = F.date_from_unix_date(F.ceil("lo").cast("int"))
    return _binned(days, cols, bins, []).select("variable", "bin", first.alias("first_day"), "n")


def box_stats(df: DataFrame, cols: list[str], keys: tuple[str, ...] = ()) -> DataFrame:
    """Quartiles, whiskers (last values within 1.5 quartile distances) and the number of outliers."""
    keys = list(keys)
    by = [*keys, "variable"]
    plain = df.select(*keys, *[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in cols])
    long = plain.unpivot(keys, list(cols), "variable", "value").filter(F.col("value").isNotNull())
    marks = exact_quantiles(long, by, "value", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = (F.col("value") >= F.col("q1") - reach) & (F.col("value") <= F.col("q3") + reach)
    return (long.join(marks, by).groupBy(*by)
            .agg(F.min("value").alias("min"), F.any_value("q1").alias("q1"), F.any_value("median").alias("median"),
                 F.any_value("q3").alias("q3"), F.max("value").alias("max"),
                 F.min(F.when(inside, F.col("value"))).alias("whisker_lo"),
                 F.max(F.when(inside, F.col("value"))).alias("whisker_hi"), F.count_if(~inside).alias("n_outliers")))


def category_counts(df: DataFrame, cols: list[str], max_levels: int = 20) -> DataFrame:
    """Bars: rows per value, for the columns with at most ``max_levels`` values."""
    few = nunique_per_column(df, cols).filter(F.col("n_distinct") <= max_levels)
    return value_counts_all(df, cols).join(few.select("variable"), "variable", "left_semi")


def large_categories(df: DataFrame, cols: list[str], max_levels: int = 20) -> DataFrame:
    """The columns with more values than fit a bar chart."""
    return nunique_per_column(df, cols).filter(F.col("n_distinct") > max_levels)


def segment_bars(df: DataFrame, measure: str, keys: list[str]) -> DataFrame:
    """One measure per bar, sorted within each variable."""
    return df.select(*keys, measure).orderBy(keys[0], F.desc(measure), *keys[1:])


def line_points(df: DataFrame, x: str, y: str, colour: str, facet: str | None = None) -> DataFrame:
    """Points of the lines, in drawing order."""
    facets = [facet] if facet else []
    return df.select(*facets, colour, x, y).orderBy(*facets, colour, x)
