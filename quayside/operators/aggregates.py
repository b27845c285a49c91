"""Profiles, group roll-ups, period counts, correlation."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from quayside.functions.distributions import correlation_p
from quayside.operators.clean import columns_of, nan_to_null
from quayside.operators.joins import interval_join
from quayside.operators.reshape import melt
from quayside.plans.quantiles import exact_quantiles


def _present(df: DataFrame, keys: list[str]) -> DataFrame:
    """A row without a group key belongs to no group."""
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def _rows() -> Column:
    return F.count(F.lit(1))


def value_counts(df: DataFrame, col: str, keep_null: bool = False) -> DataFrame:
    """Rows per value, most frequent first."""
    rows = df if keep_null else _present(df, [col])
    return rows.groupBy(col).agg(_rows().alias("n")).orderBy(F.desc("n"), F.asc_nulls_last(col))


def value_counts_all(df: DataFrame, cols: list[str], keep_null: bool = True) -> DataFrame:
    """Rows per value for several columns in one pass: (variable, value, n)."""
    long = melt(df.select(*[F.col(c).cast("string").alias(c) for c in cols]), [], cols)
    if not keep_null:
        long = _present(long, ["value"])
    return long.groupBy("variable", "value").agg(_rows().alias("n"))


def nunique_per_column(df: DataFrame, cols: list[str], approx: bool = False) -> DataFrame:
    """Distinct non-null values per column. Exact by counting (variable, value) pairs; or estimated."""
    if approx:
        wide = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols])
        return wide.unpivot([], list(cols), "variable", "n_distinct")
    counts = value_counts_all(df, cols)
    return counts.groupBy("variable").agg(F.count("value").alias("n_distinct"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def nunique_per_group(df: DataFrame, key: str, col: str) -> DataFrame:
    """How many groups have 0, 1, 2 … distinct values."""
    per_group = (_present(df, [key]).groupBy(key, col).agg(_rows().alias("_n"))
                 .groupBy(key).agg(F.count(col).alias("n_distinct")))
    return per_group.groupBy("n_distinct").agg(_rows().alias("n_groups"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their rows.

    Text keys are counted by hash first. A hash that occurs once belongs to a key that occurs once, so only
    the texts behind repeated hashes are shuffled and compared.
    """
    rows = df.select(*keys)
    if any(rows.schema[k].dataType.typeName() == "string" for k in keys):
        hashed = rows.withColumn("_h", F.xxhash64(*keys))
        repeated = hashed.groupBy("_h").agg(_rows().alias("n")).filter(F.col("n") > 1).select("_h")
        rows = hashed.join(repeated, ["_h"], "left_semi")
    return rows.groupBy(*keys).agg(_rows().alias("n")).filter(F.col("n") > 1)


def missing_per_column(df: DataFrame) -> DataFrame:
    """Missing values per column; NaN is one."""
    df = nan_to_null(df)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return wide.unpivot([], df.columns, "variable", "n_missing")


def rows_with_missing(df: DataFrame) -> DataFrame:
    """The rows in which any column is missing, NaN included."""
    missing = F.lit(False)
    for c, kind in df.dtypes:
        missing = missing | F.col(c).isNull()
        if kind in ("double", "float"):
            missing = missing | F.isnan(c)
    return df.filter(missing)


def _numbers_long(df: DataFrame, ids: list[str], cols: list[str]) -> DataFrame:
    plain = df.select(*ids, *[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in cols])
    return plain.unpivot(list(ids), list(cols), "variable", "value")


def describe_numeric(df: DataFrame, cols: list[str], keys: tuple[str, ...] = (), approx: bool = False
                     ) -> DataFrame:
    """count, mean, std, min, quartiles and max, one row per column (and key).

    The quartiles are exact, which costs a second pass; ``approx`` sketches them in the same pass as the rest.
    """
    long = _present(_numbers_long(df, list(keys), cols), [*keys, "value"])
    by = [*keys, "variable"]
    moments = {"count": F.count("value"), "mean": F.avg("value"), "std": F.stddev_samp("value"),
               "min": F.min("value"), "max": F.max("value")}
    shares = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    if approx:
        marks = {name: F.approx_percentile("value", p) for name, p in shares.items()}
        out = long.groupBy(*by).agg(*[column.alias(name) for name, column in {**moments, **marks}.items()])
    else:
        out = exact_quantiles(long, by, "value", shares, also=moments)
    return out.select(*by, "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def describe_all(df: DataFrame) -> DataFrame:
    """Per column: count, unique, top, freq for text and flags, min and max for times and numbers (as text).

    ``top`` is the most frequent value, the smallest of them on a tie.
    """
    counted = value_counts_all(df, df.columns, keep_null=False)
    freq = counted.groupBy("variable").agg(F.sum("n").alias("count"), _rows().alias("unique"),
                                           F.max("n").alias("freq"))
    top = (counted.join(freq.select("variable", F.col("freq").alias("n")), ["variable", "n"], "left_semi")
           .groupBy("variable").agg(F.min("value").alias("top")))
    ordered = columns_of(df, "number") + columns_of(df, "datetime")
    ends = df.agg(*[F.struct(F.min(c).cast("string").alias("min"), F.max(c).cast("string").alias("max"))
                    .alias(c) for c in ordered])
    ends = ends.unpivot([], ordered, "variable", "ends") if ordered else None
    out = freq.join(top, "variable")
    if ends is None:
        return out.withColumns({"min": F.lit(None).cast("string"), "max": F.lit(None).cast("string")})
    return (out.join(ends, "variable", "left")
            .select("variable", "count", "unique", "top", "freq", "ends.min", "ends.max"))


def summary_stats(df: DataFrame, cols: list[str], keys: tuple[str, ...] = ()) -> DataFrame:
    """std, mean, median, min, max, one row per column (and key)."""
    long = _present(_numbers_long(df, list(keys), cols), [*keys, "value"])
    by = [*keys, "variable"]
    moments = {"std": F.stddev_samp("value"), "mean": F.avg("value"), "min": F.min("value"), "max": F.max("value")}
    return exact_quantiles(long, by, "value", {"median": 0.5}, also=moments).select(
        *by, "std", "mean", "median", "min", "max")


def summary_by_segment(df: DataFrame, segment: str, cols: list[str]) -> DataFrame:
    """The summary per segment as long (segment, statistic, variable, value) rows."""
    stats = summary_stats(df, cols, (segment,))
    return stats.unpivot([segment, "variable"], ["std", "mean", "median", "min", "max"], "statistic", "value")


def variance_per_column(df: DataFrame, cols: list[str]) -> DataFrame:
    wide = nan_to_null(df).agg(*[F.var_samp(c).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "variable", "variance").orderBy("variance", "variable")


def column_profile(df: DataFrame, threshold: int = 110) -> DataFrame:
    """Per column: distinct values, type, whether to treat it as a category, missing values."""
    df = nan_to_null(df)
    counts = value_counts_all(df, df.columns)
    seen = counts.groupBy("variable").agg(
        F.count("value").alias("n_distinct"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_missing"))
    types = dict(df.dtypes)
    dates = columns_of(df, "datetime")
    dtype = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])[F.col("variable")]
    category = F.col("n_distinct") < threshold
    if dates:
        category = category & ~F.col("variable").isin(dates)
    return seen.select("variable", "n_distinct", dtype.alias("dtype"), category.alias("to_category"),
                       "n_missing")


def date_span(df: DataFrame, col: str, other: str | None = None) -> DataFrame:
    """Whole days from the first ``other`` (by default the same column) to the last ``col``."""
    start, end = F.min(other or col), F.max(col)
    days = F.date_part(F.lit("DAY"), end.cast("timestamp_ntz") - start.cast("timestamp_ntz"))
    return df.agg(start.alias("first"), end.alias("last"), days.cast("bigint").alias("days"))


def group_agg_named(df: DataFrame, keys: list[str], **aggs: Column) -> DataFrame:
    return _present(df, keys).groupBy(*keys).agg(*[a.alias(name) for name, a in aggs.items()])


def conversion_by_price(df: DataFrame, price: str, converted: str, visitor: str) -> DataFrame:
    """Per price: rate, conversions, non-conversions, visitors and revenue per visitor."""
    out = group_agg_named(df, [price], conversion_rate=F.avg(F.col(converted).cast("double")),
                          n_converted=F.sum(F.col(converted).cast("bigint")),
                          n_not_converted=F.count(converted) - F.sum(F.col(converted).cast("bigint")),
                          n_visitors=F.count(visitor))
    return out.withColumn("revenue_per_visitor",
                          F.try_divide(F.col("n_converted") * F.col(price), F.col("n_visitors")))


def conversion_by_segment(df: DataFrame, segments: list[str], arm: str, converted: str,
                          labels: dict | None = None) -> DataFrame:
    """Rate, conversions and non-conversions per (segment variable, value, arm)."""
    long = _present(melt(df.select(arm, converted, *segments), [arm, converted], segments),
                    ["value", arm])
    yes = F.sum(F.col(converted).cast("bigint"))
    out = long.groupBy("variable", "value", arm).agg(
        F.avg(F.col(converted).cast("double")).alias("conversion_rate"), yes.alias("n_converted"),
        (F.count(converted) - yes).alias("n_not_converted"))
    if labels:
        names = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
        out = out.withColumn(arm, F.coalesce(names[F.col(arm)], F.col(arm).cast("string")))
    return out


def group_minmax(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    return group_agg_named(df, keys, first=F.min(col), last=F.max(col))


def group_count(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    """Non-null values per group."""
    return group_agg_named(df, keys, n=F.count(col))


def _first_non_null(col: str, order: list[str]) -> Column:
    return F.min_by(col, F.when(F.col(col).isNotNull(), F.struct(*order)))


def first_non_null(df: DataFrame, keys: list[str], col: str, order: list[str]) -> DataFrame:
    return group_agg_named(df, keys, **{f"first_{col}": _first_non_null(col, order)})


def _first_row(predicate: Column, order: list[str]) -> Column:
    return F.coalesce(F.min_by(F.coalesce(predicate, F.lit(False)), F.struct(*order)), F.lit(False))


def first_row_test(df: DataFrame, keys: list[str], predicate: Column, order: list[str]) -> DataFrame:
    """Whether the condition holds on the first row of the group (null there counts as no)."""
    return group_agg_named(df, keys, first_row_ok=_first_row(predicate, order))


def _any(predicate: Column) -> Column:
    return F.coalesce(F.bool_or(predicate), F.lit(False))


def any_match(df: DataFrame, keys: list[str], predicate: Column) -> DataFrame:
    return group_agg_named(df, keys, any_match=_any(predicate))


def distinct_non_null(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    """Distinct non-null values per group; repeats are folded before the shuffle by group."""
    return (_present(df, keys).groupBy(*keys, col).agg(_rows().alias("_n"))
            .groupBy(*keys).agg(F.count(col).alias("n_distinct")))


def collect_non_null(df: DataFrame, keys: list[str], col: str, piece: int = 10_000) -> DataFrame:
    """The non-null values of each group with their number of repeats, as sorted (value, n) lists.

    A repeat costs a count instead of a list entry. A group with more than ``piece`` distinct values comes as
    several rows, ``piece`` 0, 1, 2 …, so that no group has to fit in one task; nothing is cut off.
    """
    counts = _present(df, [*keys, col]).groupBy(*keys, col).agg(_rows().alias("n"))
    pieces = counts.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / piece).alias("_pieces"))
    placed = counts.join(pieces, keys).withColumn("piece", F.pmod(F.xxhash64(col), F.col("_pieces")))
    return (placed.groupBy(*keys, "piece")
            .agg(F.sort_array(F.collect_list(F.struct(F.col(col).alias("value"), "n"))).alias("values")))


def inspection_rollup(df: DataFrame, keys: list[str], grade: str, flag: str, code: str, order: list[str],
                      passing: str = "A", flagged: str = "Y", action: str | None = None,
                      closed: tuple[str, ...] = ()) -> DataFrame:
    """Violation rows to one row per inspection.

    passed (first row has the passing grade), grade (first non-null), has_critical_flag, n_violations
    (distinct codes), violation_codes (sorted (code, n) list) and, with ``closed`` actions, closed.

    Rows are folded per (inspection, code) first; the codes come from a code book, so the second step sees at
    most one row per code of the book for each inspection.
    """
    at = F.struct(*order)
    folded = {
        "_first": F.min(at),
        "_passed": F.min_by(F.coalesce(F.col(grade) == passing, F.lit(False)), at),
        "_graded": F.min(F.when(F.col(grade).isNotNull(), at)),
        "_grade": _first_non_null(grade, order),
        "_flag": _any(F.col(flag) == flagged),
        "_n": _rows(),
    }
    if closed:
        folded["_closed"] = _any(F.col(action).isin(list(closed)))
    by_code = _present(df, keys).groupBy(*keys, code).agg(*[a.alias(n) for n, a in folded.items()])
    entry = F.when(F.col(code).isNotNull(), F.struct(F.col(code).alias("code"), F.col("_n").alias("n")))
    out = {
        "passed": F.min_by("_passed", "_first"),
        "grade": F.min_by("_grade", "_graded"),
        "has_critical_flag": F.bool_or("_flag"),
        "n_violations": F.count(code),
        "violation_codes": F.sort_array(F.collect_list(entry)),
    }
    if closed:
        out["closed"] = F.bool_or("_closed")
    return by_code.groupBy(*keys).agg(*[a.alias(n) for n, a in out.items()])


def visit_frequency(df: DataFrame, key: str, date_col: str) -> DataFrame:
    """Rows, distinct dates and mean whole days between them per key (null with a single date).

    The gaps between sorted dates add up to last minus first, so no sort is needed.
    """
    day = F.to_date(date_col)
    by_date = _present(df, [key]).groupBy(key, day.alias("_day")).agg(_rows().alias("_n"))
    n = F.count("_day")
    span = F.date_diff(F.max("_day"), F.min("_day"))
    return by_date.groupBy(key).agg(F.sum("_n").alias("n_rows"), n.alias("n_visits"),
                                    F.when(n > 1, F.floor(span / (n - 1))).alias("mean_days_between"))


def per_user_mean(df: DataFrame, period: list[str], user: str, predicate: Column) -> DataFrame:
    """Rows per user that meet the condition, averaged over the users that have any, per period."""
    per_user = _present(df, [user]).filter(predicate).groupBy(*period, user).agg(_rows().alias("_n"))
    return per_user.groupBy(*period).agg(F.avg("_n").alias("mean_per_user"))


def _period_users(events: DataFrame, periods: DataFrame, ts: str, user: str, kind: str) -> DataFrame:
    """(period, user, kind) rows with a count ``_n`` to be summed, start < t <= end.

    Where the periods are given by DATEs (midnights), events are first folded per (day, user, kind); the copies
    for overlapping periods are made of those counts, not of the events. ``_day`` is the first midnight at or
    after the event, so that start < t <= end holds exactly when start < _day <= end.
    """
    by = ["period_start", "period_end"]
    if {periods.schema[name].dataType.typeName() for name in by} != {"date"}:
        inside = interval_join(events.select(ts, user, kind), periods, ts, *by)
        return inside.select(*by, user, kind, F.lit(1).cast("bigint").alias("_n"))
    moved = F.to_date(F.col(ts) + F.expr("interval '23:59:59.999999' hour to second"))
    daily = events.groupBy(moved.alias("_day"), user, kind).agg(_rows().alias("_n"))
    first = F.date_add("period_start", 1)  # an empty period covers no day
    cover = F.when(first <= F.col("period_end"), F.sequence(first, F.col("period_end"), F.expr("interval 1 day")))
    by_day = periods.select("period_start", "period_end", F.explode(cover).alias("_day"))
    return daily.join(by_day, "_day").select(*by, user, kind, "_n")


def _period_wide(counted: DataFrame, user: str, kind: str, kinds: list[str], users_name: str,
                 events_name: str, fill_zero: bool, extra: dict[str, tuple[Column, Column]]) -> DataFrame:
    by = ["period_start", "period_end"]
    per_kind = {k: F.sum(F.when(F.col(kind) == k, F.col("_n"))) for k in kinds}
    per_user = counted.groupBy(*by, user).agg(
        F.sum("_n").alias("_all"), *[c.alias(k) for k, c in per_kind.items()],
        *[first.alias(name) for name, (first, _) in extra.items()])
    out = per_user.groupBy(*by).agg(
        F.count(user).alias(users_name), F.sum("_all").alias(events_name),
        *[F.sum(k).alias(k) for k in kinds], *[then.alias(name) for name, (_, then) in extra.items()])
    return out.fillna(0, subset=list(kinds)) if fill_zero else out


def weekly_active(events: DataFrame, periods: DataFrame, ts: str, user: str, kind: str, kinds: list[str],
                  fill_zero: bool = False) -> DataFrame:
    """Per period: distinct users, events, and events per kind (null where a kind is absent)."""
    counted = _period_users(events, periods, ts, user, kind)
    return _period_wide(counted, user, kind, kinds, "engaged_users", "event_count", fill_zero, {})


def weekly_messages(messages: DataFrame, periods: DataFrame, ts: str, user: str, action: str,
                    actions: list[str], sent_prefix: str = "sent_", fill_zero: bool = False) -> DataFrame:
    """The same for messages, with the mean number of sent messages per user who was sent any."""
    counted = _period_users(messages, periods, ts, user, action)
    sent = F.sum(F.when(F.col(action).startswith(sent_prefix), F.col("_n")))
    return _period_wide(counted, user, action, actions, "messaged_users", "message_count", fill_zero,
                        {"sent_per_user": (sent, F.avg(F.when(F.col(user).isNotNull(), F.col("sent_per_user"))))})


def daily_windows(events: DataFrame, ts: str, days: int = 7) -> DataFrame:
    """All windows of ``days`` days, one ending each midnight, that lie inside the span of the events."""
    ends = events.agg(F.min(ts).cast("date").alias("lo"), F.max(ts).cast("date").alias("hi"))
    first = F.date_add("lo", days)  # a span shorter than a window has none
    stop = F.explode(F.when(first <= F.col("hi"), F.sequence(first, F.col("hi"), F.expr("interval 1 day"))))
    return ends.select(stop.alias("period_end")).select(
        F.date_sub("period_end", days).alias("period_start"), "period_end")


def pearson(a: str, b: str) -> Column:
    """Pearson r over the rows that have both; null when a side is constant (``corr`` fails there)."""
    x, y = F.when(F.col(b).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col(b))
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def correlation_pairs(df: DataFrame, cols: list[str], both_ways: bool = False) -> DataFrame:
    """Pearson r for each pair, in one pass; rows with a missing side are skipped pair by pair."""
    pairs = list(combinations(cols, 2))
    wide = df.agg(*[pearson(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])

    def row(a, b, i):
        return F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), F.col(f"r{i}").alias("r"))

    rows = [row(a, b, i) for i, (a, b) in enumerate(pairs)]
    if both_ways:
        rows += [row(b, a, i) for i, (a, b) in enumerate(pairs)]
    return wide.select(F.inline(F.array(*rows)))


def correlation_matrix(df: DataFrame, cols: list[str], absolute: bool = False) -> DataFrame:
    """One row per variable, one column per variable."""
    pairs = list(combinations(cols, 2))
    wide = df.agg(*[pearson(a, b).alias(f"{a}|{b}") for a, b in pairs])

    def cell(a, b):
        if a == b:
            return F.lit(1.0)
        r = F.col(f"{a}|{b}" if (a, b) in pairs else f"{b}|{a}")
        return F.abs(r) if absolute else r

    rows = [F.struct(F.lit(a).alias("variable"), *[cell(a, b).alias(b) for b in cols]) for a in cols]
    return wide.select(F.inline(F.array(*rows)))


def correlation_wide(df: DataFrame, cols: list[str]) -> DataFrame:
    """(var1, var2, r) for every pair of hundreds of columns, where one expression per pair is too much for a plan.

    The sums of a pair are entries of matrix products, which each task adds up over its rows and hands on once. Rows
    with a missing side are skipped pair by pair; r is null when a side is constant. An empty table has no rows.
    """
    numbers = nan_to_null(df.select(*[F.col(c).cast("double").alias(c) for c in cols]))
    means = numbers.agg(*[F.avg(c).alias(c) for c in cols]).select(F.struct(*cols).alias("m")).scalar()
    shifted = numbers.withColumn("_m", means).select(*[(F.col(c) - F.col("_m")[c]).alias(c) for c in cols])
    names, (left, right) = ["n", "sx", "sy", "sxx", "syy", "sxy"], np.triu_indices(len(cols), 1)

    def sums(batches):
        total, seen = np.zeros((6, len(cols), len(cols))), 0
        for pdf in batches:
            seen += len(pdf)
            x = pdf.to_numpy(dtype=float)
            there = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x)
            total += [there.T @ there, x.T @ there, there.T @ x, (x * x).T @ there, there.T @ (x * x), x.T @ x]
        if seen:
            yield pd.DataFrame({"i": left, "j": right, **{k: m[left, right] for k, m in zip(names, total)}})

    parts = shifted.mapInPandas(sums, "i int, j int, " + ", ".join(f"{k} double" for k in names))
    n, sx, sy, sxx, syy, sxy = (F.sum(k) for k in names)
    spread = F.greatest(n * sxx - sx * sx, F.lit(0.0)) * F.greatest(n * syy - sy * sy, F.lit(0.0))
    listed = F.array(*[F.lit(c) for c in cols])
    return (parts.groupBy("i", "j").agg(F.try_divide(n * sxy - sx * sy, F.sqrt(spread)).alias("r"))
            .select(listed[F.col("i")].alias("var1"), listed[F.col("j")].alias("var2"), "r"))


def correlated_pairs(df: DataFrame, cols: list[str], threshold: float = 0.5) -> DataFrame:
    """Pairs of different variables with |r| above the threshold, both ways round, strongest first."""
    pairs = correlation_pairs(df, cols, both_ways=True).withColumn("r", F.abs("r"))
    return pairs.filter(F.col("r") > threshold).orderBy(F.desc("r"), "var1", "var2")


def pearson_r(df: DataFrame, x: str, y: str) -> DataFrame:
    """r, number of pairs and two-sided p-value."""
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    return (both.agg(pearson(x, y).alias("r"), _rows().alias("n"))
            .withColumn("p_value", correlation_p("r", "n")))


def baseline_rate(df: DataFrame, arm: str, value, converted: str) -> DataFrame:
    """Converted share and size of one arm, the inputs of a power study."""
    in_arm = df.filter(F.col(arm) == value)
    return in_arm.agg(F.avg(F.col(converted).cast("double")).alias("rate"), F.count(converted).alias("n"))


def resample_month_mean(df: DataFrame, keys: list[str], time_col: str, col: str) -> DataFrame:
    """Mean per month, stamped with the first of the month."""
    month = F.trunc(F.to_date(time_col), "month").alias("month")
    return _present(df, keys).groupBy(*keys, month).agg(F.avg(col).alias(f"mean_{col}"))


def bad_share(df: DataFrame, predicate: Column) -> DataFrame:
    """Count and share of rows that fail the test."""
    fails = ~F.coalesce(predicate, F.lit(False))
    return df.agg(F.count_if(fails).alias("n_bad"), F.avg(fails.cast("double")).alias("bad_share"))
