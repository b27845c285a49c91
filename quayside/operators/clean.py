"""Choosing columns and rows, null handling, recoding, flags."""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from quayside.functions.scalars import str_contains

_KINDS = {
    "text": (T.StringType,),
    "number": (T.NumericType,),
    "datetime": (T.DateType, T.TimestampType, T.TimestampNTZType),
    "bool": (T.BooleanType,),
}


def columns_of(df: DataFrame, kind: str) -> list[str]:
    """Names of the columns of one kind: text, number, datetime or bool."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _KINDS[kind])]


def select_columns(df: DataFrame, include: list[str] | None = None, exclude: tuple = (),
                   prefix: str | None = None, suffix: str | None = None) -> DataFrame:
    """Named columns in the order given, or all columns less some (sorted), or by the ends of their names."""
    names = list(include) if include is not None else list(df.columns)
    if exclude:
        names = sorted(set(names) - set(exclude))
    if prefix is not None:
        names = [n for n in names if n.startswith(prefix)]
    if suffix is not None:
        names = [n for n in names if n.endswith(suffix)]
    return df.select(*names)


def select_by_type(df: DataFrame, kind: str, invert: bool = False) -> DataFrame:
    chosen = columns_of(df, kind)
    return df.select(*[n for n in df.columns if (n in chosen) != invert])


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*cols)


def filter_eq(df: DataFrame, col: str, value) -> DataFrame:
    return df.filter(F.col(col) == F.lit(value))


def filter_range(df: DataFrame, col: str, lo, hi, closed: str = "right") -> DataFrame:
    """Rows inside an interval that is closed on the ``right``, ``left``, ``both`` or ``neither`` side."""
    c = F.col(col)
    above = c >= F.lit(lo) if closed in ("left", "both") else c > F.lit(lo)
    below = c <= F.lit(hi) if closed in ("right", "both") else c < F.lit(hi)
    return df.filter(above & below)


def filter_in(df: DataFrame, col: str, values: list) -> DataFrame:
    return df.filter(F.col(col).isin(list(values)))


def filter_not_in(df: DataFrame, col: str, values: list) -> DataFrame:
    """A missing value is not in the list, so its row stays."""
    return df.filter(~F.coalesce(F.col(col).isin(list(values)), F.lit(False)))


def filter_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def filter_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull())


def drop_any_null(df: DataFrame, how: str = "any", subset: list[str] | None = None) -> DataFrame:
    return df.dropna(how=how, subset=subset)


def null_codes(df: DataFrame, codes: list, cols: list[str] | None = None) -> DataFrame:
    """Listed codes become null in the given columns (by default in every column of the codes' type)."""
    if cols is None:
        kind = "text" if isinstance(codes[0], str) else "datetime" if isinstance(
            codes[0], datetime.date) else "number"
        cols = columns_of(df, kind)
    return df.withColumns({c: F.when(~F.coalesce(F.col(c).isin(list(codes)), F.lit(False)), F.col(c))
                           for c in cols})


def nan_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """NaN is a missing value in the source data, but a number to Spark."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in (cols or floats)})


def fill_const(df: DataFrame, mapping: dict) -> DataFrame:
    return df.fillna(mapping)


def recode(df: DataFrame, col: str, mapping: dict, default=None) -> DataFrame:
    """Replace listed values; others stay, or become ``default`` when one is given."""
    c = F.col(col)
    other = c if default is None else F.lit(default)
    cases = [(c == F.lit(old), F.lit(new)) for old, new in mapping.items()]
    out = F.when(*cases[0])
    for case in cases[1:]:
        out = out.when(*case)
    return df.withColumn(col, out.otherwise(other))


def cast_columns(df: DataFrame, cols: list[str], dtype: str) -> DataFrame:
    """A value that does not fit becomes null."""
    return df.withColumns({c: F.col(c).try_cast(dtype) for c in cols})


def dedup_exact(df: DataFrame, ignore: tuple = ()) -> DataFrame:
    """Distinct rows, not comparing (and not keeping) the ``ignore`` columns."""
    return df.drop(*ignore).dropDuplicates()


def drop_after_profile(df: DataFrame, col: str, bad_values: list) -> tuple[DataFrame, DataFrame]:
    """Rows whose value is not in the bad list, and one row with how many went."""
    removed = df.agg(F.count_if(F.col(col).isin(list(bad_values))).alias("n_removed"))
    return filter_not_in(df, col, bad_values), removed


def row_audit(df: DataFrame, steps: list[tuple[str, Column]]) -> DataFrame:
    """Rows before, after and removed for each (name, keep-condition), applied one after the other."""
    passed, counts, rows = F.lit(True), [F.count(F.lit(1)).alias("n0")], []
    for i, (name, keep) in enumerate(steps, start=1):
        passed = passed & F.coalesce(keep, F.lit(False))
        counts.append(F.count_if(passed).alias(f"n{i}"))
        rows.append(F.struct(F.lit(i).alias("step"), F.lit(name).alias("name"),
                             F.col(f"n{i - 1}").alias("n_before"), F.col(f"n{i}").alias("n_after"),
                             (F.col(f"n{i - 1}") - F.col(f"n{i}")).alias("n_removed")))
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def trim_leading_incomplete(df: DataFrame, time_col: str, cols: list[str]) -> DataFrame:
    """Drop the rows before the first one in which all listed columns are present."""
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    first = df.filter(complete).agg(F.min(time_col)).scalar()
    return df.filter(F.col(time_col) >= first)


def add_literal(df: DataFrame, mapping: dict) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in mapping.items()})


def derive_ratio(df: DataFrame, out: str, num: Column, den: Column) -> DataFrame:
    """Quotient; null where the denominator is 0."""
    return df.withColumn(out, F.try_divide(num, den))


def flag_gradeable(df: DataFrame, type_col: str, types: list[str], action_col: str, actions: list[str],
                   date_col: str, since: datetime.date, out: str = "is_gradeable") -> DataFrame:
    """Of a listed type, with a listed action, on or after a date. A missing part makes it False."""
    flag = (F.col(type_col).isin(list(types)) & F.col(action_col).isin(list(actions))
            & (F.col(date_col) >= F.lit(since)))
    return df.withColumn(out, F.coalesce(flag, F.lit(False)))


def flag_text_kind(df: DataFrame, col: str, patterns: dict[str, str], regex: bool = True,
                   ignore_case: bool = False) -> DataFrame:
    """One flag column per (name -> pattern)."""
    return df.withColumns({name: str_contains(F.col(col), pattern, regex, ignore_case)
                           for name, pattern in patterns.items()})


def filter_compound(df: DataFrame, any_of_1: list[str], any_of_2: list[str], order: list[str]) -> DataFrame:
    """Rows with one flag of the first list and one of the second, sorted."""
    one = reduce(lambda a, b: a | b, [F.col(c) for c in any_of_1])
    two = reduce(lambda a, b: a | b, [F.col(c) for c in any_of_2])
    return df.filter(one & two).orderBy(*order)
