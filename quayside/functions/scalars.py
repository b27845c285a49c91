"""Column -> Column functions."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, functions as F

DATE_TEXT = "yyyy-MM-dd HH:mm:ss"


def fix_sixty(c: Column, fmt: str = DATE_TEXT) -> Column:
    """A clock text whose minute or second says 60 gets 59 there; then it is parsed (null if still bad)."""
    minute = F.regexp_replace(c, r":60:", ":59:")
    second = F.regexp_replace(minute, r":60$", ":59")
    return F.try_to_timestamp(second, F.lit(fmt))


def str_contains(c: Column, text: str, regex: bool = True, ignore_case: bool = False) -> Column:
    """Null-safe: a missing text contains nothing."""
    if regex:
        hit = c.rlike(("(?i)" if ignore_case else "") + text)
    elif ignore_case:
        hit = F.contains(F.lower(c), F.lit(text.lower()))
    else:
        hit = F.contains(c, F.lit(text))
    return F.coalesce(hit, F.lit(False))


def str_startswith(c: Column, text: str) -> Column:
    return F.coalesce(c.startswith(text), F.lit(False))


def str_endswith(c: Column, text: str) -> Column:
    return F.coalesce(c.endswith(text), F.lit(False))


def str_replace(c: Column, old: str, new: str) -> Column:
    return F.replace(c, F.lit(old), F.lit(new))


def str_lower(c: Column) -> Column:
    return F.lower(c)


def str_title(c: Column) -> Column:
    return F.initcap(c)


def str_slice(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def format_params(fmt: str, *cols: Column) -> Column:
    """A printf-style label of several columns."""
    return F.format_string(fmt, *cols)


def date_parts(c: Column) -> dict[str, Column]:
    """Calendar parts; Monday is weekday 0 and the week is the ISO week."""
    weekday = F.weekday(c)
    return {
        "year": F.year(c),
        "month": F.month(c),
        "day": F.dayofmonth(c),
        "dayofyear": F.dayofyear(c),
        "dayofweek": weekday,
        "isweekday": F.coalesce(weekday < 5, F.lit(False)),
        "week": F.weekofyear(c),
    }


def date_compare(c: Column, since: datetime.date) -> Column:
    """On or after ``since``; a missing date is not."""
    return F.coalesce(c >= F.lit(since), F.lit(False))


def math_abs_sign_exp_log(c: Column) -> dict[str, Column]:
    """log10 of 0 is -Infinity as in numpy (Spark gives null); of a negative number it is null."""
    return {
        "abs": F.abs(c),
        "sign": F.signum(c),
        "exp": F.exp(c),
        "log10": F.when(c == 0, F.lit(float("-inf"))).otherwise(F.log10(c)),
    }


def scale_and_round(c: Column, by: Column | float, places: int = 0) -> Column:
    """Product rounded half to even."""
    return F.bround(c * by, places)


def array_filter_len(c: Column, min_len: int, drop: list[str] = (), drop_numeric: bool = True) -> Column:
    """Keep array elements of at least ``min_len`` characters that are neither numbers nor listed."""
    def keep(t):
        good = F.char_length(t) >= min_len
        if drop_numeric:
            good = good & ~t.rlike(r"^\p{N}+$")
        if drop:
            good = good & ~t.isin(list(drop))
        return good
    return F.filter(c, keep)


def array_extend(a: Column, b: Column) -> Column:
    return F.concat(a, b)


def array_size_distinct(c: Column) -> dict[str, Column]:
    return {"size": F.size(c), "n_distinct": F.size(F.array_distinct(c))}


def stable_hash(key: Column, seed: int | str) -> Column:
    """A 52-bit number from key and seed: the same on any cluster, and exact as a double."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed)))), 1, 13),
                  16, 10).cast("bigint")
