"""Tail probabilities for single result rows (t, F, chi-square, normal).

Spark SQL has neither erf nor the incomplete beta and gamma functions. The p-values here belong to one
result row per test, never to data rows, so a small pandas UDF computes them.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F, types as T


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny, front = 1e-300, 1.0
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    front = d
    for m in range(1, 500):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                     -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + step * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + step / c
            c = c if abs(c) > tiny else tiny
            front *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return front


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    scale = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                     + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return scale * _beta_fraction(a, b, x) / a
    return 1.0 - scale * _beta_fraction(b, a, 1.0 - x) / b


def gamma_tail(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function."""
    if x <= 0.0:
        return 1.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1.0:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1.0
            term *= x / n
            total += term
        return max(0.0, 1.0 - scale * total)
    b = x + 1.0 - a
    c, d = 1e300, 1.0 / b
    out = d
    for i in range(1, 1000):
        step = -i * (i - a)
        b += 2.0
        d = 1.0 / (step * d + b)
        c = b + step / c
        out *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return scale * out


def f_tail(f: float, d1: float, d2: float) -> float:
    return 1.0 if f <= 0 else beta_inc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def normal_cdf(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2.0))


def _missing(*values) -> bool:
    return any(v is None or v != v for v in values)


@F.pandas_udf(T.DoubleType())
def correlation_p(r: pd.Series, n: pd.Series) -> pd.Series:
    """Two-sided p-value of a Pearson correlation of n pairs."""
    def one(r, n):
        if _missing(r, n) or n < 3:
            return None
        return 0.0 if abs(r) >= 1 else beta_inc((n - 2) / 2.0, 0.5, 1.0 - r * r)
    return pd.Series([one(a, b) for a, b in zip(r, n)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def chi_square_p(x: pd.Series, dof: pd.Series) -> pd.Series:
    """Upper tail of the chi-square distribution."""
    return pd.Series([None if _missing(a, k) or k < 1 else gamma_tail(k / 2.0, a / 2.0)
                      for a, k in zip(x, dof)], dtype="float64")
