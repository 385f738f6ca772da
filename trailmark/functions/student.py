"""Student t tails for finished test rows.

Neither Spark nor SQL has the incomplete beta function, so two small Arrow functions evaluate it
by its continued fraction. They run on one row per test, never on sample data.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c = 1.0
    d = 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 500):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d = 1.0 + term * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + term / c
            c = c if abs(c) > tiny else tiny
            value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return value


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


MANY = 1e4  # degrees of freedom from which the normal transform is exact to double precision


def _as_normal(t: float, df: float) -> float:
    """The normal deviate with the tail of t, by Hill's expansion in 1 / (48 (df - 1/2)^2)."""
    a = df - 0.5
    b = 48.0 * a * a
    w = a * math.log1p(t * t / df)
    y = math.sqrt(w)
    tail = (((-0.4 * w - 3.3) * w - 24.0) * w - 85.5) / (0.8 * w * w + 100.0 + b)
    return y * (1.0 + (tail + w + 3.0) / b)


def t_two_sided(t: float, df: float) -> float:
    """Two-sided p-value of a t statistic.

    The incomplete beta function loses digits where its first argument is large, so from MANY degrees of
    freedom on the statistic is turned into a normal one, whose error there is far below a double's.
    """
    if not (math.isfinite(df) and df > 0) or math.isnan(t):
        return math.nan
    if df >= MANY:
        return math.erfc(_as_normal(t, df) / math.sqrt(2.0))
    return incomplete_beta(df / 2.0, 0.5, df / (df + t * t))


def t_quantile(alpha: float, df: float) -> float:
    """The t whose two-sided p-value is ``alpha``, by bisection on the tail."""
    if not (math.isfinite(df) and df > 0):
        return math.nan
    lo, hi = 0.0, 1.0
    while t_two_sided(hi, df) > alpha and hi < 1e12:
        hi *= 2.0
    for _ in range(200):
        mid = 0.5 * (lo + hi)
        if t_two_sided(mid, df) > alpha:
            lo = mid
        else:
            hi = mid
        if hi - lo <= 1e-14 * hi:
            break
    return 0.5 * (lo + hi)


def _rowwise(fn, first: pd.Series, second: pd.Series) -> pd.Series:
    out = [
        np.nan if pd.isna(x) or pd.isna(y) else fn(float(x), float(y))
        for x, y in zip(first, second)
    ]
    return pd.Series(out, index=first.index, dtype="float64").where(lambda s: s.notna(), None)


@F.pandas_udf(DoubleType())
def t_two_sided_p(t: pd.Series, df: pd.Series) -> pd.Series:
    return _rowwise(t_two_sided, t, df)


@F.pandas_udf(DoubleType())
def t_critical(alpha: pd.Series, df: pd.Series) -> pd.Series:
    return _rowwise(t_quantile, alpha, df)
