"""Exact p-value of the rank-sum test for small samples without ties."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

SMALL = 8  # fixed value: an arm of at most this size, without ties, is tested exactly


def u_distribution(m: int, n: int, last: int | None = None) -> np.ndarray:
    """P(U = u), u = 0 .. last, when all orderings of m and n distinct values are equally likely.

    The counts are the coefficients of the Gaussian binomial, a product of (1 - q^(n+i)) / (1 - q^i):
    each factor is a shifted difference and a running sum with stride i.
    """
    m, n = min(m, n), max(m, n)
    last = m * n if last is None else last
    ways = np.zeros(last + 1)
    ways[0] = 1.0
    for i in range(1, m + 1):
        if n + i <= last:
            ways[n + i :] -= ways[: last + 1 - n - i].copy()
        for start in range(i):
            ways[start::i] = np.cumsum(ways[start::i])
        ways[i * n + 1 :] = 0.0  # past the degree of the product so far
    return ways / math.comb(m + n, m)


def exact_two_sided(u: float, m: int, n: int) -> float:
    """Twice the tail up to the smaller of U and mn - U, at most 1."""
    return float(min(1.0, 2.0 * u_distribution(m, n, int(min(u, m * n - u))).sum()))


@F.pandas_udf(DoubleType())
def exact_u_p(u: pd.Series, m: pd.Series, n: pd.Series) -> pd.Series:
    """NULL where ``u`` is NULL, which is how rows for the normal approximation are passed."""
    p = [None if pd.isna(a) else exact_two_sided(float(a), int(b), int(c)) for a, b, c in zip(u, m, n)]
    return pd.Series(p, index=u.index, dtype="object").astype("float64").where(u.notna(), None)
