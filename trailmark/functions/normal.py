"""Normal and chi-square tails as SQL text, and normal quantiles as literals.

Spark has no erf, so the tail is Hart's rational approximation (1968), in West's double precision
arrangement (2005). It is written once as SQL text over an argument expression.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

# Published coefficients, highest power first.
HART_NUMERATOR = (
    3.52624965998911e-02,
    0.700383064443688,
    6.37396220353165,
    33.912866078383,
    112.079291497871,
    221.213596169931,
    220.206867912376,
)
HART_DENOMINATOR = (
    8.83883476483184e-02,
    1.75566716318264,
    16.064177579207,
    86.7807322029461,
    296.564248779674,
    637.333633378831,
    793.826512519948,
    440.413735824752,
)
HART_SWITCH = 7.07106781186547
SQRT_TWO_PI = 2.506628274631


def _double(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def _horner(coefficients: tuple[float, ...], x: str) -> str:
    text = _double(coefficients[0])
    for c in coefficients[1:]:
        text = f"({text} * {x} + {_double(c)})"
    return text


def upper_tail_sql(x: str) -> str:
    """SQL text for P(Z > |x|)."""
    a = f"abs({x})"
    density = f"exp(-({x}) * ({x}) / 2)"
    series = f"{density} * {_horner(HART_NUMERATOR, a)} / {_horner(HART_DENOMINATOR, a)}"
    far = a + " + 0.65E0"
    for k in (4, 3, 2, 1):
        far = f"{a} + {k}.0E0 / ({far})"
    fraction = f"{density} / ({far}) / {_double(SQRT_TWO_PI)}"
    return (
        f"(CASE WHEN {x} IS NULL THEN NULL WHEN {a} > 37 THEN 0.0E0 "
        f"WHEN {a} < {_double(HART_SWITCH)} THEN {series} ELSE {fraction} END)"
    )


def two_sided_p_sql(z: str) -> str:
    """SQL text for the two-sided normal p-value of ``z``."""
    return f"(2 * {upper_tail_sql(z)})"


def chi2_1df_p_sql(x: str) -> str:
    """SQL text for P(chi-square with 1 df > x)."""
    return two_sided_p_sql(f"sqrt({x})")


def upper_tail_p_sql(z: str) -> str:
    """SQL text for the one-sided P(Z > z)."""
    return f"(CASE WHEN {z} >= 0 THEN {upper_tail_sql(z)} ELSE 1 - {upper_tail_sql(z)} END)"


def two_sided_p(z: str) -> Column:
    return F.expr(two_sided_p_sql(z))


def chi2_1df_p(x: str) -> Column:
    return F.expr(chi2_1df_p_sql(x))


def upper_tail_p(z: str) -> Column:
    return F.expr(upper_tail_p_sql(z))


def z_quantile(p: float) -> float:
    """Standard normal quantile, evaluated once on the driver for a constant."""
    return NormalDist().inv_cdf(p)
