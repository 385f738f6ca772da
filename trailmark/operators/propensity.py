"""Logistic propensity scores by Newton's method on exact sums.

Covariates are put on [-1, 1] by their least and greatest value, rows of equal covariates are counted, and every
pass adds up its terms as whole numbers of tiny units. Neither depends on the order of the rows, so any
partitioning gives the same bits. Only sums by covariate and pair of covariates reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.plans.lineage import cut
from trailmark.plans.local import local_table

ROUNDS = {"none": 25, "firth": 100}
TOLERANCE = {"none": 1e-10, "firth": 1e-8}  # Firth's rounds close in steadily, not ever faster
LONGEST_STEP = 5.0  # of a coefficient in one round


class SeparationError(ValueError):
    """The covariates tell the arms apart for some users: no finite coefficients fit best."""


@dataclass(frozen=True)
class Fit:
    """Coefficients of the scaled covariates (``middle``, ``half``), first the constant; ``spread`` is their covariance."""

    covariates: tuple[str, ...]
    middle: tuple[float, ...]
    half: tuple[float, ...]
    weights: tuple[float, ...]
    spread: tuple[tuple[float, ...], ...]
    rounds: int

    def terms(self) -> list[Column]:
        return _terms(self.covariates, self.middle, self.half)

    def logit(self) -> Column:
        return reduce(add, [F.lit(float(w)) * z for w, z in zip(self.weights, self.terms())])


def _terms(covariates: Sequence[str], middle: Sequence[float], half: Sequence[float]) -> list[Column]:
    scaled = [(F.col(f"`{c}`").cast("double") - F.lit(m)) / F.lit(h) for c, m, h in zip(covariates, middle, half)]
    return [F.lit(1.0), *scaled]


def _chance(logit: Column) -> Column:
    return 1 / (1 + F.exp(-logit))


def leverage(spread: Sequence[Sequence[Column | float]], terms: Sequence[Column], p: Column) -> Column:
    """What share of a row's fit is its own: p (1 - p) z' S z."""
    own = [F.lit(spread[i][i]) * z * z for i, z in enumerate(terms)]
    shared = [F.lit(spread[i][j]) * 2.0 * terms[i] * terms[j] for i in range(len(terms)) for j in range(i + 1, len(terms))]
    return p * (1 - p) * reduce(add, own + shared)


def _moments(rows: DataFrame, z: Sequence[str], scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(sums of w z z', sums of gap z), exact in units of 1 / ``scale``, from one pass with a row per partition.

    Products of doubles do not depend on how rows are dealt; they are rounded to whole units and summed as two
    halves of 64-bit integers, which no order changes.
    """
    m = len(z)
    places = [(i, j) for i in range(m) for j in range(i, m)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        high, low = [np.zeros(len(places) + m, dtype=np.int64) for _ in range(2)]
        for batch in batches:
            x, w, gap = batch[list(z)].to_numpy(float).T, batch["w"].to_numpy(float), batch["gap"].to_numpy(float)
            for at, term in enumerate([*(w * x[i] * x[j] for i, j in places), *(gap * x[i] for i in range(m))]):
                units = np.rint(term * scale).astype(np.int64)
                high[at] += (units >> 32).sum()
                low[at] += (units & 0xFFFFFFFF).sum()
        yield pd.DataFrame({"at": np.arange(len(high)), "high": high, "low": low})

    parts = rows.select(*z, "w", "gap").mapInPandas(run, "at int, high bigint, low bigint")
    sums = {r["at"]: ((int(r["high"]) << 32) + int(r["low"])) / scale for r in parts.groupBy("at").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()}
    bend = np.zeros((m, m))
    for at, (i, j) in enumerate(places):
        bend[i, j] = bend[j, i] = sums.get(at, 0.0)
    return bend, np.array([sums.get(len(places) + i, 0.0) for i in range(m)])


def _inverse(matrix: np.ndarray) -> np.ndarray | None:
    try:
        out = np.linalg.inv(matrix)
    except np.linalg.LinAlgError:
        return None
    return out if np.isfinite(out).all() else None


def _independent(gram: np.ndarray) -> list[int]:
    """The columns, in order, that the ones before do not already make up."""
    kept: list[int] = []
    for j in range(len(gram)):
        rest = gram[j, j]
        if kept:
            rest -= gram[j, kept] @ np.linalg.solve(gram[np.ix_(kept, kept)], gram[kept, j])
        if rest > 1e-9 * max(gram[j, j], 1e-300) and gram[j, j] > 0:
            kept.append(j)
    return kept


def fit_propensity(data: DataFrame, treatment: str, covariates: Sequence[str], penalty: str = "none") -> Fit:
    """Coefficients of a logistic regression of ``treatment`` (0/1) on ``covariates``.

    ``penalty="none"`` is the maximum of the likelihood; it raises ``SeparationError`` when there is none, as when
    all users of some kind are treated. ``"firth"`` adds the Jeffreys prior, whose maximum always exists. A
    covariate of one value, or made up of those before it, gets the coefficient 0. Rows with a NULL or no finite number are left out.
    Raises ``ValueError`` for an arm without users and ``RuntimeError`` when Firth's rounds do not settle.
    """
    if penalty not in ROUNDS:
        raise ValueError(f"Unknown penalty: {penalty!r}")
    names = list(covariates)
    finite = [F.abs(F.col(f"`{c}`").cast("double")) < float("inf") for c in [*names, treatment]]
    whole = reduce(lambda a, b: a & b, finite)
    y = F.col(f"`{treatment}`").cast("double")
    counted = cut(data.where(whole).groupBy(*[F.col(f"`{c}`") for c in names]).agg(F.count(F.lit(1)).alias("__n"), F.sum(y.cast("bigint")).alias("__t")))
    ends = counted.agg(
        F.sum("__n").alias("n"), F.sum("__t").alias("t"),
        *[f(F.col(f"`{c}`").cast("double")).alias(f"{k}{i}") for i, c in enumerate(names) for k, f in (("lo", F.min), ("hi", F.max))],
    ).first()
    if not ends["t"] or ends["t"] == ends["n"]:
        raise ValueError("both arms need users")
    middle = tuple((ends[f"lo{i}"] + ends[f"hi{i}"]) / 2 for i in range(len(names)))
    half = tuple((ends[f"hi{i}"] - ends[f"lo{i}"]) / 2 or 1.0 for i in range(len(names)))
    m = len(names) + 1
    scaled = [z.alias(f"z{i}") for i, z in enumerate(_terms(names, middle, half))]
    folded = cut(counted.select(F.lit(0).alias("k"), F.col("__n").alias("n"), F.col("__t").alias("t"), *scaled))
    every = [f"z{i}" for i in range(m)]
    # A term is at most 2 n, and stays below 2^62 units.
    most = folded.agg(F.max("n")).first()[0]
    scale = 1 << (60 - int(most).bit_length())
    n, t = F.col("n").cast("double"), F.col("t")
    kept = _independent(_moments(folded.withColumns({"w": n, "gap": F.lit(0.0)}), every, scale)[0])
    names_z, size = [every[i] for i in kept], len(kept)
    z, used = [F.col(c) for c in names_z], range(size)
    weights, inverse = np.zeros(size), np.zeros((size, size))
    p, h = F.col("p"), F.col("h")

    def summed(leveraged: bool) -> tuple[np.ndarray, np.ndarray]:
        # The numbers of a round reach the rows as a one-row relation, so every round is the same compiled plan.
        numbers = {f"w{i}": float(weights[i]) for i in used} | {f"s{i}_{j}": float(inverse[i, j]) for i in used for j in used if i <= j}
        row = local_table(data.sparkSession, [{"k": 0, **numbers}], ", ".join(["k int", *[f"{c} double" for c in numbers]]))
        rows = folded.join(F.broadcast(row), "k").withColumn("p", _chance(reduce(add, [F.col(f"w{i}") * x for i, x in enumerate(z)])))
        if leveraged:
            spread = [[F.col(f"s{min(i, j)}_{max(i, j)}") for j in used] for i in used]
            rows = rows.withColumn("h", leverage(spread, z, p)).withColumns({"w": (1 + h) * n * p * (1 - p), "gap": t - n * p + n * h * (0.5 - p)})
        else:
            rows = rows.withColumns({"w": n * p * (1 - p), "gap": t - n * p})
        return _moments(rows, names_z, scale)

    for rounds in range(1, ROUNDS[penalty] + 1):
        bend, slope = summed(leveraged=False)
        inverse = spread = _inverse(bend)
        if inverse is None:
            break
        if penalty == "firth":  # the leverage needs the inverse at the same weights
            bend, slope = summed(leveraged=True)
            inverse = _inverse(bend)
        step = inverse @ slope
        weights = weights + step * min(1.0, LONGEST_STEP / max(np.abs(step).max(), 1e-300))
        if np.abs(step).max() < TOLERANCE[penalty]:
            full, cov = np.zeros(m), np.zeros((m, m))
            full[kept], cov[np.ix_(kept, kept)] = weights, spread
            return Fit(tuple(names), middle, half, tuple(full.tolist()), tuple(map(tuple, cov.tolist())), rounds)
    if penalty == "none":
        raise SeparationError(f"no finite fit after {rounds} rounds: the covariates separate the arms; use penalty='firth'")
    raise RuntimeError(f"the penalised fit did not settle in {rounds} rounds")


def propensity_scores(data: DataFrame, treatment: str, covariates: Sequence[str], penalty: str = "none") -> DataFrame:
    """``data`` with the ``logit`` and ``propensity`` of every row (NULL where a covariate is); see ``fit_propensity``."""
    fit = fit_propensity(data, treatment, covariates, penalty)
    return data.withColumn("logit", fit.logit()).withColumn("propensity", _chance(F.col("logit")))


def score_equations(data: DataFrame, treatment: str, fit: Fit, penalty: str = "none") -> DataFrame:
    """One row per coefficient: ``excess``, the sum that the fit brings to zero, per unit of the term's sum of sizes."""
    z, p = fit.terms(), _chance(fit.logit())
    gap = F.col(f"`{treatment}`").cast("double") - p
    if penalty == "firth":
        gap = gap + leverage(fit.spread, z, p) * (0.5 - p)
    names = ["constant", *fit.covariates]
    sums = data.agg(*[F.try_divide(F.sum(gap * x), F.sum(F.abs(x))).alias(f"e{i}") for i, x in enumerate(z)])
    rows = F.array(*[F.struct(F.lit(c).alias("coefficient"), F.col(f"e{i}").alias("excess")) for i, c in enumerate(names)])
    return sums.select(F.explode(rows).alias("r")).select("r.*")
