"""Bootstrap intervals for the difference of a metric between two arms.

The sample is never copied once per replicate. Three ways to draw, each spread over tasks:

* histogram: for few distinct values (binary and count metrics), and the way for Python callables.
  Resampling n values is one multinomial draw over the value counts, so a replicate costs the number of
  distinct values, which one task holds.
* poisson: the default for the mean and for aggregates of one's own. Each user gets a Poisson(1) weight per
  replicate from a hash of (seed, experiment, user) and the replicate, so the draw does not depend on partitioning.
  A partition reads its users once and keeps one running state per arm and replicate, as vectors over replicates;
  what it passes on does not grow with its users.
* order_statistic: the default for a quantile. The resample's order statistics are drawn
  directly as beta variates and looked up by position (Schultzberg and Ankargren 2022).
"""

from __future__ import annotations

import math
import pickle
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from decimal import Context, Decimal
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmark.operators.profile import histogram
from trailmark.plans.lineage import cut
from trailmark.plans.quantiles import values_at_positions



@dataclass(frozen=True)
class Aggregate:
    """A metric that replicates run through, for ``b`` replicates at a time, so no sample is ever rebuilt.

    ``start(b)`` gives the state of b empty replicates; ``add(state, values, weights)`` takes m values with their
    weights (m x b, whole numbers as float) and returns the state; ``merge(state, state)`` joins what two
    partitions saw; ``finish(state)`` gives the b numbers (NaN where there is none). States must be picklable, and
    the result must not depend on the order of values and merges.
    """

    start: Callable[[int], Any]
    add: Callable[[Any, np.ndarray, np.ndarray], Any]
    merge: Callable[[Any, Any], Any]
    finish: Callable[[Any], np.ndarray]


def _ratio(over: np.ndarray, under: np.ndarray) -> np.ndarray:
    return np.divide(over, under, out=np.full(len(over), np.nan), where=under > 0)


#: sums of weights and of weighted values
MEAN = Aggregate(
    start=lambda b: np.zeros((2, b)),
    add=lambda state, values, weights: state + np.stack([np.ones(len(values)), values]) @ weights,
    merge=lambda a, b: a + b,
    finish=lambda state: _ratio(state[1], state[0]),
)

Metric = str | float | Aggregate | Callable[[np.ndarray], float]
ARMS = ("control", "treatment")
OBSERVED = -1  # replicate number of the statistic on the sample itself


def _quantile_of(metric: Metric) -> float | None:
    """0.5 for 'median', the number itself for a quantile, None for anything else."""
    if metric == "median":
        return 0.5
    return float(metric) if isinstance(metric, (int, float)) else None


def _weighted(metric: Metric, values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The metric of each row of ``counts``, the multiplicities of the sorted ``values``."""
    if metric == "mean":
        return counts @ values / counts.sum(axis=1)
    q = _quantile_of(metric)
    if q is None:
        return np.array([metric(np.repeat(values, row)) for row in counts], dtype=float)
    upto = counts.cumsum(axis=1)
    at = q * (upto[:, -1] - 1)
    low, high = np.floor(at), np.ceil(at)
    rows = range(len(counts))
    a = values[[np.searchsorted(upto[i], low[i], side="right") for i in rows]]
    b = values[[np.searchsorted(upto[i], high[i], side="right") for i in rows]]
    return a + (b - a) * (at - low)


def _histogram_replicates(values: DataFrame, keys: Sequence[str], metric: Metric, b: int, seed: int, chunks: int) -> DataFrame:
    chunks = min(chunks, b)
    edges = [b * i // chunks for i in range(chunks + 1)]

    def draw(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        *group, chunk = key
        first, last = edges[chunk], edges[chunk + 1]
        name = zlib.crc32(repr(group).encode())
        # A generator per replicate, so the draws do not depend on how replicates are dealt to tasks.
        streams = [np.random.default_rng([seed, name, r]) for r in range(first, last)]
        sides, observed = {}, {}
        for arm in ARMS:
            part = pdf[pdf["arm"] == arm].sort_values("value")
            v, c = part["value"].to_numpy(float), part["n"].to_numpy(np.int64)
            if len(v) == 0:  # one arm alone has no difference
                return pd.DataFrame([(*group, first, np.nan)], columns=names)
            observed[arm] = _weighted(metric, v, c[None, :])[0]
            step = max(1, 2_000_000 // len(v))
            out = []
            for start in range(0, len(streams), step):
                counts = [rng.multinomial(c.sum(), c / c.sum()) for rng in streams[start : start + step]]
                out.append(_weighted(metric, v, np.stack(counts)))
            sides[arm] = np.concatenate(out)
        numbers, diffs = np.arange(first, last), sides["treatment"] - sides["control"]
        if chunk == 0:
            numbers = np.append(numbers, OBSERVED)
            diffs = np.append(diffs, observed["treatment"] - observed["control"])
        result = pd.DataFrame({"replicate": numbers, "diff": diffs})
        for name, part in zip(keys, group):
            result[name] = part
        return result[names]

    names = [*keys, "replicate", "diff"]
    schema = T.StructType([values.schema[k] for k in keys]).add("replicate", T.LongType()).add("diff", T.DoubleType())
    hist = values.groupBy(*keys, "arm", "value").agg(F.count("*").alias("n"))
    split = hist.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    drawn = split.groupBy(*keys, "chunk").applyInPandas(draw, schema)
    return drawn.where(F.col("diff").isNotNull() & ~F.isnan("diff"))


# The draw: two 32-bit words of the user's hash and the replicate's number, mixed by a 32-bit integer hash. Fixed values.
STEP = 0x9E3779B9
MIX = ((16, 0x7FEB352D), (15, 0x846CA68B), (16, 1))  # shift and factor of each turn
DRAW_BITS = 53
TOGETHER = 1_000  # replicates of one state


def poisson_thresholds(bits: int = DRAW_BITS) -> list[int]:
    """The least draws of ``bits`` bits that give a weight of 1, 2, ...: as far as the draws tell weights apart."""
    exact = Context(prec=60)
    term = total = exact.exp(Decimal(-1))
    out, k = [], 0
    while True:
        least = int((total * (1 << bits)).to_integral_value(rounding="ROUND_CEILING"))
        if least >= 1 << bits:
            return out
        out.append(least)
        k += 1
        term = exact.divide(term, Decimal(k))
        total = exact.add(total, term)


def _mix(x: np.ndarray) -> np.ndarray:
    for shift, factor in MIX:
        x ^= x >> np.uint32(shift)
        x *= np.uint32(factor)
    return x


def _weights(limits: np.ndarray):
    """A function (first words, second words, replicates) -> weights, as uint8 of shape (users, replicates)."""
    # The upper 16 of the draw's bits settle the weight but for the few values in which a threshold lies.
    shift = np.uint64(DRAW_BITS - 16)
    lowest = np.arange(1 << 16, dtype=np.uint64) << shift
    table = np.searchsorted(limits, lowest, side="right").astype(np.uint8)
    mixed = table != np.searchsorted(limits, lowest + (np.uint64(1) << shift) - np.uint64(1), side="right")

    def draw(first: np.ndarray, second: np.ndarray, replicates: np.ndarray) -> np.ndarray:
        y = _mix(first[:, None] + (replicates.astype(np.uint32) + np.uint32(1)) * np.uint32(STEP))
        high = _mix(y + second[:, None])
        top = high >> np.uint32(16)
        out, near = table[top], mixed[top]
        if near.any():
            low = _mix(high[near] + y[near])
            whole = high[near].astype(np.uint64) << np.uint64(DRAW_BITS - 32) | (low >> np.uint32(64 - DRAW_BITS)).astype(np.uint64)
            out[near] = np.searchsorted(limits, whole, side="right")
        return out

    return draw


def _poisson_replicates(values: DataFrame, keys: Sequence[str], metric: Aggregate, b: int, seed: int, id_column: str) -> DataFrame:
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in (*keys, id_column)]))
    hashed = values.select(
        *keys, (F.col("arm") == ARMS[1]).alias("__treated"), F.col("value").cast("double").alias("__value"),
        *[F.conv(F.substring(digest, at, 8), 16, 10).cast("bigint").alias(name) for at, name in ((1, "__first"), (9, "__second"))],
    ).where("__treated is not null and __value is not null")
    limits = np.array(poisson_thresholds(), dtype=np.uint64)
    # block -1 is the sample itself, with every weight 1
    blocks = {-1: np.array([OBSERVED])} | {i: np.arange(first, min(first + TOGETHER, b)) for i, first in enumerate(range(0, b, TOGETHER))}
    group = [*keys, "__treated"]
    names = [*group, "block", "state"]
    schema = T.StructType([hashed.schema[k] for k in group]).add("block", T.IntegerType()).add("state", T.BinaryType())

    def accumulate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        draw, held = _weights(limits), {}

        def passed_on() -> pd.DataFrame:
            rows = [(*key, block, pickle.dumps(state)) for key, states in held.items() for block, state in states.items()]
            held.clear()
            return pd.DataFrame(rows, columns=names)

        for batch in batches:
            for key, part in batch.groupby(group, dropna=False, sort=False):
                if key not in held and len(held) >= 64:  # experiments at hand at once
                    yield passed_on()
                states = held.setdefault(key, {block: metric.start(len(numbers)) for block, numbers in blocks.items()})
                value = part["__value"].to_numpy(float)
                first, second = (part[c].to_numpy(np.int64).astype(np.uint32) for c in ("__first", "__second"))
                states[-1] = metric.add(states[-1], value, np.ones((len(value), 1)))
                for at in range(0, len(value), 256):
                    own = slice(at, at + 256)
                    for block, numbers in blocks.items():
                        if block >= 0:
                            states[block] = metric.add(states[block], value[own], draw(first[own], second[own], numbers).astype(float))
        if held:
            yield passed_on()

    told = T.StructType([hashed.schema[k] for k in group]).add("replicate", T.LongType()).add("number", T.DoubleType())

    def finish(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        *group_key, block = key
        state = None
        for packed in parts["state"]:
            own = pickle.loads(packed)
            state = own if state is None else metric.merge(state, own)
        out = pd.DataFrame({"replicate": blocks[int(block)], "number": np.asarray(metric.finish(state), dtype=float)})
        for name, part in zip(group, group_key):
            out[name] = part
        return out[[*group, "replicate", "number"]]

    numbers = hashed.mapInPandas(accumulate, schema).groupBy(*group, "block").applyInPandas(finish, told)
    arm = [F.max(F.when(F.col("__treated") == side, F.col("number"))) for side in (True, False)]
    return (
        numbers.where(~F.isnan("number")).groupBy(*keys, "replicate").agg((arm[0] - arm[1]).alias("diff")).where(F.col("diff").isNotNull())
    )


def _order_statistic_replicates(values: DataFrame, keys: Sequence[str], q: float, b: int, seed: int) -> DataFrame:
    group = [*keys, "arm"]
    names = [*group, "replicate", "low", "high", "frac"]
    schema = T.StructType([values.schema[k] for k in group])
    for name in ("replicate", "low", "high"):
        schema = schema.add(name, T.LongType())
    schema = schema.add("frac", T.DoubleType())

    def draw(batches):
        for pdf in batches:
            for row in pdf.to_dict("records"):
                n = int(row["n"])
                rng = np.random.default_rng([seed, zlib.crc32(repr([row[k] for k in group]).encode())])
                at = q * (n - 1)
                low = int(math.floor(at))
                # Order statistics low and low + 1 of n uniforms, scaled to positions in the sample.
                u = rng.beta(low + 1, n - low, size=b)
                v = u + (1 - u) * rng.beta(1, n - low - 1, size=b) if at > low else u
                out = pd.DataFrame({"replicate": np.arange(b)})
                out["low"] = np.minimum((n * u).astype(np.int64), n - 1)
                out["high"] = np.minimum((n * v).astype(np.int64), n - 1)
                out.loc[len(out)] = [OBSERVED, low, int(math.ceil(at))]
                out["frac"] = at - low
                for k in group:
                    out[k] = row[k]
                yield out[names]

    hist = cut(values.groupBy(*group, F.col("value").cast("double").alias("v")).agg(F.count("*").alias("cnt")))
    drawn = hist.groupBy(*group).agg(F.sum("cnt").alias("n")).mapInPandas(draw, schema)
    ends = drawn.select(*group, "replicate", "frac", F.posexplode(F.array("low", "high")).alias("end", "position"))
    found = values_at_positions(hist, group, ends.select(*group, "position"))
    share = F.when(F.col("end") == 0, 1 - F.col("frac")).otherwise(F.col("frac"))
    sign = F.when(F.col("arm") == "treatment", 1.0).otherwise(-1.0)
    return (
        ends.join(found, [*group, "position"])
        .groupBy(*keys, "replicate")
        .agg(F.sum(sign * share * F.col("value_at")).alias("diff"), F.count("*").alias("parts"))
        .where(F.col("parts") == 4)  # two ends of two arms; one arm alone has no difference
        .drop("parts")
    )


def default_method(metric: Metric) -> str:
    """The way to draw for a metric, whatever the data; a Python callable takes the histogram, the slow path."""
    if isinstance(metric, Aggregate) or metric == "mean":
        return "poisson"
    return "histogram" if _quantile_of(metric) is None else "order_statistic"


def bootstrap_replicates(
    values: DataFrame,
    metric: Metric = "mean",
    n_bootstrap: int = 10_000,
    seed: int = 42,
    keys: Sequence[str] = ("experiment_id",),
    method: str | None = None,
    id_column: str = "user_id",
    chunks: int = 16,
) -> DataFrame:
    """(keys, replicate, diff): treatment minus control per replicate; replicate -1 is the sample itself.

    ``method`` is one of the three above, by default the one for the metric. ``chunks`` is the number of
    tasks an experiment's histogram replicates are dealt to. A replicate in which an arm has no number is left out.
    """
    method = method or default_method(metric)
    if isinstance(metric, Aggregate) and method != "poisson":
        raise ValueError("an aggregate takes the Poisson bootstrap")
    if method == "histogram":
        return _histogram_replicates(values, keys, metric, n_bootstrap, seed, chunks)
    if method == "poisson":
        if not isinstance(metric, Aggregate) and metric != "mean":
            raise ValueError("the Poisson bootstrap is for the mean or an Aggregate")
        return _poisson_replicates(values, keys, metric if isinstance(metric, Aggregate) else MEAN, n_bootstrap, seed, id_column)
    if method == "order_statistic":
        q = _quantile_of(metric)
        if q is None:
            raise ValueError("order statistics need 'median' or a quantile")
        return _order_statistic_replicates(values, keys, q, n_bootstrap, seed)
    raise ValueError(f"Unknown method: {method}")


def bootstrap_summary(replicates: DataFrame, alpha: float = 0.05, keys: Sequence[str] = ("experiment_id",)) -> DataFrame:
    """Percentile interval, spread and two-sided p-values of the replicates of each experiment.

    ``p_value_bootstrap`` is the share of replicates at least as far from 0 as the observed difference,
    which is near 1/2 for any real effect. ``p_value_centered`` measures distance from the observed
    difference instead and is the one to read.
    """
    drawn = F.col("replicate") != OBSERVED
    # The window holds one experiment's replicates: n_bootstrap + 1 rows.
    observed = F.max(F.when(~drawn, F.col("diff"))).over(W.partitionBy(*keys))
    both = replicates.withColumn("observed", observed).where(drawn)
    d, o = F.col("diff"), F.col("observed")
    ends = F.percentile(d, F.array(F.lit(alpha / 2), F.lit(1 - alpha / 2)))
    sums = both.groupBy(*keys).agg(
        F.first("observed").alias("observed"),
        ends.alias("ends"),
        F.avg((F.abs(d) >= F.abs(o)).cast("double")).alias("p_raw"),
        F.avg((F.abs(d - o) >= F.abs(o)).cast("double")).alias("p_centered"),
        F.avg(d).alias("mean"),
        F.stddev_pop(d).alias("std"),
        F.count("*").alias("n_bootstrap"),
    )
    lo, hi = F.col("ends")[0], F.col("ends")[1]
    return sums.select(
        *keys,
        F.round("observed", 6).alias("observed_diff"),
        F.round(lo, 6).alias("ci_lower"),
        F.round(hi, 6).alias("ci_upper"),
        F.round("p_raw", 6).alias("p_value_bootstrap"),
        F.round("p_centered", 6).alias("p_value_centered"),
        F.round("mean", 6).alias("bootstrap_mean"),
        F.round("std", 6).alias("bootstrap_std"),
        "n_bootstrap",
        F.lit(alpha).alias("alpha"),
        ((lo > 0) | (hi < 0)).alias("significant"),
    )


def bootstrap_ci(values: DataFrame, alpha: float = 0.05, keys: Sequence[str] = ("experiment_id",), **how) -> DataFrame:
    """Bootstrap interval per experiment; options as in ``bootstrap_replicates``."""
    return bootstrap_summary(bootstrap_replicates(values, keys=keys, **how), alpha, keys)


def bootstrap_distribution(replicates: DataFrame, bins: int = 50, keys: Sequence[str] = ("experiment_id",)) -> DataFrame:
    """Histogram of the replicate differences of each experiment; they are drawn once and written."""
    return histogram(cut(replicates).where(F.col("replicate") != OBSERVED), "diff", bins, keys)
