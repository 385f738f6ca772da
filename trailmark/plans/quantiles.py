"""Exact quantiles and ordered buckets for groups of any size.

Spark's exact ``percentile`` holds one map per group in one task. Here a bounded sketch first brackets
each wanted rank, one aggregation then counts what lies below the bracket and keeps only the values
inside it, and the answer is read off those. The sketch decides the work, never the result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trailmark.plans.lineage import cut
from trailmark.plans.skew import attach_group_values

ACCURACY = 10_000


def shuffle_partitions(df: DataFrame) -> int:
    """The session's shuffle partitions, the measure for how finely to split."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def exact_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, probabilities: Mapping[str, float], count: str | None = None
) -> DataFrame:
    """Linearly interpolated percentiles per group: ``keys``, then one column per name, NULLs ignored.

    ``count`` names an extra column with the number of values. Without keys the result is one row, with
    NULLs when there is no value.
    """
    names = list(probabilities)
    ps = [float(probabilities[n]) for n in names]
    margin = 2.0 / ACCURACY
    bounds = [b for p in ps for b in (max(p - margin, 0.0), min(p + margin, 1.0))]
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("__v"))

    # Written once: a retried task must see the brackets that the others saw.
    brackets = cut(
        rows.groupBy(*keys).agg(F.count("*").alias("__n"), F.percentile_approx("__v", bounds, ACCURACY).alias("__b"))
    )
    placed = attach_group_values(rows, brackets, keys, ["__v"])

    def zone(i: int):
        lo, hi = F.col("__b")[2 * i], F.col("__b")[2 * i + 1]
        side = F.when(F.col("__v") < lo, F.lit(-1)).when(F.col("__v") > hi, F.lit(1)).otherwise(F.lit(0))
        return F.struct(
            F.lit(i).alias("p"), side.alias("side"), F.when(side == 0, F.col("__v")).alias("inside")
        )

    # One row per (group, wanted rank, side) plus the distinct values inside the bracket.
    counted = (
        placed.select(*keys, "__n", "__v", F.explode(F.array(*[zone(i) for i in range(len(ps))])).alias("z"))
        .groupBy(*keys, "z.p", "z.side", "z.inside")
        .agg(
            F.count("*").alias("cnt"),
            F.first("__n").alias("n"),
            F.max("__v").alias("top"),
            F.min("__v").alias("bottom"),
        )
    )
    running = W.partitionBy(*keys, "p").orderBy("side", "inside").rowsBetween(W.unboundedPreceding, 0)
    wanted = F.element_at(F.array(*[F.lit(p) for p in ps]), F.col("p") + 1) * (F.col("n") - 1)
    ranked = (
        counted.withColumn("upto", F.sum("cnt").over(running))
        .withColumn("at", wanted)
        .withColumn("rep", F.when(F.col("side") < 0, F.col("top")).otherwise(F.col("bottom")))
    )

    def holds(index):
        return (index >= F.col("upto") - F.col("cnt")) & (index < F.col("upto"))

    def misplaced(index):
        edge = F.when(F.col("side") < 0, F.col("upto") - 1).otherwise(F.col("upto") - F.col("cnt"))
        return (F.col("side") != 0) & holds(index) & (index != edge)

    # Ranks are right as long as the three sides do not overlap; that is checked rather than assumed.
    picked = ranked.groupBy(*keys, "p").agg(
        F.max(F.when(holds(F.floor("at")), F.col("rep"))).alias("lo"),
        F.max(F.when(holds(F.ceil("at")), F.col("rep"))).alias("hi"),
        (F.max("at") - F.floor(F.max("at"))).alias("frac"),
        F.max("n").alias("n"),
        F.bool_or(misplaced(F.floor("at")) | misplaced(F.ceil("at"))).alias("off"),
        F.max(F.when(F.col("side") < 0, F.col("top"))).alias("below"),
        F.min("inside").alias("first_in"),
        F.max("inside").alias("last_in"),
        F.min(F.when(F.col("side") > 0, F.col("bottom"))).alias("above"),
    )
    overlap = F.coalesce(
        F.col("off") | (F.col("below") >= F.col("first_in")) | (F.col("last_in") >= F.col("above")),
        F.lit(False),
    )
    picked = picked.withColumn(
        "lo", F.when(overlap, F.raise_error(F.lit("percentile brackets changed mid-query")).cast("double")).otherwise(F.col("lo"))
    )
    result = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("frac")
    return picked.groupBy(*keys).agg(
        *([F.coalesce(F.max("n"), F.lit(0)).alias(count)] if count else []),
        *[F.max(F.when(F.col("p") == i, result)).alias(n) for i, n in enumerate(names)],
    )


def ordered_buckets(
    df: DataFrame, keys: Sequence[str], value: str, buckets: int = 64, out: str = "bucket"
) -> DataFrame:
    """Add a bucket number that rises with ``value`` inside each group, from sketched quantiles.

    Equal values share a bucket. Any boundaries give the same final ranks, they only balance the work.
    """
    if buckets < 2:
        return df.withColumn(out, F.lit(0))
    cuts = cut(
        df.groupBy(*keys).agg(
            F.percentile_approx(value, [i / buckets for i in range(1, buckets)], ACCURACY).alias("__cuts")
        )
    )
    placed = attach_group_values(df, cuts, keys, [value])
    below = F.size(F.filter("__cuts", lambda c: c < F.col(value)))
    return placed.withColumn(out, below).drop("__cuts")


def values_at_positions(
    hist: DataFrame, keys: Sequence[str], points: DataFrame, buckets: int | None = None
) -> DataFrame:
    """Look up order statistics: ``points`` (keys, position from 0) gain the value at that position.

    ``hist`` has the distinct values (keys, v, cnt). They are cut in ordered buckets whose sizes give
    each bucket's first position. Only the buckets holding a point are ranked, each in its own window,
    with points sorted in among values.
    """
    hist = ordered_buckets(hist, keys, "v", buckets or shuffle_partitions(hist))
    in_order = W.partitionBy(*keys).orderBy("bucket")
    sizes = hist.groupBy(*keys, "bucket").agg(F.sum("cnt").alias("size"), F.min("v").alias("low"), F.max("v").alias("high"))
    overlap = F.coalesce(F.lag("high").over(in_order) >= F.col("low"), F.lit(False))
    upto = F.sum("size").over(in_order.rowsBetween(W.unboundedPreceding, 0))
    starts = sizes.withColumn(
        "first",
        F.when(overlap, F.raise_error(F.lit("bucket cuts changed mid-query")).cast("bigint")).otherwise(
            upto - F.col("size")
        ),
    ).select(*keys, "bucket", "first", "size")
    asked = (
        points.select(*keys, "position").distinct().join(starts, list(keys))
        .where((F.col("position") >= F.col("first")) & (F.col("position") < F.col("first") + F.col("size")))
    )
    needed = asked.select(*keys, "bucket", "first").distinct()
    inside = W.partitionBy(*keys, "bucket").orderBy("v").rowsBetween(W.unboundedPreceding, -1)
    ranked = hist.join(needed, [*keys, "bucket"]).select(
        *keys, "bucket", (F.col("first") + F.coalesce(F.sum("cnt").over(inside), F.lit(0))).alias("at"), "v",
        F.lit(False).alias("asked"),
    )
    queries = asked.select(*keys, "bucket", F.col("position").alias("at"), F.lit(None).cast("double").alias("v"), F.lit(True).alias("asked"))
    line = W.partitionBy(*keys, "bucket").orderBy("at", "asked").rowsBetween(W.unboundedPreceding, 0)
    return (
        ranked.unionByName(queries)
        .withColumn("found", F.last("v", ignorenulls=True).over(line))
        .where("asked")
        .select(*keys, F.col("at").alias("position"), F.col("found").alias("value_at"))
    )
