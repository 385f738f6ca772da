"""Joins and ranks that keep a hot key from landing in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SALT = "__salt"


def spread(columns: Sequence[str], salts: int) -> Column:
    """Salt in [0, salts) taken from the row's own values, the same on every retry."""
    return F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int")


def attach_group_values(
    rows: DataFrame, groups: DataFrame, keys: Sequence[str], spread_by: Sequence[str], salts: int = 64
) -> DataFrame:
    """Give every row the values of its group (inner, NULL keys match NULL).

    ``groups`` has one row per key, far fewer than there are rows. It is copied once per salt and the
    rows are spread over the salts, so a group holding a third of all rows still goes to ``salts`` tasks.
    """
    values = [c for c in groups.columns if c not in keys]
    copies = groups.select(
        *[F.col(k).alias(f"__g_{k}") for k in keys],
        *values,
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias(f"__g{SALT}"),
    )
    salted = rows.withColumn(SALT, spread(spread_by, salts))
    on = [F.col(k).eqNullSafe(F.col(f"__g_{k}")) for k in keys]
    on.append(F.col(SALT) == F.col(f"__g{SALT}"))
    joined = salted.join(copies, reduce(lambda a, b: a & b, on), "inner")
    return joined.select(*rows.columns, *values)


def hot_keys(df: DataFrame, keys: Sequence[str], min_rows: int, max_keys: int = 1000) -> DataFrame:
    """The heaviest keys, at most ``max_keys`` of them, so the result is always small to broadcast.

    Keys past ``max_keys`` are merely not salted; no row is lost.
    """
    return (
        df.groupBy(*keys)
        .count()
        .where(F.col("count") >= min_rows)
        .orderBy(F.desc("count"), *keys)
        .limit(max_keys)
        .select(*keys)
    )


def join_salting_hot_keys(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    hot: DataFrame,
    spread_by: Sequence[str],
    salts: int = 256,
) -> DataFrame:
    """Inner join of ``big`` with the one-row-per-key ``small``, salting only the hot keys."""
    marked = F.broadcast(hot.select(*keys, F.lit(True).alias("__hot")))
    left = big.join(marked, list(keys), "left").withColumn(
        SALT, F.when(F.col("__hot"), spread(spread_by, salts)).otherwise(F.lit(0))
    )
    copies = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = small.join(marked, list(keys), "left").withColumn(SALT, F.explode(copies))
    return left.drop("__hot").join(right.drop("__hot"), [*keys, SALT], "inner").drop(SALT)


def offsets_in_groups(
    df: DataFrame, keys: Sequence[str], id_column: str, weight: Column, out: str = "offset"
) -> DataFrame:
    """Add the sum of ``weight`` over the rows before this one in its group, in md5(id) order.

    The first two hex digits of the md5 split every group evenly in 256 ordered slices: a row's offset
    is the total of the earlier slices plus its offset in its own, so no task sorts a whole group.
    """
    digest = F.md5(F.col(id_column).cast("string"))
    sliced = df.withColumn("__digest", digest).withColumn("__slice", F.substring("__digest", 1, 2))
    sliced = sliced.withColumn("__weight", weight.cast("bigint"))
    sizes = sliced.groupBy(*keys, "__slice").agg(F.sum("__weight").alias("__size"))
    earlier = W.partitionBy(*keys).orderBy("__slice").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.withColumn("__start", F.coalesce(F.sum("__size").over(earlier), F.lit(0))).drop("__size")
    inside = W.partitionBy(*keys, "__slice").orderBy("__digest", id_column).rowsBetween(W.unboundedPreceding, -1)
    placed = sliced.withColumn("__before", F.coalesce(F.sum("__weight").over(inside), F.lit(0)))
    on = reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"o.{k}")) for k in [*keys, "__slice"]])
    return (
        placed.alias("l")
        .join(starts.alias("o"), on)
        .select(*[F.col(f"l.{c}") for c in df.columns], (F.col("o.__start") + F.col("l.__before")).alias(out))
    )


def rank_in_groups(df: DataFrame, keys: Sequence[str], id_column: str, out: str = "rank") -> DataFrame:
    """Row number 1..n inside each group in md5(id) order; see ``offsets_in_groups``."""
    return offsets_in_groups(df, keys, id_column, F.lit(1), out).withColumn(out, F.col(out) + 1)
