"""Shards by jump consistent hashing (Lamping and Veach 2014).

A row's shard follows from its 64-bit key and the number of shards alone: no ring table, nothing to keep
or broadcast. With one more shard a key either stays or moves into the new shard, 1/(n + 1) of them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Fixed values of the published algorithm: the generator's multiplier and 2^31.
MULTIPLIER = 2862933555777941757
TOP = float(1 << 31)


def jump_buckets(keys: np.ndarray, shards: int) -> np.ndarray:
    """The bucket in [0, shards) of each key, all keys jumping together until none can go on."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state = keys.astype(np.int64).view(np.uint64).copy()
    bucket = np.zeros(len(state), dtype=np.int64)
    landing = np.zeros(len(state), dtype=np.int64)
    live = np.arange(len(state))
    while len(live):
        bucket[live] = landing[live]
        state[live] = state[live] * np.uint64(MULTIPLIER) + np.uint64(1)
        stretch = TOP / ((state[live] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        landing[live] = ((bucket[live] + 1) * stretch).astype(np.int64)
        live = live[landing[live] < shards]
    return bucket


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a 64-bit key as an int column; a NULL key counts as 0, hash other key types first."""

    @F.pandas_udf("int")
    def jump(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_buckets(keys.to_numpy(dtype=np.int64), shards).astype(np.int32))

    return jump(F.coalesce(key.cast("long"), F.lit(0).cast("long")))


def slice_of(key: Column, bits: int) -> Column:
    """The top ``bits`` bits of the key's next generator state, which cuts any shard in even slices."""

    @F.pandas_udf("int")
    def cut_in(keys: pd.Series) -> pd.Series:
        state = keys.to_numpy(dtype=np.int64).view(np.uint64) * np.uint64(MULTIPLIER) + np.uint64(1)
        return pd.Series((state >> np.uint64(64 - bits)).astype(np.int32))

    return cut_in(F.coalesce(key.cast("long"), F.lit(0).cast("long")))


def assign_shards(
    df: DataFrame, key: str, shards: int, order_by: list[str] | None = None, slice_bits: int = 10
) -> DataFrame:
    """Add ``shard``, ``slot`` (0, 1, ... in each shard) and ``grown_shard`` (the shard among ``shards + 1``).

    Slots follow (slice of the key, key, ``order_by``). A shard is never sorted as one group: its rows are
    ranked inside 2^``slice_bits`` slices and shifted by the sizes of the slices before. Rows equal in the key
    and in all of ``order_by`` get neighbouring slots in any order. A NULL key shares the shard of key 0. An
    empty table gives no rows. Columns named like the added ones are replaced.
    """
    rest = [c for c in order_by or [] if c != key]
    columns = [c for c in df.columns if c not in ("shard", "slot", "grown_shard")]
    placed = df.select(
        *columns,
        shard_of(F.col(f"`{key}`"), shards).alias("shard"),
        shard_of(F.col(f"`{key}`"), shards + 1).alias("grown_shard"),
        slice_of(F.col(f"`{key}`"), slice_bits).alias("__slice"),
    )
    inside = W.partitionBy("shard", "__slice").orderBy(*[F.col(f"`{c}`") for c in [key, *rest]])
    ranked = placed.withColumn("__in", F.row_number().over(inside) - 1)
    # At most shards x 2^slice_bits rows, whatever the table's size.
    sizes = placed.groupBy("shard", "__slice").agg(F.count(F.lit(1)).alias("__n"))
    before = W.partitionBy("shard").orderBy("__slice").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("shard", "__slice", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    return ranked.join(starts, ["shard", "__slice"]).select(
        *[F.col(f"`{c}`") for c in columns], "shard", (F.col("__start") + F.col("__in")).alias("slot"), "grown_shard"
    )
