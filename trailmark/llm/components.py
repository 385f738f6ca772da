"""Connected components by alternating star contraction (Kiveris et al. 2014), as rounds of joins.

Links stay spread over the cluster throughout; the driver sees two numbers a round. A node with very many
neighbours is never one task's work: its minimum is combined before the shuffle and reaches the neighbours by a
join, which adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.llm.common import cut

ROUNDS = 60  # contraction needs about log n rounds; not ending in this many is an error, not a result


def _to_minimum(links: DataFrame, only_larger: bool) -> DataFrame:
    """Links every neighbour (or, for the small star, every smaller neighbour and the node) to the least of them."""
    if only_larger:
        sides = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        joined = sides.join(least, "u").where("v > u")
        return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], int(row["s"] or 0)


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links (u, v)``: root is the smallest node that it reaches.

    Links may repeat, point either way or join a node to itself; a node only linked to itself and NULLs get no
    row. No links give no rows. Each round is written to the checkpoint folder, so a lost executor costs a round.
    """
    links = links.where("u is not null and v is not null and u != v")
    links = cut(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = _state(links)
    for _ in range(ROUNDS):
        if before[0] == 0:
            break
        links = cut(_to_minimum(_to_minimum(links, True), False))
        now = _state(links)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
