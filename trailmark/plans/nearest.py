"""One-to-one nearest matching on a line, range by range.

Taking the nearest open pair again and again (ties to the lower score) is the same as taking any pair whose two
ends are nearest to each other, in any order. So every score range can take on its own all pairs that no cell it
does not know can spoil. A range knows its cells, a halo of cells on either side, and where the next cell of each
arm beyond the halo lies: unknown cells can only go, so what is nearer than these is settled. What stays open goes
to the next round with the ranges as they were; the nearest pair of all is settled in every round.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.plans.lineage import cut
from trailmark.plans.local import local_table

HALO = 64  # cells that a range knows on either side
INF = math.inf


def settle(
    score: Sequence[float], arm: Sequence[int], count: Sequence[int], width: float, low=(-INF, -INF), high=(INF, INF)
) -> tuple[list[tuple[int, int, int]], list[bool]]:
    """Flows (left cell, right cell, users) that hold whatever lies outside, and which cells may still match.

    Cells have rising scores and one arm each. ``low`` and ``high`` have the score of the next cell outside of
    arm 0 and 1. Candidate pairs are neighbours of different arms, taken from a heap by distance; runs of one arm
    are joined as the cells between them go, so a cell's nearest of the other arm is found without a search.
    """
    n, count = len(score), list(count)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    run, first, last = list(range(n)), list(range(n)), list(range(n))
    for i in range(1, n):
        if arm[i] == arm[i - 1]:
            run[i] = run[i - 1]
            last[run[i]] = i
    gone, unsure = [False] * n, [False] * n
    heap = [(score[i + 1] - score[i], i, i + 1) for i in range(n - 1) if arm[i] != arm[i + 1] and score[i + 1] - score[i] <= width]
    heapq.heapify(heap)

    def head(i: int) -> int:
        while run[i] != run[run[i]]:
            run[i] = run[run[i]]
        return run[i]

    def below(i: int) -> float:
        """Distance to the nearest cell of the other arm at a lower score."""
        j = before[first[head(i)]]
        return score[i] - (score[j] if j >= 0 else low[1 - arm[i]])

    def above(i: int) -> float:
        j = after[last[head(i)]]
        return (score[j] if j < n else high[1 - arm[i]]) - score[i]

    def remove(i: int) -> None:
        gone[i], p, q, r = True, before[i], after[i], head(i)
        if p >= 0:
            after[p] = q
        if q < n:
            before[q] = p
        if first[r] == last[r]:
            if p >= 0 and q < n:  # the runs on both sides are of the other arm and now one
                a, b = head(p), head(q)
                run[b], last[a] = a, last[b]
        elif first[r] == i:
            first[r] = q
        elif last[r] == i:
            last[r] = p
        if p >= 0 and q < n and arm[p] != arm[q] and score[q] - score[p] <= width:
            heapq.heappush(heap, (score[q] - score[p], p, q))

    flows = []
    while heap:
        d, i, j = heapq.heappop(heap)
        if gone[i] or gone[j] or after[i] != j:
            continue
        if unsure[i] or unsure[j] or below(i) <= d or above(j) < d:
            unsure[i] = unsure[j] = True
            continue
        moved = min(count[i], count[j])
        flows.append((i, j, moved))
        count[i] -= moved
        count[j] -= moved
        if not count[j]:
            remove(j)
        if not count[i]:
            remove(i)
    return flows, [gone[i] or below(i) <= width or above(i) <= width for i in range(n)]


_CELLS = "range int, score double, arm int, n bigint"
_EDGES = f"{_CELLS}, side string, first_0 double, first_1 double, last_0 double, last_1 double, inner_0 double, inner_1 double, outer_0 double, outer_1 double"
_DONE = "flow boolean, range int, score double, arm int, n bigint, range_b int, score_b double"


def _edges(halo: int):
    """The first and last cells of a range, and a row that says where each arm begins and ends in and between them."""

    def run(cells: pd.DataFrame) -> pd.DataFrame:
        cells = cells.sort_values("score", ignore_index=True)
        where = {a: cells.loc[cells["arm"] == a, "score"] for a in (0, 1)}
        n, told = len(cells), {"range": int(cells["range"].iloc[0]), "side": "told"}
        for a, s in where.items():
            later, earlier = s[s.index >= halo], s[s.index < n - halo]
            told |= {f"first_{a}": s.min(), f"last_{a}": s.max(), f"inner_{a}": later.min(), f"outer_{a}": earlier.max()}
        parts = [cells.head(halo).assign(side="first"), cells.tail(halo).assign(side="last"), pd.DataFrame([told])]
        return pd.concat(parts).reindex(columns=[c.split()[0] for c in _EDGES.split(", ")])

    return run


def _surroundings(told: list) -> dict[int, tuple]:
    """range -> (range below, range above, low, high): its neighbours with cells, and the next cells past the halo.

    ``told`` has one row per range that has cells: numbers bounded by the ranges, not by the data.
    """
    rows = sorted(told, key=lambda r: r["range"])
    ids = [r["range"] for r in rows]
    low, high, out = {}, {}, {}
    nearest = [-INF, -INF]  # the last cell of each arm in the ranges before the neighbour below
    for k in range(len(rows)):
        if k:
            low[k] = tuple(nearest[a] if _no(rows[k - 1][f"outer_{a}"]) else rows[k - 1][f"outer_{a}"] for a in (0, 1))
            nearest = [nearest[a] if _no(rows[k - 1][f"last_{a}"]) else rows[k - 1][f"last_{a}"] for a in (0, 1)]
        else:
            low[k] = (-INF, -INF)
    nearest = [INF, INF]
    for k in range(len(rows) - 1, -1, -1):
        if k + 1 < len(rows):
            high[k] = tuple(nearest[a] if _no(rows[k + 1][f"inner_{a}"]) else rows[k + 1][f"inner_{a}"] for a in (0, 1))
            nearest = [nearest[a] if _no(rows[k + 1][f"first_{a}"]) else rows[k + 1][f"first_{a}"] for a in (0, 1)]
        else:
            high[k] = (INF, INF)
        out[ids[k]] = (ids[k - 1] if k else None, ids[k + 1] if k + 1 < len(ids) else None, low[k], high[k])
    return out


def _no(x) -> bool:
    return x is None or math.isnan(x)


def _match(width: float, around: dict[int, tuple]):
    """One range with its halos: the flows that are settled, and its own cells that may still match."""

    def run(key: tuple, cells: pd.DataFrame) -> pd.DataFrame:
        cells = cells.sort_values("score", ignore_index=True)
        _, _, low, high = around[int(key[0])] if around else (None, None, (-INF, -INF), (INF, INF))
        score, arm, owner = (cells[c].tolist() for c in ("score", "arm", "range"))
        flows, may = settle(score, arm, cells["n"].tolist(), width, low, high)
        rows = [(True, owner[i], score[i], arm[i], n, owner[j], score[j]) for i, j, n in flows]
        counts = cells["n"].tolist()
        rows += [(False, owner[i], score[i], arm[i], counts[i], -1, 0.0) for i in range(len(score)) if owner[i] == key[0] and may[i]]
        return pd.DataFrame(rows, columns=[c.split()[0] for c in _DONE.split(", ")])

    return run


def match_cells(cells: DataFrame, width: float, cells_per_task: int = 50_000, halo: int = HALO) -> DataFrame:
    """Flows (score_t, score_c, n) between score cells ``(score, n_t, n_c)`` at most ``width`` apart.

    Equal scores match first, in place. The rest is cut once in contiguous ranges of about ``cells_per_task``
    cells; every round a range meets its own cells and ``halo`` of its neighbours' on each side. Rounds are
    written, so a lost executor costs a round, and what they settle does not depend on the ranges.
    """
    same = F.least("n_t", "n_c")
    parts = [cells.where(same > 0).select(F.col("score").alias("score_t"), F.col("score").alias("score_c"), same.alias("n"))]
    if width <= 0:
        return parts[0]
    rest = F.col("n_t") - F.col("n_c")
    left = cells.where(rest != 0).select("score", (rest > 0).cast("int").alias("arm"), F.abs(rest).cast("bigint").alias("n"))
    left = cut(left)
    size = left.count()
    ranges = max(1, -(-size // cells_per_task))
    cells = left.withColumn("range", F.lit(0)) if ranges == 1 else cut(left.repartitionByRange(ranges, "score").withColumn("range", F.spark_partition_id()))
    cells = cells.select("range", "score", "arm", "n")
    while size:
        around: dict[int, tuple] = {}
        met = cells.withColumn("target", F.col("range"))
        if ranges > 1:
            edges = cut(cells.groupBy("range").applyInPandas(_edges(halo), _EDGES))
            around = _surroundings(edges.where("side = 'told'").collect())
            moves = [{"range": r, "side": s, "target": t} for r, (a, b, _, _) in around.items() for s, t in (("first", a), ("last", b)) if t is not None]
            if moves:
                targets = local_table(cells.sparkSession, moves, "range int, side string, target int")
                met = met.unionByName(edges.join(targets, ["range", "side"]).select("range", "score", "arm", "n", "target"))
        done = cut(met.groupBy("target").applyInPandas(_match(width, around), _DONE))
        flows = done.where("flow").drop("flow").distinct()  # two ranges may know the same
        t, c = F.when(F.col("arm") == 1, F.col("score")), F.when(F.col("arm") == 0, F.col("score"))
        parts.append(flows.select(F.coalesce(t, "score_b").alias("score_t"), F.coalesce(c, "score_b").alias("score_c"), "n"))
        gone = flows.select("range", "score", "arm", (-F.col("n")).alias("n")).unionByName(
            flows.select(F.col("range_b").alias("range"), F.col("score_b").alias("score"), (1 - F.col("arm")).alias("arm"), (-F.col("n")).alias("n"))
        )
        if ranges == 1:
            break  # one range knows all there is
        kept = done.where("not flow").select("range", "score", "arm", "n").unionByName(gone)
        cells = cut(kept.repartition("range").groupBy("range", "score", "arm").agg(F.sum("n").alias("n")).where("n > 0"))
        size = cells.count()
    return reduce(DataFrame.unionByName, parts)
