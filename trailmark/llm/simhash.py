"""SimHash near-duplicates: fingerprints, links by Pigeonring filtering, and their components.

A fingerprint's 64 bits are cut into a ring of m segments. If two fingerprints differ in at most d bits, some
start on the ring has the property that for every length l the l segments from there differ in at most
l * d / m bits together (Qin and Xiao 2018). With m = 3 d that chain begins with two equal segments, and of the
next two at least one is equal. Those three segments are the join key, so the join itself carries the start of
the chain; the rest of the chain is checked on the pairs before their full distance.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.llm.common import by_batch, cut
from trailmark.llm.components import components

SEED = 42
BLOCK = 1 << 15  # shingles whose bits are counted at once
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))  # A-Z only


def fingerprint(text: str | None, shingle: int) -> int:
    """The 64 bits of a text as a signed long: a bit is 1 if it is set in over half of the shingles' XXH64."""
    words = (text or "").encode("utf-8").translate(LOWER).split()  # bytes.split cuts at [\x20\x09-\x0D]
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    if len(words) > shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, total, n = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64), len(starts)
    for at in range(0, n, BLOCK):
        spans = zip(starts[at : at + BLOCK].tolist(), (ends[at : at + BLOCK] - 1).tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(total * 2 > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_column: str, text_column: str, shingle: int) -> DataFrame:
    """(id, fp) of every row, in one pass over the texts."""
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text_column}`").alias("text"))

    def make():
        def on(batch: pa.RecordBatch) -> pa.RecordBatch:
            fps = pa.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], pa.int64())
            return pa.RecordBatch.from_arrays([batch.column(0), fps], ["id", "fp"])

        return on

    return rows.mapInArrow(by_batch(make), "id bigint, fp bigint")


def _mask(low: int, high: int) -> int:
    value = ((1 << (high - low)) - 1) << low
    return value - (1 << 64) if value >= 1 << 63 else value


def _ring(max_bits: int) -> list[int]:
    """Masks of the ring's segments, of 64 / m bits up to rounding."""
    m = max(6, 3 * max_bits)
    edges = [64 * i // m for i in range(m + 1)]
    return [_mask(a, b) for a, b in zip(edges, edges[1:])]


def _masked(masks: list[int]) -> int:
    value = 0
    for m in masks:
        value |= m
    return value


def _keys(fp: Column, ring: list[int]) -> list[Column]:
    """(start, which, bits): two segments from each start with the third, and with the fourth."""
    out = []
    for start in range(len(ring)):
        first, second, third, fourth = (ring[(start + k) % len(ring)] for k in range(4))
        for which, more in enumerate((third, fourth)):
            bits = fp.bitwiseAND(F.lit(_masked([first, second, more])).cast("long"))
            out.append(F.struct(F.lit(2 * start + which).alias("tag"), bits.alias("bits")))
    return out


def _chain_holds(apart: Column, tag: Column, ring: list[int], max_bits: int) -> Column:
    """For the start in ``tag``: every run of segments from there stays within its share of ``max_bits``."""
    m, ok = len(ring), F.lit(False)
    for start in range(m):
        runs = F.lit(True)
        for length in range(3, m):
            share = length * max_bits // m
            if share < max_bits:
                mask = _masked([ring[(start + k) % m] for k in range(length)])
                runs = runs & (F.bit_count(apart.bitwiseAND(F.lit(mask).cast("long"))) <= share)
        ok = F.when(F.floor(tag / 2) == start, runs).otherwise(ok)
    return ok


def _flips(bits: int) -> list[int]:
    """All 64-bit masks with exactly ``bits`` bits set, as signed longs."""
    values = [sum(1 << b for b in c) for c in combinations(range(64), bits)]
    return [v - (1 << 64) if v >= 1 << 63 else v for v in values]


def _links_through_neighbours(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links that connect exactly what ``max_bits`` connects, without comparing pairs.

    Two fingerprints differ in at most d bits exactly when some word lies within floor(d / 2) bits of one and
    ceil(d / 2) of the other. Each fingerprint names the words around it; those who name a word are few, and a
    star around one of the near ones connects them as all their pairs would.
    """
    near, far = max_bits // 2, (max_bits + 1) // 2
    around = [F.struct(F.lit(v).cast("long").alias("flip"), F.lit(r <= near).alias("near")) for r in range(far + 1) for v in _flips(r)]
    named = fps.select("fp", F.explode(F.array(*around)).alias("w")).select(
        "fp", F.col("w.near").alias("near"), F.col("fp").bitwiseXOR(F.col("w.flip")).alias("word")
    )
    met = named.groupBy("word").agg(F.collect_list("fp").alias("all"), F.min(F.when(F.col("near"), F.col("fp"))).alias("hub"))
    return met.where(F.col("hub").isNotNull() & (F.size("all") > 1)).select(
        F.explode("all").alias("u"), F.col("hub").alias("v")
    ).where("u != v")


def links(fps: DataFrame, max_bits: int, bucket: int = 64) -> DataFrame:
    """Links (u, v) between distinct fingerprints that connect all pairs at ``max_bits`` or fewer differing bits.

    Fingerprints that share a chain key are compared in pairs while a key has at most ``bucket`` of them. Those of
    fuller keys are linked through neighbouring words instead, which is exact and grows with their number alone.
    """
    if not 0 <= max_bits <= 4:
        raise ValueError("max_bits must be 0 to 4")
    if max_bits == 0:
        return fps.select(F.col("fp").alias("u"), F.col("fp").alias("v")).where(F.lit(False))
    ring = _ring(max_bits)
    keyed = fps.select("fp", F.explode(F.array(*_keys(F.col("fp"), ring))).alias("k")).select("fp", "k.tag", "k.bits")
    shared = keyed.groupBy("tag", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    placed = keyed.join(shared, ["tag", "bits"])
    usual = placed.where(F.col("n") <= bucket).select("fp", "tag", "bits")
    apart = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    pairs = (
        usual.alias("a")
        .join(usual.alias("b"), (F.col("a.tag") == F.col("b.tag")) & (F.col("a.bits") == F.col("b.bits")) & (F.col("a.fp") < F.col("b.fp")))
        .where(_chain_holds(apart, F.col("a.tag"), ring, max_bits))
        .where(F.bit_count(apart) <= max_bits)
        .select(F.col("b.fp").alias("u"), F.col("a.fp").alias("v"))
    )
    crowded = placed.where(F.col("n") > bucket).select("fp").distinct()
    return pairs.unionByName(_links_through_neighbours(crowded, max_bits))


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """(id, fp, component_id) of every row: component_id is the smallest id that links reach, itself included.

    NULL, empty and white texts have fingerprint 0 and are linked like any other; equal fingerprints are one node.
    Repeated rows give repeated rows. NULL ids are never a component's id unless it has no other (then NULL). An
    empty table gives no rows.
    """
    rows = cut(fingerprints(docs, id_column, text_column, shingle))
    nodes = rows.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(links(nodes.select("fp"), max_bits)).select(F.col("node").alias("fp"), "root")
    owned = nodes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = owned.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(owned.join(named, "root").select("fp", "component_id"), "fp").select("id", "fp", "component_id")


def fingerprint_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their component, with all columns.

    An id that repeats stays or goes as a whole; rows with a NULL id stay.
    """
    found = near_duplicates(docs, id_column, text_column, shingle, max_bits)
    gone = found.where("id != component_id").select(F.col("id").alias("__id"))
    stays = found.where("id = component_id").select(F.col("id").alias("__id"))
    gone = gone.join(stays, "__id", "left_anti").distinct()
    return docs.join(gone, F.col(f"`{id_column}`") == F.col("__id"), "left_anti")
