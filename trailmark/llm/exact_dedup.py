"""Exact duplicates by progressive refinement: length, then a hash of the first part, then a hash of all.

Two scans, no Python. The first reads each text's length and the hash of its first characters and finds the
(length, prefix) groups with more than one row. The second hashes whole texts of those groups only. Which rows
those are must be known inside the scan, or every text would be shuffled to find out; so the groups set bits in
a bitmap of fixed size that is broadcast. A bit set by chance costs one needless hash and changes no result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.llm.common import WHITE, cut

PREFIX = 64  # characters of the text without white characters
BITS = 32768  # positions of one bitmap of bitmap_construct_agg: a fixed value of that function


def without_white(text: Column) -> Column:
    """The text without any character of [\\x20\\x09-\\x0D]; NULL counts as empty."""
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), WHITE, F.coalesce(text, F.lit("")))


def _sketch(text: Column, prefix: int) -> list[Column]:
    plain = without_white(text)
    return [F.octet_length(plain).alias("length"), F.xxhash64(F.substring(plain, 1, prefix)).alias("prefix_hash")]


def _bit(bitmap: str, position: str) -> Column:
    byte = F.conv(F.hex(F.substring(F.col(bitmap), (F.col(position) / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return byte.cast("int").bitwiseAND(F.expr(f"shiftleft(1, cast({position} % 8 as int))")) != 0


def with_sketch(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", prefix: int = PREFIX) -> DataFrame:
    """(id, text, chars, length, prefix_hash): what one scan of the texts tells."""
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"))
    return rows.withColumn("chars", F.length(F.coalesce("text", F.lit("")))).withColumns(
        dict(zip(("length", "prefix_hash"), _sketch(F.col("text"), prefix)))
    )


def exact_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", prefix: int = PREFIX, bitmaps: int = 1024
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, level, length, prefix_hash, full_hash, chars, copy.

    Texts are equal when they agree after ``without_white``. The row with most code points in its original text
    stays, ties go to the smallest id, NULL ids last. ``level`` is the step that settled the row: 'prefix' (no
    other row has its length and prefix hash) or 'full'; ``full_hash`` (SHA-256) is NULL for rows never hashed
    whole. Rows equal in id, text and size are told apart by ``copy`` = 1, 2, ...; only copy 1 can stay. NULL
    and white texts are equal to the empty one. An empty table gives no rows. The broadcast is ``bitmaps`` x 4 KiB.
    """
    rows = with_sketch(docs, id_column, text_column, prefix)
    slot = F.pmod(F.xxhash64("length", "prefix_hash"), F.lit(bitmaps * BITS))
    marked = {"__map": F.floor(slot / BITS), "__at": F.pmod(slot, F.lit(BITS))}

    by_length = rows.groupBy("length", "prefix_hash").agg(F.count(F.lit(1)).alias("n"))
    crowded = by_length.where("n > 1").withColumns(marked)
    maps = crowded.groupBy("__map").agg(F.bitmap_construct_agg("__at").alias("__bits"))

    hashed = cut(
        rows.withColumns(marked)
        .join(F.broadcast(maps), "__map", "left")
        .withColumn("open", F.coalesce(_bit("__bits", "__at"), F.lit(False)))
        .select(
            "id", "chars", "length", "prefix_hash",
            F.when(F.col("open"), F.sha2(without_white(F.col("text")), 256)).alias("full_hash"),
        )
    )
    key = ["length", "prefix_hash", "full_hash"]
    same = hashed.where("full_hash is not null").groupBy("id", "chars", *key).agg(F.count(F.lit(1)).alias("copies"))
    best = F.struct(F.col("chars"), F.col("id").isNotNull().alias("known"), (-F.col("id")).alias("low"))
    groups = same.groupBy(*key).agg(F.sum("copies").alias("group_size"), F.max(best).alias("best"))
    told = same.join(groups, key).select(
        "id", (-F.col("best.low")).alias("keep_id"), "group_size", "chars", F.col("best.chars").alias("most"), *key,
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    )
    stays = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("most")) & (F.col("copy") == 1)
    out = ["id", "keep_id", "group_size", "kept", "level", "chars", *key, "copy"]
    alone = hashed.where("full_hash is null").select(
        "*", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
        F.lit("prefix").alias("level"), F.lit(1).alias("copy"),
    )
    return told.withColumn("kept", stays).withColumn("level", F.lit("full")).select(out).unionByName(alone.select(out))


def text_hash(text: Column) -> Column:
    """SHA-256 of the text without white characters, lowercase hex."""
    return F.sha2(without_white(text), 256)


def drop_exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_duplicates`` keeps, with all their columns.

    Of rows that agree in id, text and size one stays, whatever their other columns hold.
    """
    key = ["__id", "__chars", "__length", "__prefix"]
    verdict = exact_duplicates(docs, id_column, text_column).where("kept").select(
        *[F.col(c).alias(k) for c, k in zip(("id", "chars", "length", "prefix_hash"), key)],
        F.col("full_hash").alias("__full"),
    )
    id_, text = F.col(f"`{id_column}`"), F.col(f"`{text_column}`")
    ours = [id_, F.length(F.coalesce(text, F.lit(""))), *_sketch(text, PREFIX), text_hash(text)]
    rows = docs.withColumns(dict(zip([*key, "__full"], ours)))
    on = reduce(lambda a, b: a & b, [F.col(f"d.{k}").eqNullSafe(F.col(f"v.{k}")) for k in key])
    on &= F.col("v.__full").isNull() | (F.col("v.__full") == F.col("d.__full"))
    kept = rows.alias("d").join(verdict.alias("v"), on, "left_semi")
    return kept.dropDuplicates([*key, "__full"]).select(*[F.col(f"`{c}`") for c in docs.columns])
