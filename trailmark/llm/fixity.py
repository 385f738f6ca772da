"""Merkle fixity audit of WARC replicas.

Each WARC file gets a tree: records are hashed, runs of consecutive records (ordered offset ranges) form the
leaves, and every level above hashes its children in order, up to one root a file. Replicas are compared from
the roots down: only children of nodes that differ are looked at, and at the bottom the damaged records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trailmark.llm.common import cut

CRLF = "\r\n"


def warc_head(url: Column, payload: Column) -> Column:
    """The header block of a resource record of ``payload``."""
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: resource{CRLF}WARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit(f"{CRLF}Content-Type: text/html{CRLF}Content-Length: "),
        F.octet_length(payload).cast("string"), F.lit(CRLF + CRLF),
    )


def warc_records(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", body_column: str = "html", per_file: int = 1000
) -> DataFrame:
    """(file, place, page_id, start, stop, digest): where each record lies in its file and its SHA-256.

    File n holds the pages with ids from n * ``per_file``; a NULL id goes to file -1. Records follow each other
    by id, then by digest; equal rows are records of their own. NULL url and body count as empty. The content
    itself is hashed in the scan and never shuffled.
    """
    page, body = F.col(f"`{id_column}`"), F.coalesce(F.col(f"`{body_column}`"), F.lit(""))
    record = F.concat(warc_head(F.col(f"`{url_column}`"), body), body, F.lit(CRLF + CRLF))
    rows = pages.select(
        F.coalesce(F.floor(page / per_file), F.lit(-1)).alias("file"), page.alias("page_id"),
        F.octet_length(record).cast("long").alias("size"), F.sha2(record, 256).alias("digest"),
    )
    order = W.partitionBy("file").orderBy(F.col("page_id").asc_nulls_first(), "digest")
    stop = F.sum("size").over(order.rowsBetween(W.unboundedPreceding, 0))
    return rows.select("file", (F.row_number().over(order) - 1).alias("place"), "page_id", (stop - F.col("size")).alias("start"), stop.alias("stop"), "digest")


def tree(records: DataFrame, leaf: int = 16, fan_out: int = 16, levels: int = 2) -> list[DataFrame]:
    """The levels (file, node, start, stop, digest) from the leaves up; the last has one node a file."""
    order = F.array_sort(F.collect_list(F.struct("at", "start", "stop", "digest")))

    def rise(below: DataFrame, at: str, node: Column) -> DataFrame:
        grouped = below.select("file", F.col(at).alias("at"), "start", "stop", "digest", node.alias("node")).groupBy("file", "node")
        parts = F.transform("c", lambda x: F.concat_ws(":", x["start"].cast("string"), x["stop"].cast("string"), x["digest"]))
        return grouped.agg(F.min("start").alias("start"), F.max("stop").alias("stop"), order.alias("c")).select(
            "file", "node", "start", "stop", F.sha2(F.array_join(parts, "\n"), 256).alias("digest")
        )

    out = [rise(records, "place", F.floor(F.col("place") / leaf))]
    for _ in range(levels - 1):
        out.append(rise(out[-1], "node", F.floor(F.col("node") / fan_out)))
    return [*out, rise(out[-1], "node", F.lit(0).cast("long"))]


def _differing(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Nodes (file, node) whose digest differs, or that one side lacks."""
    return (
        ours.alias("a")
        .join(theirs.alias("b"), ["file", "node"], "full")
        .where(~F.col("a.digest").eqNullSafe(F.col("b.digest")))
        .select("file", "node")
    )


def audit(ours: DataFrame, theirs: DataFrame, leaf: int = 16, fan_out: int = 16, levels: int = 2) -> DataFrame:
    """The records of ``warc_records`` tables that differ between two replicas.

    (file, place, page_id, start, stop, fault, digest, other_digest), fault being 'changed', 'missing' (the other
    replica lacks the place) or 'extra' (ours lacks it; page_id, start and stop are then the other's). Places are
    compared, so a lost record shifts those behind it in its file and they count as changed. Equal replicas and
    empty tables give no rows. Trees hold a digest for every ``leaf`` records; record tables are written once.
    """
    ours, theirs = cut(ours), cut(theirs)
    left, right = tree(ours, leaf, fan_out, levels), tree(theirs, leaf, fan_out, levels)
    suspects = _differing(left[-1], right[-1]).select("file")
    for depth in range(levels - 1, -1, -1):
        on = ["file"] if depth == levels - 1 else ["file", "parent"]

        def under(level: DataFrame) -> DataFrame:
            return level.withColumn("parent", F.floor(F.col("node") / fan_out)).join(suspects, on, "left_semi").drop("parent")

        found = _differing(under(left[depth]), under(right[depth]))
        suspects = found.withColumnRenamed("node", "parent")
    marked = [t.withColumn("parent", F.floor(F.col("place") / leaf)).join(suspects, ["file", "parent"], "left_semi") for t in (ours, theirs)]
    a, b = marked[0].alias("a"), marked[1].alias("b")
    fault = F.when(F.col("b.digest").isNull(), "missing").when(F.col("a.digest").isNull(), "extra").otherwise("changed")
    return (
        a.join(b, ["file", "place"], "full")
        .where(~F.col("a.digest").eqNullSafe(F.col("b.digest")))
        .select(
            "file", "place", *[F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c) for c in ("page_id", "start", "stop")],
            fault.alias("fault"), F.col("a.digest").alias("digest"), F.col("b.digest").alias("other_digest"),
        )
    )


def roots(records: DataFrame, leaf: int = 16, fan_out: int = 16, levels: int = 2) -> DataFrame:
    """(file, digest): the fixity value of each file."""
    return tree(records, leaf, fan_out, levels)[-1].select("file", "digest")
