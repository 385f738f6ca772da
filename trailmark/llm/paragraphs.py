"""Repeated paragraphs by MinHash banding, with passages that sit inside other text.

Paragraphs (lines) get MinHash signatures over their 5-word shingles; shorter lines meet by equality. Paragraphs that agree in a
band are joined, their exact Jaccard similarity decides, and connected components are the classes. Equal
paragraphs are one node from the start, so thousands of copies are one row in every later step.

A passage pasted into the middle of other lines shares no paragraph with its source. So each text is also cut in
short passages around anchors: words whose shingle hash is the least among its neighbours on both sides. Where an
anchor lies depends on the nearby words alone, so a shared passage has the same anchors in both texts, and equal
passages meet by the hash of all their words. Passages that follow each other become one span.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trailmark.llm.common import by_batch, cut, stored
from trailmark.llm.components import components

SHINGLE = 5
BANDS, ROWS = 8, 3  # at similarity 0.8 a pair misses every band with probability (1 - 0.8^3)^8 = 0.3 %
REACH = 5  # an anchor's hash is less than those of so many shingles on both sides
MEMO = 300_000
CHUNK = 1 << 18  # characters of the texts whose lines are hashed together
BLOCK = 256  # paragraphs of a block of a full bucket
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)  # odd multiplier of the rolling word hash


class Memo(dict):
    """Word hashes, forgotten when there are too many."""

    def __missing__(self, word: str) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(self) >= MEMO:
            self.clear()
        if len(word) <= 64:
            self[word] = h
        return h


class Hasher:
    """64-bit hashes of words, shingles and spans; the same in every task."""

    def __init__(self) -> None:
        self.memo = Memo()
        rng = np.random.default_rng(7)
        self.mul = (rng.integers(1, 1 << 62, BANDS * ROWS, dtype=np.int64).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
        self.add = rng.integers(0, 1 << 62, BANDS * ROWS, dtype=np.int64).astype(np.uint64)

    def words(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.memo.__getitem__, words), dtype=np.uint64, count=len(words))

    @staticmethod
    def runs(hashes: np.ndarray, length: int) -> np.ndarray:
        """A mixed hash of every run of ``length`` words."""
        n = len(hashes) - length + 1
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        total = np.zeros(n, dtype=np.uint64)
        for k in range(length):
            total = total * BASE + hashes[k : k + n]
        return mixed(total)

    def bands(self, hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """A row of signed longs, one a band, for each run of ``sizes`` words that follows the one before in ``hashes``.

        No run may be shorter than a shingle; a shingle that reaches into the next run is left out.
        """
        if not len(sizes):
            return np.zeros((0, BANDS), dtype=np.int64)
        ends = np.cumsum(sizes)
        inside = np.arange(len(hashes) - SHINGLE + 1) + SHINGLE <= np.repeat(ends, sizes)[: 1 - SHINGLE]
        shingles = self.runs(hashes, SHINGLE)[inside]
        counts = sizes - (SHINGLE - 1)
        starts = np.cumsum(counts) - counts
        keys = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(sizes), 1))
        for band in range(BANDS):
            for r in range(band * ROWS, (band + 1) * ROWS):
                least = np.minimum.reduceat(shingles * self.mul[r] + self.add[r], starts)
                keys[:, band] = mixed(keys[:, band] * BASE + least)
        return keys.view(np.int64)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of MurmurHash3, which spreads every input bit over the word."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def span_key(hashes: np.ndarray) -> int:
    """A signed 64-bit hash of a whole word sequence."""
    return xxhash.xxh64_intdigest(hashes.tobytes(), 3) - (1 << 63)


def split_paragraphs(text: str | None) -> list[list[str]]:
    """The lower-cased words of every line, empty lines included."""
    return [line.split() for line in (text or "").lower().split("\n")]


def anchors(shingles: np.ndarray) -> np.ndarray:
    """Places whose shingle hash is strictly less than the ``REACH`` before and after; all of them must exist."""
    n = len(shingles)
    if n < 2 * REACH + 1:
        return np.zeros(0, dtype=np.int64)
    middle = shingles[REACH : n - REACH]
    least = np.ones(len(middle), dtype=bool)
    for k in range(1, REACH + 1):
        least &= (middle < shingles[REACH - k : n - REACH - k]) & (middle < shingles[REACH + k : n - REACH + k])
    return np.flatnonzero(least) + REACH


def _chunks(ids: list, texts: list) -> Iterator[tuple[list, list]]:
    """The rows in runs of about ``CHUNK`` characters, so that what is built from them stays small."""
    begun = total = 0
    for at, text in enumerate(texts):
        total += len(text or "")
        if total >= CHUNK or at + 1 == len(texts):
            yield ids[begun : at + 1], texts[begun : at + 1]
            begun, total = at + 1, 0


def _lines(hasher: Hasher, ids: list, texts: list, least: int, banded: bool) -> pa.RecordBatch:
    """The columns of ``_paragraphs``: all words of the texts are hashed in one go, all bands as well."""
    split = [split_paragraphs(text) for text in texts]
    lines = list(chain.from_iterable(split))
    of = np.repeat(np.arange(len(ids)), [len(x) for x in split])
    sizes = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))
    begins = np.cumsum(sizes) - sizes
    first = np.cumsum([0, *(len(x) for x in split[:-1])])  # every text has a line
    starts = begins - begins[first][of]
    hashes = hasher.words(list(chain.from_iterable(lines)))

    kept = np.flatnonzero(sizes >= least)
    view = memoryview(hashes.tobytes())
    spans = zip((8 * begins[kept]).tolist(), (8 * (begins + sizes)[kept]).tolist())
    keys = np.fromiter((xxhash.xxh64_intdigest(view[a:b], 3) for a, b in spans), dtype=np.uint64, count=len(kept))
    signed = (keys ^ np.uint64(1 << 63)).view(np.int64)

    if banded:
        long = sizes[kept] >= SHINGLE
        usable = (sizes >= least) & (sizes >= SHINGLE)
        flat = hasher.bands(hashes[np.repeat(usable, sizes)], sizes[usable]).reshape(-1)
        offsets = np.concatenate([[0], np.cumsum(np.where(long, BANDS, 0))]).astype(np.int32)
        bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()), mask=pa.array(~long))
    else:
        bands = pa.nulls(len(kept), pa.list_(pa.int64()))
    columns = [
        pa.array(ids, pa.int64()).take(pa.array(of[kept])), pa.array(starts[kept].astype(np.int32)),
        pa.array(sizes[kept].astype(np.int32)), pa.array(signed), bands,
    ]
    return pa.RecordBatch.from_arrays(columns, ["id", "start", "words", "key", "bands"])


def _rows(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text_column}`").alias("text"))


def _passages(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, start, key): anchored passages of 2 * REACH + SHINGLE words by their place in the text's words."""
    length = 2 * REACH + SHINGLE

    def make():
        hasher = Hasher()

        def on(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, starts, keys = [], [], []
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                hashes = hasher.words((text or "").lower().split())
                at = anchors(hasher.runs(hashes, SHINGLE)) - REACH
                if len(at):
                    ids += [id_] * len(at)
                    starts.append(at)
                    keys.append(hasher.runs(hashes, length)[at])
            flat = [np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (starts, keys)]
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(flat[0].astype(np.int32)), pa.array(flat[1].view(np.int64))], ["id", "start", "key"]
            )

        return on

    return _rows(docs, id_column, text_column).mapInArrow(by_batch(make), "id bigint, start int, key bigint")


def repeated_passages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, start, words, source): spans of ``words`` words from word ``start`` that another document has as well.

    ``source`` is the smallest id that holds the passage. Unique passages fall out after one aggregation by hash;
    what is joined back are the repeated ones.
    """
    length = 2 * REACH + SHINGLE
    found = stored(_passages(docs, id_column, text_column).where("id is not null"))
    held = found.groupBy("key").agg(F.min("id").alias("source"), F.max("id").alias("last")).where("source != last")
    rows = found.join(held.select("key", "source"), "key")
    order = W.partitionBy("id").orderBy("start", "source")
    same = (F.lag("source").over(order) == F.col("source")) & (F.lag("start").over(order) + length >= F.col("start"))
    begun = rows.withColumn("new", F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1))
    run = F.sum("new").over(order.rowsBetween(W.unboundedPreceding, 0))
    return (
        begun.withColumn("run", run)
        .groupBy("id", "source", "run")
        .agg(F.min("start").alias("start"), (F.max("start") + length - F.min("start")).alias("words"))
        .select("id", "start", "words", "source")
    )


def _paragraphs(docs: DataFrame, id_column: str, text_column: str, least: int, banded: bool) -> DataFrame:
    """(id, start, words, key, bands) of every line of at least ``least`` words; ``bands`` is NULL unless ``banded`` and without a shingle."""

    def make():
        hasher = Hasher()

        def on(batch: pa.RecordBatch) -> pa.RecordBatch:
            chunks = _chunks(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            parts = [_lines(hasher, ids, texts, least, banded) for ids, texts in chunks]
            return pa.concat_batches(parts)

        return on

    kinds = "id bigint, start int, words int, key bigint, bands array<bigint>"
    return _rows(docs, id_column, text_column).mapInArrow(by_batch(make), kinds)


def _shingle_sets(docs: DataFrame, wanted: DataFrame, id_column: str, text_column: str, least: int) -> DataFrame:
    """(key, shingles): the shingle hashes of each wanted paragraph, read again from the one document named for it."""
    lists = wanted.groupBy("id").agg(F.collect_set("key").alias("keys"))  # at most a document's paragraphs
    texts = _rows(docs, id_column, text_column).join(lists, "id")

    def make():
        hasher = Hasher()

        def on(batch: pa.RecordBatch) -> pa.RecordBatch:
            keys, sets = [], []
            for text, listed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                open_ = set(listed)
                for words in split_paragraphs(text):
                    if len(words) < max(least, SHINGLE) or not open_:
                        continue
                    hashes = hasher.words(words)
                    key = span_key(hashes)
                    if key in open_:
                        open_.discard(key)
                        keys.append(key)
                        sets.append(np.unique(hasher.runs(hashes, SHINGLE)).view(np.int64).tolist())
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["key", "shingles"])

        return on

    found = texts.select("id", "text", "keys").mapInArrow(by_batch(make), "key bigint, shingles array<bigint>")
    return found.dropDuplicates(["key"])


def _links_in_blocks(crowd: DataFrame, similarity: float) -> DataFrame:
    """Links (u, v) of buckets too full for a join: (band, key, shingles, block) rows, block against block.

    A task holds two blocks of a bucket, compares their paragraphs and returns links that connect what is similar,
    at most one a paragraph, so neither its memory nor its output grows with the square of the bucket.
    """
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    pairs = crowd.withColumn("other", other).select(
        "band", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "block", "key", "shingles"
    )

    def within(frame):
        keys = frame["key"].tolist()
        sets = [set(s) for s in frame["shingles"]]
        side = frame["block"].tolist()
        twin = frame["a"].iat[0] == frame["b"].iat[0]
        root = list(range(len(keys)))

        def top(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for i, one in enumerate(sets):
            for j in range(i + 1, len(sets)):
                if not twin and side[i] == side[j]:
                    continue
                two = sets[j]
                if min(len(one), len(two)) < similarity * max(len(one), len(two)):
                    continue
                x, y = top(i), top(j)
                if x == y:
                    continue
                both = len(one & two)
                if both >= similarity * (len(one) + len(two) - both) - 1e-9:
                    root[max(x, y)] = min(x, y)
        out = [(keys[i], keys[top(i)]) for i in range(len(keys)) if top(i) != i]
        return type(frame)({"u": [a for a, _ in out], "v": [b for _, b in out]}, dtype="int64")

    return pairs.groupBy("band", "a", "b").applyInPandas(within, "u bigint, v bigint")


def paragraph_classes(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = 1, similarity: float = 0.8, bucket: int = 48
) -> DataFrame:
    """(id, start, words, source, root): paragraphs that have a copy or near copy, by MinHash banding.

    ``root`` tells classes apart and ``source`` is the smallest id in the paragraph's class: the connected component of paragraphs whose 5-word
    shingle sets have Jaccard similarity of at least ``similarity``; lines too short for a shingle have equal ones
    only. Buckets of up to ``bucket`` distinct
    paragraphs are compared by a join; fuller ones block against block (``_links_in_blocks``), also exactly.
    """
    every = _paragraphs(docs, id_column, text_column, least, banded=True).where("id is not null")
    nodes = every.groupBy("key").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"), F.first("bands").alias("bands"))
    nodes = cut(nodes)
    banded = nodes.select("key", "first", F.explode("bands").alias("band"))
    full = banded.groupBy("band").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    met = cut(banded.join(full, "band"))
    wanted = met.select("key", F.col("first").alias("id")).distinct()
    sets = cut(_shingle_sets(docs, wanted, id_column, text_column, least))

    usual = met.where(F.col("m") <= bucket).select("band", "key")
    pairs = (
        usual.alias("a").join(usual.alias("b"), (F.col("a.band") == F.col("b.band")) & (F.col("a.key") < F.col("b.key")))
        .select(F.col("a.key").alias("u"), F.col("b.key").alias("v")).distinct()
    )
    one, two = sets.select(F.col("key").alias("u"), F.col("shingles").alias("su")), sets.select(F.col("key").alias("v"), F.col("shingles").alias("sv"))
    both = F.size(F.array_intersect("su", "sv"))
    joint = F.size("su") + F.size("sv") - both
    near = pairs.join(one, "u").join(two, "v").where(both >= F.lit(similarity) * joint - 1e-9).select("u", "v")

    crowd = met.where(F.col("m") > bucket).join(sets, "key").withColumn("blocks", F.ceil(F.col("m") / BLOCK))
    crowd = crowd.select("band", "key", "shingles", "blocks", F.pmod(F.xxhash64("key"), F.col("blocks")).alias("block"))
    links = near.unionByName(_links_in_blocks(crowd, similarity))

    roots = components(links).select(F.col("node").alias("key"), "root")
    owned = nodes.join(roots, "key", "left").select("key", "first", "n", F.coalesce("root", "key").alias("root"))
    classes = owned.groupBy("root").agg(F.min("first").alias("source"), F.sum("n").alias("size")).where("size > 1")
    named = owned.join(classes, "root").select("key", "source", "root")
    # The places of all paragraphs are read from the texts again, which costs no signatures and no disk.
    places = _paragraphs(docs, id_column, text_column, least, banded=False).where("id is not null")
    return places.select("id", "start", "words", "key").join(named, "key").select("id", "start", "words", "source", "root")


def repeated_spans(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = 1, similarity: float = 0.8
) -> DataFrame:
    """(id, kind, start, words, source, removed) of all text that stands somewhere else as well.

    ``kind`` is 'paragraph' (see ``paragraph_classes``) or 'passage' (see ``repeated_passages``); ``start`` and
    ``words`` count white-separated words of the whole text. A span is ``removed`` in every document but its
    source; a paragraph class inside one document keeps its first row. Words are compared in lower case. NULL,
    and empty texts have no spans, rows with a NULL id none. Rows of a repeated id count as one document:
    its paragraphs are copies of each other, its passages are not. An empty table gives no rows.
    """
    lines = paragraph_classes(docs, id_column, text_column, least, similarity)
    first = F.row_number().over(W.partitionBy("id", "root").orderBy("start")) == 1
    lines = lines.select(
        "id", F.lit("paragraph").alias("kind"), "start", "words", "source", (~((F.col("id") == F.col("source")) & first)).alias("removed")
    )
    spans = repeated_passages(docs, id_column, text_column).select(
        "id", F.lit("passage").alias("kind"), "start", "words", "source", (F.col("id") != F.col("source")).alias("removed")
    )
    return lines.unionByName(spans)
