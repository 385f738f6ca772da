"""How two tokenizers cut the same texts: byte-aligned token groups, token pairs, and how common the pairs are.

Texts are shuffled whole and each distinct one is encoded and aligned once, with the number of documents that hold
it. A pair of tokens is linked where their byte ranges overlap; its count is the number of documents that hold it
linked, so each distinct text adds its multiplicity once. The measures of a text are sums over its links. Frequent
pairs, whose number the threshold bounds, are looked up where the text lies; only the rest is shuffled by pair.
"""

from __future__ import annotations

import hashlib
import json
import os
import pickle
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tiktoken import Encoding
from tokenizers import Tokenizer

from trailmark.llm.common import stored
from trailmark.plans.skew import join_salting_hot_keys

MODEL_LIMIT = 256 << 20  # bytes: a tokenizer's file is broadcast, a longer one is refused
HOT_PAIRS = 100_000  # at most so many token pairs are looked up without a shuffle
HOT_TEXTS = 1_000  # at most so many texts have their documents spread
BATCH_BYTES = 1 << 20  # texts encoded together

# What a byte-level vocabulary writes for each byte: printable ones as they are, the others from U+0100 on in order.
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_OF = {chr(b): b for b in _PLAIN} | {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in set(_PLAIN))}


# The pre-tokens of a byte-level vocabulary, and letters that every Unicode version sorts alike
# (Latin to combining marks, Cyrillic, punctuation, kana, Han, Hangul).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
UNSETTLED = re.compile("[^\x00-\u036f\u0400-\u0481\u048a-\u0513\u2010-\u2027\u2030-\u2038\u20ac\u3041-\u3093\u30a1-\u30f6\u4e00-\u9fa5\uac00-\ud7a3]").search
LONG_RUN = re.compile(r"\S{4096}|\s{4096}").search


class ByteLevel:
    """A byte-level BPE vocabulary in a tokenizer JSON; special tokens in a text are ordinary text.

    Where the JSON has no more than such a vocabulary, with its merges in the order of their ids, a rank encoder
    gives the same ids at a sixth of the cost. Texts with letters that the two libraries' Unicode tables might
    sort differently, or with very long runs, are left to the tokenizer itself.
    """

    def __init__(self, model: bytes) -> None:
        self.tokenizer = Tokenizer.from_str(model.decode("utf-8"))
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        told = json.loads(model)
        entries, merges = told["model"]["vocab"], told["model"]["merges"]
        self.bytes_of = [b""] * (max(entries.values()) + 1)
        for entry, token in entries.items():
            self.bytes_of[token] = bytes(BYTE_OF[c] for c in entry) if all(c in BYTE_OF for c in entry) else entry.encode()
        for added in told["added_tokens"]:  # never made from a text
            self.bytes_of += [b""] * (added["id"] + 1 - len(self.bytes_of))
        cut = told["pre_tokenizer"] or {}
        joined = [entries.get(m.replace(" ", "") if isinstance(m, str) else "".join(m)) for m in merges]
        plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        plain = plain and not told["normalizer"] and joined == sorted(entries.values())[256:] and not told["model"].get("dropout")
        ranks = {raw: i for i, raw in enumerate(self.bytes_of) if raw}
        self.ranks = Encoding("ranks", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={}) if plain and len(ranks) == len(entries) else None

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        texts = [" " + t for t in texts]
        own = [i for i, t in enumerate(texts) if self.ranks is None or UNSETTLED(t) or LONG_RUN(t)]
        slow = dict(zip(own, self.tokenizer.encode_batch_fast([texts[i] for i in own], add_special_tokens=False)))
        return [slow[i].ids if i in slow else self.ranks.encode_ordinary(t) for i, t in enumerate(texts)]


class Pieces:
    """A piece model with byte fallback that marks spaces by U+2581 and puts one before the text."""

    def __init__(self, model: bytes) -> None:
        self.processor = SentencePieceProcessor(model_proto=model)
        p = self.processor
        self.bytes_of = [
            bytes([int(p.id_to_piece(i)[3:-1], 16)]) if p.is_byte(i) else p.id_to_piece(i).replace("▁", " ").encode("utf-8")
            for i in range(p.get_piece_size())
        ]

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        return self.processor.encode(list(texts), num_threads=1)


class _Side:
    """A tokenizer with its tokens' lengths and decimal names as arrays."""

    WIDTH = 12

    def __init__(self, tokenizer) -> None:
        self.encode, self.bytes_of = tokenizer.encode, tokenizer.bytes_of
        self.length = np.array([len(b) for b in self.bytes_of], dtype=np.int64)
        names = [str(i).encode() for i in range(len(self.bytes_of))]
        self.digits = np.array([len(n) for n in names], dtype=np.int64)
        self.name = np.zeros((len(names), self.WIDTH), dtype=np.uint8)
        for i, n in enumerate(names):
            self.name[i, : len(n)] = np.frombuffer(n, dtype=np.uint8)

    def spelled(self, ids: list[int], raw: bytes) -> bool:
        return b"".join([self.bytes_of[i] for i in ids]) == raw


class Aligner:
    """Aligns the tokens of two tokenizers over a list of texts."""

    def __init__(self, a, b) -> None:
        self.a, self.b = _Side(a), _Side(b)

    def align(self, texts: Sequence[str]) -> list[tuple | None]:
        """(n_a, n_b, n_groups, pairs, times, groups as text) per text; None where one side does not spell the text.

        ``pairs`` has the distinct linked pairs as a << 32 | b in order, ``times`` how often each is linked.
        """
        a, b = self.a.encode(texts), self.b.encode(texts)
        held = []
        for i, t in enumerate(texts):
            raw = b" " + t.encode("utf-8")
            if t and self.a.spelled(a[i], raw) and self.b.spelled(b[i], raw):
                held.append(i)
        out: list[tuple | None] = [None] * len(texts)
        if held:
            for i, found in zip(held, self._aligned([a[i] for i in held], [b[i] for i in held])):
                out[i] = found
        return out

    def _aligned(self, a: list[list[int]], b: list[list[int]]) -> Iterator[tuple]:
        """All texts as one byte string, in which each text's end is an end of both sides."""
        sizes_a, sizes_b = (np.array([len(x) for x in side], dtype=np.int64) for side in (a, b))
        ids_a, ids_b = (np.concatenate([np.array(x, dtype=np.int64) for x in side]) for side in (a, b))
        ends_a, ends_b = np.cumsum(self.a.length[ids_a]), np.cumsum(self.b.length[ids_b])
        # Tokens of no byte have no range: they end where the one before does and are linked to nothing.
        solid_a, solid_b = self.a.length[ids_a] > 0, self.b.length[ids_b] > 0
        cut_a, cut_b = ends_a[solid_a], ends_b[solid_b]
        every = np.concatenate((cut_a, cut_b))
        every.sort(kind="stable")  # two sorted runs are merged
        again = every[1:] == every[:-1]
        shared, every = every[1:][again], every[np.concatenate(([True], ~again))]
        # Each piece between two of all ends lies in one token of either side.
        pairs = ids_a[solid_a][np.searchsorted(cut_a, every)] << 32 | ids_b[solid_b][np.searchsorted(cut_b, every)]
        text_ends = ends_a[np.cumsum(sizes_a) - 1]
        link_at = np.concatenate(([0], np.searchsorted(every, text_ends, "right")))
        group_at = np.concatenate(([0], np.searchsorted(shared, text_ends, "right")))
        letters, letter_at = self._written(ids_a, ids_b, ends_a, ends_b, shared, group_at)
        for k in range(len(a)):
            own, times = np.unique(pairs[link_at[k] : link_at[k + 1]], return_counts=True)
            groups = letters[letter_at[k] : letter_at[k + 1] - 1].tobytes()  # without the last ';'
            yield int(sizes_a[k]), int(sizes_b[k]), int(group_at[k + 1] - group_at[k]), own, times, groups

    def _written(self, ids_a, ids_b, ends_a, ends_b, shared, group_at) -> tuple[np.ndarray, np.ndarray]:
        """All groups as ``a1,a2|b1;`` in bytes, and where each text's groups begin."""
        in_a, in_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)  # the group of each token
        count_a, count_b = np.bincount(in_a, minlength=len(shared)), np.bincount(in_b, minlength=len(shared))
        before_a, before_b = np.cumsum(count_a) - count_a, np.cumsum(count_b)
        # Tokens in the order they are written: a group's of A, then its of B.
        place_a = np.arange(len(ids_a)) + (before_b - count_b)[in_a]
        place_b = np.arange(len(ids_b)) + (before_a + count_a)[in_b]
        n, width = len(ids_a) + len(ids_b), _Side.WIDTH
        names, digits = np.zeros((n, width), dtype=np.uint8), np.empty(n, dtype=np.int64)
        names[place_a], names[place_b] = self.a.name[ids_a], self.b.name[ids_b]
        digits[place_a], digits[place_b] = self.a.digits[ids_a], self.b.digits[ids_b]
        mark = np.full(n, ord(","), dtype=np.uint8)
        last = np.cumsum(count_a + count_b)
        mark[last - count_b - 1], mark[last - 1] = ord("|"), ord(";")
        names[np.arange(n), digits] = mark
        letters = names[np.arange(width) <= digits[:, None]]
        upto = np.concatenate(([0], np.cumsum(digits + 1)))
        return letters, upto[np.concatenate(([0], last))[group_at]]


def shared_aligner(spark: SparkSession, path_a: str, path_b: str, make_a: Callable = ByteLevel, make_b: Callable = Pieces):
    """The two models for all tasks, read once on the driver with their sizes checked, and broadcast.

    The classes travel with them by value, and a worker process unpacks them once for all its tasks.
    """
    models = []
    for path in (path_a, path_b):
        with open(path, "rb") as file:
            models.append(file.read(MODEL_LIMIT + 1))
        if len(models[-1]) > MODEL_LIMIT:
            raise ValueError(f"{path} is longer than {MODEL_LIMIT} bytes")
    return spark.sparkContext.broadcast({"models": models, "make": cloudpickle.dumps((Aligner, make_a, make_b))})


def _unpacked(shared) -> Aligner:
    held = shared.value
    if "aligner" not in held:
        aligner, *makers = pickle.loads(held["make"])
        held["aligner"] = aligner(*[make(model) for make, model in zip(makers, held["models"])])
    return held["aligner"]


_TEXTS = "key string, documents long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"


def _aligned_texts(distinct: DataFrame, shared) -> DataFrame:
    """(key, documents, text) with the text replaced by its alignment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks fill the cores
        aligner = _unpacked(shared)
        for batch in batches:
            sizes = pc.binary_length(batch.column(2)).to_pylist()
            at = 0
            while at < batch.num_rows:
                room, to = BATCH_BYTES, at
                while to < batch.num_rows and (to == at or room >= sizes[to]):
                    room, to = room - sizes[to], to + 1
                yield _told(batch.slice(at, to - at), aligner)
                at = to

    return distinct.select("key", "documents", "text").mapInArrow(run, _TEXTS)


def _told(batch: pa.RecordBatch, aligner: Aligner) -> pa.RecordBatch:
    found = aligner.align(batch.column(2).to_pylist())
    none = np.array([], dtype=np.int64)
    rows = [(0, 0, 0, none, none, b"") if f is None else f for f in found]
    links = [int(r[4].sum()) for r in rows]
    hashes = ["" if f is None else hashlib.sha256(f[5]).hexdigest() for f in found]
    upto = pa.array(np.concatenate(([0], np.cumsum([len(r[3]) for r in rows]))).astype(np.int32))
    pairs = pa.ListArray.from_arrays(upto, pa.array(np.concatenate([r[3] for r in rows])))
    times = pa.ListArray.from_arrays(upto, pa.array(np.concatenate([r[4] for r in rows]).astype(np.int32)))
    counts = [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]
    columns = [batch.column(0), batch.column(1), *counts, pa.array(links, pa.int64()), pa.array(hashes, pa.string()), pairs, times]
    return pa.RecordBatch.from_arrays(columns, names=["key", "documents", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])


def _key(text: Column) -> Column:
    return F.sha2(text, 256)


def distinct_texts(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """(text, documents, key): every text that is neither NULL nor empty once, with its number of rows."""
    text = F.col(f"`{text_column}`")
    once = docs.where(text.isNotNull() & (text != "")).groupBy(text.alias("text")).agg(F.count(F.lit(1)).alias("documents"))
    return once.withColumn("key", _key(F.col("text")))


def align_texts(docs: DataFrame, shared, text_column: str = "text") -> DataFrame:
    """One row per distinct text: its key, the documents that hold it, its token and group counts, the SHA-256 of its
    groups, its distinct linked pairs (a << 32 | b) and how often each is linked. Written to the checkpoint folder."""
    return stored(_aligned_texts(distinct_texts(docs, text_column), shared))


def pair_counts(texts: DataFrame) -> DataFrame:
    """(pair, documents, best) of every linked pair: how many documents hold it, and whether no other pair of its
    first token is held by more. Texts' pairs are combined before the shuffle, weighted by the texts' documents."""
    counts = texts.select("documents", F.explode("pairs").alias("pair")).groupBy("pair").agg(F.sum("documents").alias("documents"))
    counts = stored(counts)
    first = F.shiftrightunsigned("pair", 32)
    most = counts.groupBy(first.alias("first")).agg(F.max("documents").alias("most"))  # a row per token of A
    told = counts.withColumn("first", first).join(most, "first")
    return told.select("pair", "documents", (F.col("documents") == F.col("most")).alias("best"))


def text_measures(texts: DataFrame, counts: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """(key, n_best, count_sum) of every text with links.

    A pair is hot when it has at least 1/``hot_pairs`` of all documents' distinct pairs, so no more than
    ``hot_pairs`` of them can be; they are broadcast. The links of all others are dealt by pair.
    """
    counts = stored(counts)
    total = counts.agg(F.sum("documents")).first()[0] or 0
    frequent = F.col("documents") * hot_pairs >= F.lit(total)
    hot = F.broadcast(counts.where(frequent).select("pair", "documents", "best"))
    links = texts.select("key", F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    links = links.select("key", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))

    def summed(joined: DataFrame) -> DataFrame:
        return joined.groupBy("key").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("documents")).alias("count_sum")
        )

    near = summed(links.join(hot, "pair"))
    far = summed(links.join(hot.select("pair"), "pair", "left_anti").join(counts.where(~frequent), "pair"))
    return near.unionByName(far).groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def alignment(docs: DataFrame, shared, id_column: str = "doc_id", text_column: str = "text", hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """One row per row of ``docs``: (id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256).

    A text that is NULL, empty or not spelled by one side's tokens (one that a side normalises) has no tokens:
    zeros and ''. Rows with equal ids or texts stay rows of their own; each counts as a document. Other columns of
    ``docs`` are ignored; an empty table gives no rows. The documents of the texts that hold at least 1/1000 of all
    documents, 1000 at most, are spread over salts before they meet their text's measures.
    """
    texts = align_texts(docs, shared, text_column)
    measures = text_measures(texts, pair_counts(texts), hot_pairs)
    whole = stored(texts.drop("pairs", "times").join(measures, "key", "left").fillna(0, ["n_best", "count_sum"]))
    total = whole.agg(F.sum("documents")).first()[0] or 0
    hot = whole.where(F.col("documents") * HOT_TEXTS >= F.lit(total)).select("key")
    text = F.col(f"`{text_column}`")
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.when(text != "", _key(text)).alias("key"))
    told = join_salting_hot_keys(rows.where("key is not null"), whole.drop("documents"), ["key"], hot, ["id"]).drop("key")
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    nothing = rows.where("key is null").select("id", *[F.lit(0).cast("long").alias(n) for n in numbers], F.lit("").alias("groups_sha256"))
    return told.select("id", *numbers, "groups_sha256").unionByName(nothing)
