"""Byte-level BPE encoding and decoding with a two-tier lookup.

A minimal perfect hash (hash and displace) holds the vocabulary in arrays of exactly its size. A pre-token that
is a vocabulary entry is one lookup. Any other goes through a heap of pair ranks over a linked list of its byte
pieces, which costs n log n for n bytes, so a pre-token of a million bytes is no trouble.
"""

from __future__ import annotations

import base64
import heapq
import pickle
from array import array
from collections.abc import Iterable, Mapping

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmark.llm.common import by_batch

VOCABULARY_LIMIT = 5_000_000  # entries: a vocabulary is broadcast, a longer one is refused
MEMO = 100_000  # pre-tokens and short chunks of each of the two generations that a worker remembers by default
PAIR = 32  # bits of the right rank in the key of a pair

# Fixed value: the pre-token pattern for which a text may first be cut at white characters.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class PerfectHash:
    """bytes -> rank over a fixed key set, with one slot per key and no empty slot."""

    def __init__(self, ranks: Mapping[bytes, int]) -> None:
        self.size = len(ranks)
        self.buckets = max(1, self.size // 3)
        self.keys: list[bytes | None] = [None] * self.size
        self.ranks = [0] * self.size
        self.displace = [0] * self.buckets
        groups: list[list[bytes]] = [[] for _ in range(self.buckets)]
        for key in ranks:
            groups[xxhash.xxh64_intdigest(key, 0) % self.buckets].append(key)
        order = sorted(range(self.buckets), key=lambda b: -len(groups[b]))
        free = self.size - 1
        for b in order:
            group = groups[b]
            if len(group) > 1:
                seed, slots = self._seed(group)
            elif group:
                while self.keys[free] is not None:
                    free -= 1
                seed, slots = -1 - free, [free]  # alone in its bucket: takes any free slot, named directly
            else:
                continue
            self.displace[b] = seed
            for key, slot in zip(group, slots):
                self.keys[slot], self.ranks[slot] = key, ranks[key]

    def _seed(self, group: list[bytes]) -> tuple[int, list[int]]:
        seed = 0
        while True:
            seed += 1
            slots = [xxhash.xxh64_intdigest(key, seed) % self.size for key in group]
            if len(set(slots)) == len(slots) and all(self.keys[s] is None for s in slots):
                return seed, slots

    def get(self, key: bytes) -> int | None:
        if not self.size:
            return None
        seed = self.displace[xxhash.xxh64_intdigest(key, 0) % self.buckets]
        slot = -1 - seed if seed < 0 else xxhash.xxh64_intdigest(key, seed) % self.size
        return self.ranks[slot] if self.keys[slot] == key else None


POSITION = 32  # bits of a heap entry that hold the position; the rank stands above them


def pair_ranks(ranks: Mapping[bytes, int]) -> dict[int, int]:
    """(left rank << PAIR | right rank) -> rank of both together, for every way to cut an entry in two entries."""
    pairs = {}
    for token, rank in ranks.items():
        for at in range(1, len(token)):
            left, right = ranks.get(token[:at]), ranks.get(token[at:])
            if left is not None and right is not None:
                pairs[left << PAIR | right] = rank
    return pairs


def merge_bytes(piece: list[int], pairs: Mapping[int, int]) -> list[int]:
    """Always join the neighbours of lowest joint rank, the leftmost of equals, until no two can join.

    ``piece`` holds the ranks of single bytes. They form a linked list; a heap has (joint rank, position) of
    every pair that could join, and ``joint`` tells whether an entry that comes up still stands.
    """
    parts, n = piece[:], len(piece)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    known, pop, push = pairs.get, heapq.heappop, heapq.heappush
    joint = [known(a << PAIR | b, -1) for a, b in zip(piece, piece[1:])]
    heap = [rank << POSITION | i for i, rank in enumerate(joint) if rank >= 0]
    joint.append(-1)
    heapq.heapify(heap)
    while heap:
        entry = pop(heap)
        rank = entry >> POSITION
        i = entry - (rank << POSITION)
        if joint[i] != rank:
            continue  # one of the two has joined another meanwhile
        gone = after[i]
        parts[i], joint[gone], after[i], joint[i] = rank, -1, after[gone], -1
        end = after[gone]
        if end < n:
            before[end] = i
            joint[i] = new = known(rank << PAIR | parts[end], -1)
            if new >= 0:
                push(heap, new << POSITION | i)
        left = before[i]
        if left >= 0:
            joint[left] = new = known(parts[left] << PAIR | rank, -1)
            if new >= 0:
                push(heap, new << POSITION | left)
    ids, at = [], 0
    while at < n:
        ids.append(parts[at])
        at = after[at]
    return ids


class Codec:
    """Encodes texts and decodes ids for one vocabulary and one pre-token pattern.

    ``memo`` is the number of pre-tokens that each generation of a worker's memory holds; it changes the cost only.
    """

    # By WORD_PATTERN a pre-token holds white characters only at its start or alone, and letters after at most one
    # space are one pre-token, so a text may first be cut into these chunks. By any other pattern it is not.
    CHUNK = r" ?\S+|\s+(?!\S)|\s+"

    def __init__(self, ranks: Mapping[bytes, int], pattern: str, memo: int | None = None) -> None:
        self.table, self.pairs = PerfectHash(ranks), pair_ranks(ranks)
        self.pattern, self.room = pattern, MEMO if memo is None else memo
        self.byte = [ranks.get(bytes([b]), -1) for b in range(256)]
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self._start()

    def _start(self) -> None:
        compiled = regex.compile(self.pattern)
        self.split, self.matches, self.chunks = compiled.findall, compiled.finditer, regex.compile(self.CHUNK).findall
        # What has been met before, as int32 bytes: unlike lists they cost the garbage collector nothing.
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("split", "matches", "chunks", "memo", "older")}

    def __setstate__(self, state) -> None:
        self.__dict__.update(state)
        self._start()

    def piece(self, token: str) -> list[int]:
        """The ids of one pre-token: a vocabulary entry by the perfect hash, or merged bytes."""
        raw = token.encode("utf-8")
        whole = self.table.get(raw)
        if whole is not None:
            return [whole]
        parts = [self.byte[b] for b in raw]
        if -1 in parts:
            raise ValueError(f"the vocabulary lacks a byte of {token!r}")
        return merge_bytes(parts, self.pairs)

    def _keep(self, key: str, ids: bytes) -> bytes:
        if len(key) <= 64:
            if len(self.memo) >= self.room:
                self.older, self.memo = self.memo, {}
            self.memo[key] = ids
        return ids

    def _token(self, token: str) -> bytes:
        ids = self.memo.get(token)
        if ids is None:
            ids = self.older.get(token)
            ids = self._keep(token, array("i", self.piece(token)).tobytes() if ids is None else ids)
        return ids

    def _chunk(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            if chunk.isalpha() or (chunk[0] == " " and chunk[1:].isalpha()):
                return self._token(chunk)
            ids = b"".join([self._token(token) for token in self.split(chunk)])
        return self._keep(chunk, ids)

    def packed(self, text: str | None) -> bytes:
        """The ids of a text as int32 bytes."""
        if self.pattern != WORD_PATTERN:
            return b"".join([self._token(m.group()) for m in self.matches(text or "")])
        known, make = self.memo.get, self._chunk
        return b"".join([known(chunk) or make(chunk) for chunk in self.chunks(text or "")])

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.packed(text), dtype=np.int32).tolist()

    def decode(self, ids: Iterable[int] | None) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids]) if ids is not None else b""


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank a line."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    if len(pairs) > VOCABULARY_LIMIT:
        raise ValueError(f"{len(pairs)} entries; a vocabulary may have {VOCABULARY_LIMIT}")
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def shared_codec(spark: SparkSession, path: str, pattern: str, memo: int | None = None):
    """The codec for all tasks, built once on the driver from a vocabulary of checked size and broadcast.

    It travels as bytes that hold the code as well, and a worker process unpacks it once for all its tasks.
    """
    return spark.sparkContext.broadcast({"packed": cloudpickle.dumps(Codec(read_ranks(path), pattern, memo))})


def _unpacked(shared) -> Codec:
    held = shared.value
    if "codec" not in held:
        held["codec"] = pickle.loads(held["packed"])
    return held["codec"]


def _with_column(df: DataFrame, source: str, out: str, kind: T.DataType, make) -> DataFrame:
    """``df`` and a column ``out`` made from batches of ``source``; a column of that name is replaced."""
    kept = [c for c in df.columns if c != out]
    schema = T.StructType([df.schema[c] for c in kept]).add(out, kind)

    def work():
        build = make()

        def on(batch: pa.RecordBatch) -> pa.RecordBatch:
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            return pa.RecordBatch.from_arrays([*columns, build(batch.column(batch.schema.get_field_index(source)))], [*kept, out])

        return on

    return df.mapInArrow(by_batch(work), schema)


def _encoder(codec):
    coder = _unpacked(codec)

    def build(texts: pa.Array) -> pa.Array:
        packed = [coder.packed(t) for t in texts.to_pylist()]
        offsets = np.zeros(len(packed) + 1, dtype=np.int32)
        np.cumsum([len(x) // 4 for x in packed], out=offsets[1:])
        flat = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(packed))])
        return pa.ListArray.from_arrays(pa.array(offsets), flat)

    return build


def _decoder(codec):
    coder = _unpacked(codec)

    def build(lists: pa.Array) -> pa.Array:
        # The batch may be a slice: its offsets count from the start of the values of the whole.
        offsets, flat = lists.offsets.to_pylist(), lists.values.to_numpy(zero_copy_only=False)
        return pa.array([coder.decode(flat[x:y].tolist()) for x, y in zip(offsets, offsets[1:])], pa.binary())

    return build


IDS = T.ArrayType(T.IntegerType())


def encode(df: DataFrame, codec, text_column: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with ``out``, the token ids of each whole text (NULL and empty: no ids). One pass, no shuffle."""
    return _with_column(df, text_column, out, IDS, lambda: _encoder(codec))


def decode(df: DataFrame, codec, ids_column: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out``, the bytes that the ids stand for (NULL: none). An id outside the vocabulary raises."""
    return _with_column(df, ids_column, out, T.BinaryType(), lambda: _decoder(codec))


def round_trip(df: DataFrame, codec, text_column: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encode`` and then ``decode`` of its ids, in one worker process a task instead of two; the same columns."""
    kept = [c for c in df.columns if c not in (ids, decoded)]
    schema = T.StructType([df.schema[c] for c in kept]).add(ids, IDS).add(decoded, T.BinaryType())

    def work():
        encoded, back = _encoder(codec), _decoder(codec)

        def on(batch: pa.RecordBatch) -> pa.RecordBatch:
            at = batch.schema.get_field_index
            lists = encoded(batch.column(at(text_column)))
            return pa.RecordBatch.from_arrays([*[batch.column(at(c)) for c in kept], lists, back(lists)], [*kept, ids, decoded])

        return on

    return df.mapInArrow(by_batch(work), schema)


def ids_digest(ids):
    """SHA-256 of the decimal ids joined by commas."""
    return F.sha2(F.array_join(ids.cast("array<string>"), ","), 256)
