"""Conversation repair: the cheapest edits that make the roles of a conversation alternate, as a streamed DP.

Rows are dealt by conversation and sorted by turn inside each partition; a function over Arrow batches carries the
costs of four states from row to row and batch to batch, so a conversation of any length needs a few numbers. What
it must remember to walk back (four bytes a row) goes out as a row of its own after every block of rows. A
conversation of one block is walked back at once; the blocks of a giant one are sorted the other way and walked in
a second pass. A third pass, again by conversation and turn, meets each block of edits right before the rows it
edits and writes the repaired conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce
from types import SimpleNamespace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.llm.common import WHITE, stored

BLOCK = 65_536  # rows whose way back is held at once

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED = 5  # for a truncated row that is not deleted

# States: nothing yet, after the system row, after a user row, after an assistant row. The roles so far are
# complete in the first and the last.
START, SYSTEM, USER, ASSISTANT = range(4)
#: the state after the one role that a re-roled or inserted row can have, by state
AFTER = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: what completes the roles, by state
CLOSE = ("", INSERT * 2, INSERT, "")
#: the state after keeping a row with this initial; other initials cannot be kept there
KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: edits of one row in ASCII order. An insertion is never put before a deletion: behind it costs the same and
#: comes first in ASCII. Two insertions before a row lead where none does.
WORDS = (DELETE, INSERT + KEEP, INSERT + REROLE, KEEP, REROLE)
LEGAL = ("su", "ua", "au")
NEVER = 1 << 60


def _ways(initial: str) -> list[tuple[int, int, int, int]]:
    """(state before, word, state after, cost) of every edit of a sound row with this initial."""
    ways = []
    for s in range(4):
        for w, word in enumerate(WORDS):
            at = AFTER[s] if word[0] == INSERT else s
            to = at if word == DELETE else AFTER[at] if word[-1] == REROLE else KEPT[at].get(initial)
            if to is not None:
                ways.append((s, w, to, sum(COST[x] for x in word)))
    return ways


_WAYS = {initial: _ways(initial) for initial in ("s", "u", "a", "")}
_SOUND = {i: [(s, w, t, c, c + (0 if WORDS[w] == DELETE else TRUNCATED)) for s, w, t, c in ways] for i, ways in _WAYS.items()}


class Costs:
    """The state of the DP: per state the least cost and the place of its least edits among those of all states.

    No edits that lead to one state begin the edits that lead to another after the same rows, since each row's
    word ends in its only letter that is no insertion; so their order never changes by what follows.
    """

    def __init__(self) -> None:
        self.cost, self.order = [0, NEVER, NEVER, NEVER], [0, 0, 0, 0]

    def add(self, initial: str, must_go: bool, truncated: bool) -> bytes:
        """Take one row; returns its way back, one byte (state before, word) per state."""
        cost, order = self.cost, self.order
        if must_go:
            self.cost = [c + COST[DELETE] for c in cost]
            return _STAY
        best: list[tuple[int, int, int] | None] = [None] * 4
        for s, w, t, sound, cut in _SOUND[initial if initial in ("s", "u", "a") else ""]:
            if cost[s] >= NEVER:
                continue
            found = (cost[s] + (cut if truncated else sound), order[s], w, s)
            if best[t] is None or found < best[t]:
                best[t] = found
        reached = sorted((b[1], b[2], t) for t, b in enumerate(best) if b is not None)
        self.cost = [NEVER if b is None else b[0] for b in best]
        self.order = [0] * 4
        for place, (_, _, t) in enumerate(reached):
            self.order[t] = place
        return bytes(0 if b is None else b[3] * 8 + b[2] for b in best)

    def end(self) -> tuple[int, int]:
        """(cost, state) of the best complete way."""
        total = [(c + len(CLOSE[s]) * COST[INSERT], self.order[s], s) for s, c in enumerate(self.cost) if c < NEVER]
        cost, _, state = min(total)
        return cost, state


_STAY = bytes(s * 8 for s in range(4))


def walk_back(back: bytes, copies: np.ndarray | None, state: int) -> tuple[list[str], int]:
    """(the edits of a block's rows, the state before it) for the state after it."""
    words = []
    for i in range(len(back) // 4 - 1, -1, -1):
        step = back[4 * i + state]
        more = 0 if copies is None else int(copies[i]) - 1
        words.append(WORDS[step & 7] + DELETE * more)
        state = step >> 3
    words.reverse()
    return words, state


# ---------------------------------------------------------------------------------------------- rows and faults

ORDER = ["known", "turn", "role", "digest"]  # of a conversation's rows, after its key


def _prepared(turns: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """The rows under fixed names. ``key`` is the conversation as text, '' for NULL, so workers need no NULL."""
    c, t = F.col(f"`{conversation}`"), F.col(f"`{turn}`").cast("long")
    rows = turns.select(
        F.when(c.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), c.cast("string"))).alias("key"),
        t.isNotNull().alias("known"), F.coalesce(t, F.lit(0)).alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(" ")).alias("text"),
    )
    return rows.withColumn("digest", F.sha2("text", 256))


def _faults(rows: DataFrame) -> DataFrame:
    """One row per distinct row, with its number of ``copies`` and the faults of the first of them.

    Copies are counted before the shuffle by conversation, and only texts' digests are dealt. The earlier rows of
    the same role and text are found by a minimum per (conversation, role, digest), joined back only where there
    are two such rows, so a text that fills a conversation is no task's group.
    """
    body = F.rtrim(F.col("text"), F.lit(WHITE))
    told = rows.select(
        "key", *ORDER, F.substring("role", 1, 1).alias("initial"), (F.btrim("text", F.lit(WHITE)) == "").alias("blank"),
        (~F.substring(body, -1, 1).isin(".", "!", "?")).alias("truncated"),
    )
    entries = told.groupBy("key", *ORDER, "initial", "blank", "truncated").agg(F.count(F.lit(1)).alias("copies"))
    first = (
        entries.groupBy("key", "role", "digest")
        .agg(F.min(F.struct("known", "turn")).alias("first"), F.count(F.lit(1)).alias("times"))
        .where("times > 1").drop("times")
    )
    marked = entries.join(first, ["key", "role", "digest"], "left")
    seen = F.coalesce(F.struct("known", "turn") > F.col("first"), F.lit(False))
    return marked.select("key", *ORDER, "initial", "blank", "truncated", "copies", seen.alias("seen"))


# ------------------------------------------------------------------------------------------------ the three passes

_SUMMARY = "blank long, duplicate long, truncated long, illegal long, gaps long, cost long"
_BLOCKS = f"key string, block long, known boolean, turn long, role string, digest string, edits string, back binary, copies binary, end int, {_SUMMARY}"
_NAMES = [part.split()[0] for part in _BLOCKS.split(", ")]
LONGEST = (1 << 63) - 1


class _Conversation:
    """One conversation on its way through the first pass."""

    def __init__(self, key: str, block: int) -> None:
        self.key, self.limit, self.costs, self.blocks = key, block, Costs(), 0
        self.back, self.copies, self.head = bytearray(), [], None
        self.counts = SimpleNamespace(blank=0, duplicate=0, truncated=0, illegal=0, turns=0, low=0, high=0, extra=0)
        self.last: tuple[str | None, int | None] = (None, None)

    def add(self, known: bool, turn: int, role: str, digest: str, initial: str, blank: bool, truncated: bool, copies: int, seen: bool):
        if self.head is None:
            self.head = (known, turn, role, digest)
        n, (before, earlier) = self.counts, self.last
        cut = truncated and not blank and not seen
        n.blank += copies if blank else 0
        n.duplicate += 0 if blank else copies - (not seen)
        n.truncated += cut
        n.illegal += (before is not None and before + initial not in LEGAL) + (copies - 1)
        if known and (n.turns == 0 or turn != earlier):
            n.low, n.high, n.turns, earlier = (turn if n.turns == 0 else n.low), turn, n.turns + 1, turn
        self.last = initial, earlier
        self.back += self.costs.add(initial, blank or seen, cut)
        n.extra += (copies - 1) * COST[DELETE]  # later copies can only go, in whatever state
        self.copies.append(copies)

    def full(self) -> bool:
        return len(self.copies) >= self.limit

    def block(self, last: bool) -> tuple:
        """The rows since the last block as a row, and a fresh start; a conversation of one block is resolved."""
        copies = None if max(self.copies) == 1 else np.array(self.copies, dtype=np.int64)
        n, end, cost, edits = self.counts, None, None, None
        back = bytes(self.back)
        if last:
            cost, end = self.costs.end()
            cost += n.extra
            if not self.blocks:
                edits, back = "".join(walk_back(back, copies, end)[0]) + CLOSE[end], None
        gaps = min(n.high - n.low + 1 - n.turns, LONGEST) if n.turns else 0
        told = (n.blank, n.duplicate, n.truncated, n.illegal, gaps, cost) if last else (None,) * 6
        row = (self.key, self.blocks, *self.head, edits, back, None if copies is None or back is None else copies.tobytes(), end, *told)
        self.back, self.copies, self.head, self.blocks = bytearray(), [], None, self.blocks + 1
        return row


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=_NAMES, dtype=object)


def _forward(block: int):
    """First pass: rows by conversation and turn in, blocks of edits or of ways back out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now: _Conversation | None = None
        for batch in batches:
            out = []
            columns = [batch[c].tolist() for c in ("key", *ORDER, "initial", "blank", "truncated", "copies", "seen")]
            for key, *row in zip(*columns):
                if now is not None and (key != now.key or now.full()):
                    out.append(now.block(key != now.key))
                if now is None or key != now.key:
                    now = _Conversation(key, block)
                now.add(*row)
            if out:
                yield _frame(out)
        if now is not None:
            yield _frame([now.block(True)])

    return run


def _backward(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Second pass: the blocks of giant conversations, last one first, get their edits."""
    state = 0
    for batch in batches:
        out = []
        for row in batch.itertuples(index=False):
            last = not pd.isna(row.end)
            state = int(row.end) if last else state
            copies = None if row.copies is None else np.frombuffer(row.copies, dtype=np.int64)
            tail = CLOSE[state] if last else ""
            words, state = walk_back(row.back, copies, state)
            out.append((*row[:6], "".join(words) + tail))
        yield pd.DataFrame(out, columns=_NAMES[:7])


def edit_blocks(rows: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(blocks of edits, one summary row per conversation) of prepared rows."""
    entries = _faults(rows).repartition("key").sortWithinPartitions("key", *ORDER)
    found = stored(entries.mapInPandas(_forward(block), _BLOCKS))
    resolved = found.where("edits is not null").select(*_NAMES[:7])
    ways = found.where("edits is null").select(*_NAMES[:10]).repartition("key").sortWithinPartitions("key", F.desc("block"))
    walked = ways.mapInPandas(_backward, ", ".join(_BLOCKS.split(", ")[:7]))
    summary = found.where("end is not null").select("key", *[part.split()[0] for part in _SUMMARY.split(", ")])
    return resolved.unionByName(walked), summary


def _met(rows: DataFrame, blocks: DataFrame, make: Callable[[], SimpleNamespace], schema: str) -> DataFrame:
    """Third pass: edits and rows by conversation and turn, each block of edits before its first row."""
    ours = rows.select("key", *ORDER, F.lit(1).alias("kind"), "text")
    theirs = blocks.select("key", *ORDER, F.lit(0).alias("kind"), F.col("edits").alias("text"))
    both = ours.unionByName(theirs).repartition("key").sortWithinPartitions("key", *ORDER, "kind")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sink, key, edits, at, state = make(), None, "", 0, START

        def inserts() -> None:
            nonlocal at, state
            while at < len(edits) and edits[at] == INSERT:
                at, state = at + 1, AFTER[state]
                sink.row(INSERT, ROLE[state], "")

        for batch in batches:
            for k, role, kind, text in zip(*[batch[c].tolist() for c in ("key", "role", "kind", "text")]):
                if not kind:  # a block of edits; whatever closes the one before is at its end
                    inserts()
                    if k != key:
                        if key is not None:
                            sink.done(key)
                        key, state = k, START
                    edits, at = text, 0
                    sink.edits(edits)
                    continue
                inserts()
                edit, at = edits[at], at + 1
                if edit == REROLE:
                    state = AFTER[state]
                    sink.row(edit, ROLE[state], text)
                elif edit == KEEP:
                    state = KEPT[state][role[0]]
                    sink.row(edit, role, text)
            yield from sink.flush(key, False)
        inserts()
        if key is not None:
            sink.done(key)
        yield from sink.flush(key, True)

    return both.mapInPandas(run, schema)


def _rows_sink() -> SimpleNamespace:
    """Collects the repaired rows of a batch."""
    rows, place, mark = [], 0, 0

    def row(edit: str, role: str, text: str) -> None:
        nonlocal place
        rows.append([None, place, edit, role, text])
        place += 1

    def named(key: str | None) -> None:
        nonlocal mark
        for r in rows[mark:]:
            r[0] = key
        mark = len(rows)

    def done(key: str) -> None:
        nonlocal place
        named(key)
        place = 0

    def flush(key: str | None, last: bool) -> Iterator[pd.DataFrame]:
        nonlocal mark
        named(key)
        if rows:
            yield pd.DataFrame(rows, columns=["key", "place", "edit", "role", "text"])
        rows.clear()
        mark = 0

    return SimpleNamespace(row=row, edits=lambda edits: None, done=done, flush=flush)


def _digest_sink() -> SimpleNamespace:
    """Hashes the repaired conversation row by row; only the edits of the conversation at hand are held."""
    out, parts, state = [], [], [hashlib.sha256(), False]

    def row(edit: str, role: str, text: str) -> None:
        if state[1]:
            state[0].update(b"\n")
        state[0].update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
        state[1] = True

    def done(key: str) -> None:
        out.append((key, "".join(parts), state[0].hexdigest()))
        parts.clear()
        state[:] = [hashlib.sha256(), False]

    def flush(key: str | None, last: bool) -> Iterator[pd.DataFrame]:
        if out:
            yield pd.DataFrame(out, columns=["key", "audit", "repaired_sha256"])
        out.clear()

    return SimpleNamespace(row=row, edits=parts.append, done=done, flush=flush)


# ----------------------------------------------------------------------------------------------------- interface


def _ids(turns: DataFrame, conversation: str) -> DataFrame:
    c = F.col(f"`{conversation}`")
    key = F.when(c.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), c.cast("string")))
    return turns.select(c.alias("conversation"), key.alias("key")).distinct()


def repaired(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block: int = BLOCK
) -> DataFrame:
    """The repaired rows: (conversation, place from 0, edit, role, text), deleted rows left out.

    A conversation's rows count by turn, NULL turns first, then role, then the SHA-256 of the text; a NULL role or
    text is one space. Roles go by their first letter; other letters, and an empty role, can only be given another
    role or be deleted. A conversation of which nothing stays has no row; neither has an empty table. Other columns
    are ignored.
    """
    rows = _prepared(turns, conversation, turn, role, text)
    blocks, _ = edit_blocks(rows, block)
    found = _met(rows, blocks, _rows_sink, "key string, place long, edit string, role string, text string")
    return found.join(_ids(turns, conversation), "key").select("conversation", "place", "edit", "role", "text")


def report(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block: int = BLOCK,
    every: DataFrame | None = None,
) -> DataFrame:
    """One row per conversation: faults, the cost and the edits of the repair, and the SHA-256 of its result.

    Each row's first fault counts: ``blank`` (only white characters), ``duplicate`` (role and text stand earlier in
    the conversation), ``truncated`` (the last visible character ends no sentence). ``illegal`` counts neighbours
    whose roles may not follow each other, ``gaps`` the turns that lack between the least and the greatest. NULLs
    and ties as in ``repaired``; NULL is a conversation of its own. ``every`` (column as ``conversation``) adds
    conversations without a row: zeros, no edits, the hash of nothing.
    """
    rows = _prepared(turns, conversation, turn, role, text)
    blocks, summary = edit_blocks(rows, block)
    digests = _met(rows, blocks, _digest_sink, "key string, audit string, repaired_sha256 string")
    ids = _ids(turns if every is None else every, conversation)
    empty = hashlib.sha256(b"").hexdigest()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    told = reduce(lambda a, b: a.join(b, "key", "left"), [ids, summary, digests])
    return told.select(
        "conversation", *[F.coalesce(c, F.lit(0)).alias(c) for c in numbers], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"),
    )


def damaged(turns: DataFrame, mark: Column) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) with known damage for trials, by ``mark``: 0 drops a row, 1 empties its
    text, 2 takes its sentence ends, 3 repeats it, 4 makes its role user; other rows stay as they are."""
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), mark.alias("mark"))
    text = F.when(F.col("mark") == 1, F.lit("")).when(F.col("mark") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("mark") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.when(F.col("mark") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.where("mark is null or mark != 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("time")).drop("time")
