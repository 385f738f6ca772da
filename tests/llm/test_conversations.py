"""Conversation repair against a search over all edits, and the three passes at every block size."""

from __future__ import annotations

import hashlib
import random
import re
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from trailmark.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """The report of one conversation's rows in order, by trying every edit of every row."""
    seen, told, marks = set(), {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}, []
    for role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        marks.append(fault)
        if fault:
            told[fault] += 1
    for (a, _), (b, _) in zip(rows, rows[1:]):
        told["illegal"] += a[:1] + b[:1] not in ("su", "ua", "au")

    @lru_cache(None)
    def best(i, said, run):
        found = []
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", said):
            found.append((0, "", ()))
        if run < 2:
            for r in ("user", "assistant"):
                if re.fullmatch("s?(ua)*u?", said + r[0]):
                    c, a, out = best(i + 1 - 1, short(said + r[0]), run + 1)
                    found.append((c + 5, "I" + a, (r + ":",) + out))
        if i < len(rows):
            (role, text), fault = rows[i], marks[i]
            c, a, out = best(i + 1, said, 0)
            found.append((c + 2, "D" + a, out))
            if fault not in ("blank", "duplicate"):
                for edit, r, price in (("K", role, 0), ("R", "user", 1), ("R", "assistant", 1)):
                    if re.fullmatch("s?(ua)*u?", said + r[:1]) and r[:1]:
                        c, a, out = best(i + 1, short(said + r[0]), 0)
                        found.append((c + price + (5 if fault == "truncated" else 0), edit + a, (f"{r}:{text}",) + out))
        return min(found, default=(10**9, "", ()))

    def short(said):  # the roles so far as far as they matter
        return said if len(said) < 4 else said[-2:] if said[-1] == "a" else said[-3:]

    cost, audit, out = best(0, "", 0)
    return {**told, "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(out).encode()).hexdigest()}, list(out)


def gaps(turns):
    known = [t for t in turns if t is not None]
    return max(known) - min(known) + 1 - len(set(known)) if known else 0


def trial(seed, n=160):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        turn = 0
        for _ in range(rng.randint(1, 7)):
            turn += rng.choice([1, 1, 1, 2, 4])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", ""])
            text = rng.choice(["A.", "b!", "c", " ", "", "d?  \n", "e \x0b", "f."]) if rng.random() < 0.5 else f"{rng.random()}."
            rows += [(conv, turn, role, text)] * rng.choice([1, 1, 1, 1, 2])
    return rows


def ordered(rows):
    key = lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest())
    return [(r[2], r[3]) for r in sorted(rows, key=key)]


def assert_equal(spark, rows, block):
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.conversation: r.asDict() for r in C.report(df, block=block).collect()}
    by: dict = {}
    for r in rows:
        by.setdefault(r[0], []).append((r[0], r[1], " " if r[2] is None else r[2], " " if r[3] is None else r[3]))
    assert set(got) == set(by)
    for conv, own in by.items():
        want, _ = brute(ordered(own))
        want |= {"conversation": conv, "gaps": gaps([r[1] for r in own])}
        assert got[conv] == want, (conv, own)
    return by


@pytest.mark.parametrize("seed,block", [(1, 65_536), (2, 1), (3, 2), (4, 3)])
def test_cheapest_edits_at_every_block_size(spark, seed, block):
    assert_equal(spark, trial(seed), block)


def test_nulls_ties_and_extreme_turns(spark):
    rows = [
        (None, 1, "user", "Hi."), (None, 2, "assistant", "Yes."), (1, None, "user", "x."), (1, None, None, "y."), (1, 3, "user", None),
        (2, None, None, None), (3, 5, "user", "b."), (3, 5, "assistant", "a."), (3, 5, "user", "a."), (4, -(2**63), "user", "a."),
        (4, 2**63 - 1, "assistant", "b."), (2**62 + 1, 1, "user", "Same."), (2**62 + 1, 2, "user", "Same."),
    ]
    by_conv = [r for r in rows if r[0] != 4]
    assert_equal(spark, by_conv, 2)
    got = C.report(spark.createDataFrame(rows, SCHEMA)).where("conversation = 4").first()
    assert got.gaps == 2**63 - 1 and got.audit == "KK"


def test_repaired_rows(spark):
    rows = trial(9, 60)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit("x")).withColumn("edit", F.lit(1))
    for block in (2, 65_536):
        got: dict = {}
        for r in C.repaired(df, block=block).orderBy("conversation", "place").collect():
            got.setdefault(r.conversation, []).append((r.place, f"{r.role}:{r.text}"))
        for conv in {r[0] for r in rows}:
            _, out = brute(ordered([r for r in rows if r[0] == conv]))
            assert got.get(conv, []) == list(enumerate(out))


def test_a_giant_conversation_and_a_row_repeated_very_often(spark):
    giant = [(7, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for t in range(30_000)]
    giant[12_345] = (7, 12_345, "user", "Turn.")
    rows = giant + [(8, 1, "user", "Again.")] * 20_000 + [(8, 2, "assistant", "Yes.")] + [(9, t, "user", "Same.") for t in range(5_000)]
    got = {r.conversation: r for r in C.report(spark.createDataFrame(rows, SCHEMA), block=1_000).collect()}
    assert (got[7].cost, got[7].audit) == (1, "K" * 12_345 + "R" + "K" * 17_654)
    text = "\n".join(f"{'user' if t % 2 == 0 else 'assistant'}:Turn{'' if t == 12_345 else f' {t}'}." for t in range(30_000))
    assert got[7].repaired_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert (got[8].cost, got[8].duplicate, got[8].illegal) == (2 * 19_999, 19_999, 19_999)
    assert got[8].audit == "K" + "D" * 19_999 + "K"
    assert (got[9].duplicate, got[9].audit) == (4_999, "D" * 5_000)


def test_lost_conversations_and_empty_tables(spark):
    turns = spark.createDataFrame([(1, 1, "user", "a."), (2, 1, "user", "a.")], SCHEMA)
    got = {r.conversation: r for r in C.report(turns.where("conv_id = 1"), every=turns).collect()}
    assert (got[2].cost, got[2].audit, got[2].repaired_sha256) == (0, "", hashlib.sha256(b"").hexdigest())
    assert got[1].audit == "D"
    assert C.report(turns.limit(0)).count() == 0 and C.repaired(turns.limit(0)).count() == 0


def test_very_long_texts(spark):
    rows = [(1, 1, "user", "word " * 400_000 + "."), (1, 2, "assistant", "y" * 2_000_000)]
    got = C.report(spark.createDataFrame(rows, SCHEMA)).first()
    assert got.audit == "DD" and got.truncated == 1 and got.cost == 4
