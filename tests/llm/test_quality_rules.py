"""Quality rules against a plain Python form, and each rule at its bound."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from trailmark.llm import quality_rules as Q

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def plain(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows: dict[tuple, list[int]] = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_counts_equal_a_plain_form(spark, docs_of):
    rng = random.Random(3)
    texts = [None, "", " \n\t ", "\n\n", "a", "a b", "a b c", "a b c a b c", "x x x x", "    é😀 é😀", "#*$ %&|<>"]
    texts += [" ".join(rng.choice("abcd") for _ in range(rng.randint(0, 40))) for _ in range(60)]
    texts += ["".join(rng.choice("ab \n\t\r\x0b\x0c#é😀") for _ in range(rng.randint(0, 80))) for _ in range(150)]
    texts += [" ".join(str(rng.randint(0, 3000)) for _ in range(60_000)), "w " * 20_000]
    got = {r.doc_id: tuple(r[c] for c in BASE) for r in Q.judge(docs_of(texts)).collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}


def test_base_bounds(spark, docs_of):
    words = [f"the w{i}" for i in range(25)]
    fifty, forty_nine = " ".join(words), " ".join(words)[4:]
    half = "the b c d e " * 2 + " ".join(f"of u{i}" for i in range(20))  # 50 words, of which 10 are repeated
    over = "the b c " * 12 + " ".join(f"of u{i}" for i in range(17))  # 36 of 70
    rows = {r.doc_id: r for r in Q.judge(docs_of([fifty, forty_nine, half, over, None])).collect()}
    assert [rows[i].base_failed for i in range(5)] == [False, True, False, True, True]
    assert rows[0].kept and not rows[1].kept and rows[4].failed_rules == ["too_short"]


@pytest.mark.parametrize(
    "rule,text",
    [
        ("symbols", "the word### of "), ("shouting", "the word! of! "), ("word_length", "t h e t h e " + "q "), ("no_stop_words", "zzz "),
    ],
)
def test_each_rule_is_named(spark, docs_of, rule, text):
    long = " ".join(f"{text.strip()}{i if rule != 'word_length' else ''}" for i in range(60))
    assert rule in Q.judge(docs_of([long])).first().failed_rules


def test_line_rules(spark, docs_of):
    body = "\n".join(f"the story{i} goes{i} on here{i}" for i in range(20))
    bullets = "\n".join(f"- the story{i} goes{i} on here{i}" for i in range(20))
    cut = "\n".join(f"the story{i} goes{i} on here{i}..." for i in range(20))
    again = "\n".join(["the story goes on here and of it"] * 15)
    failed = [r.failed_rules for r in Q.judge(docs_of([body, bullets, cut, again])).orderBy("doc_id").collect()]
    assert failed[:3] == [[], ["bullets"], ["cut_lines"]] and "repeated_lines" in failed[3]


def test_own_table_of_rules_and_unknown_measures(spark, docs_of):
    rules = [Q.Rule("tiny", "n_words", low=2), Q.Rule("huge", "n_words", high=3)]
    got = Q.judge(docs_of(["a", "a b", "a b c d", None]), rules, base=["tiny"]).orderBy("doc_id").collect()
    assert [(r.failed_rules, r.base_failed, r.kept) for r in got] == [
        (["tiny"], True, False), ([], False, True), (["huge"], False, False), (["tiny"], True, False),
    ]
    with pytest.raises(ValueError, match="unknown measure"):
        Q.judge(docs_of(["a"]), [Q.Rule("x", "no such")])


def test_repeated_rows_clashing_columns_and_empty_tables(spark, docs_of):
    docs = docs_of(["a b c", "a b c"], ids=[None, None]).withColumn("kept", F.lit("x")).withColumn("n_words", F.lit(-1)).withColumn("a.b", F.lit(1))
    rows = Q.judge(docs).collect()
    assert len(rows) == 2 and all(r.n_words == 3 and r.kept is False and r["a.b"] == 1 for r in rows)
    assert Q.judge(docs.limit(0)).count() == 0


def test_plan_is_one_projection_without_python(spark, docs_of):
    plan = Q.judge(docs_of(["a"]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
