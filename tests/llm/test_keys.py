"""Sharding, exact duplicates, fixity and licences on hand-made rows."""

from __future__ import annotations

import hashlib
import random
import re
import textwrap

import pytest
from pyspark.sql import functions as F

from trailmark.llm import exact_dedup, fixity, licenses, sharding

ODD = [None, "", " \n\t", "a b", "ab", "a  b\x0b", "x" * 50_000, "x" * 49_999 + "y", "x" * 50_000, "é", "a b", "ab"]


def jump(key: int, shards: int) -> int:
    b, j, s = -1, 0, key % 2**64
    while j < shards:
        b = j
        s = (s * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2.0**31 / ((s >> 33) + 1)))
    return b


def test_jump_matches_the_published_loop_and_moves_only_into_the_new_shard(spark):
    keys = [None, 0, -1, 2**62, -(2**63), *range(500)]
    df = spark.createDataFrame([(k, "c") for k in keys], "doc_id long, shard string")
    got = sharding.assign_shards(df, "doc_id", 24).collect()
    assert len(got) == len(keys)
    for r in got:
        assert r.shard == jump(r.doc_id or 0, 24) and r.grown_shard == jump(r.doc_id or 0, 25)
        assert r.grown_shard in (r.shard, 24)
    for s in range(24):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    assert 5 < sum(r.grown_shard == 24 for r in got) < 50
    with pytest.raises(ValueError):
        sharding.jump_buckets(__import__("numpy").array([1]), 0)


def test_sharding_of_no_rows_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long")
    assert sharding.assign_shards(empty, "doc_id", 3).count() == 0
    same = spark.createDataFrame([(5,)] * 4, "doc_id long")
    assert sorted(r.slot for r in sharding.assign_shards(same, "doc_id", 3).collect()) == [0, 1, 2, 3]


def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", t or ""), []).append((i, len(t or "")))
    out = []
    for i, t in rows:
        g = groups[re.sub("[\x20\x09-\x0d]", "", t or "")]
        best = min(g, key=lambda x: (-x[1], x[0] is None, x[0] or 0))
        out.append((i, best[0], len(g)))
    return sorted(out, key=str)


def test_exact_duplicates_against_brute_force(docs_of):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("ab \n") for _ in range(rng.randint(0, 5))) for _ in range(200)]
    got = exact_dedup.exact_duplicates(docs_of(texts)).collect()
    assert sorted(((r.id, r.keep_id, r.group_size) for r in got), key=str) == brute_exact(list(enumerate(texts)))
    by_id = {r.id: r for r in got}
    assert all(r.kept == (r.id == r.keep_id) for r in got)
    assert by_id[7].level == "full" and by_id[9].level == "prefix" and by_id[9].full_hash is None
    for r in got:
        if r.full_hash:
            assert r.full_hash == hashlib.sha256(re.sub("[\x20\x09-\x0d]", "", texts[r.id] or "").encode()).hexdigest()


def test_exact_duplicates_of_repeated_rows_null_ids_and_none(docs_of, spark):
    docs = docs_of(["q", "q", "q", "r"], [4, 4, None, None])
    got = exact_dedup.exact_duplicates(docs).collect()
    assert sum(r.kept for r in got) == 2 and all(r.keep_id == 4 for r in got if r.group_size == 3)
    kept = exact_dedup.drop_exact_duplicates(docs.withColumn("kept", F.lit("clash")).withColumn("chars", F.lit(0)))
    assert sorted((r.doc_id or -1, r.text, r.kept) for r in kept.collect()) == [(-1, "r", "clash"), (4, "q", "clash")]
    assert exact_dedup.exact_duplicates(docs.limit(0)).count() == 0
    assert exact_dedup.drop_exact_duplicates(docs.limit(0)).count() == 0


def pages(spark, n, damaged=(), lost=()):
    rows = [(i, f"http://h/{i}", None if i == 3 else f"body {i}{'!' if i in damaged else ''}") for i in range(n) if i not in lost]
    return fixity.warc_records(spark.createDataFrame(rows, "page_id long, url string, html string"), per_file=300)


def test_fixity_finds_what_differs_and_nothing_else(spark):
    ours = pages(spark, 1000)
    assert fixity.audit(ours, pages(spark, 1000)).count() == 0
    got = fixity.audit(ours, pages(spark, 1000, damaged=(0, 17, 299, 300, 999))).collect()
    assert sorted(r.page_id for r in got) == [0, 17, 299, 300, 999] and {r.fault for r in got} == {"changed"}
    assert fixity.roots(ours).count() == 4
    first = ours.where("page_id = 0").first()
    record = b"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: http://h/0\r\nContent-Type: text/html\r\nContent-Length: 6\r\n\r\nbody 0\r\n\r\n"
    assert first.digest == hashlib.sha256(record).hexdigest() and (first.start, first.stop) == (0, len(record))


def test_fixity_of_missing_records_and_empty_replicas(spark):
    got = fixity.audit(pages(spark, 10), pages(spark, 10, lost=(9,))).collect()
    assert [(r.page_id, r.fault) for r in got] == [(9, "missing")]
    got = fixity.audit(pages(spark, 10, lost=(9,)), pages(spark, 10)).collect()
    assert [(r.page_id, r.fault) for r in got] == [(9, "extra")]
    empty = pages(spark, 1).limit(0)
    assert fixity.audit(empty, empty).count() == 0 and fixity.audit(empty, pages(spark, 2)).count() == 2
    odd = spark.createDataFrame([(None, None, None), (1, "u", "h"), (1, "u", "h")], "page_id long, url string, html string")
    assert fixity.audit(fixity.warc_records(odd), fixity.warc_records(odd)).count() == 0


MIT = "\n".join(f"// {licenses.SENTENCES[k]}." for k in ("mit-grant", "mit-notice", "as-is", "no-liability"))
CASES = [
    ("Released under the MIT License.", "MIT", "licensed"),
    ("text\nLicensed under the Apache License, Version 2.0.\nmore", "Apache-2.0", "licensed"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3", "licensed"),
    ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0", "licensed"),
    ("RELEASED  under the mit licence", "MIT", "licensed"),
    (MIT, "MIT", "licensed"),
    ("\n".join(licenses.SENTENCES[k] for k in ("bsd-grant", "bsd-source", "bsd-binary")), "BSD-2-Clause", "licensed"),
    (licenses.SENTENCES["as-is"], "", "partial"),
    (licenses.SENTENCES["bsd-binary"] + ".\n" + licenses.SENTENCES["bsd-grant"], "", "partial"),
    ("We talk of software licences and permission here.", "", "none"),
    ("Licensed under CC BY 4.0.\nReleased under the MIT License.\nReleased under the MIT License.", "CC-BY-4.0;MIT;MIT", "licensed"),
    (None, "", "none"),
    ("", "", "none"),
    ("permission " * 20_000, "", "none"),
]


def test_licences_by_ordered_rules(docs_of):
    got = {r.id: r for r in licenses.scan(docs_of([c[0] for c in CASES]).withColumn("status", F.lit(1))).collect()}
    for i, (_, names, status) in enumerate(CASES):
        assert (";".join(got[i].licenses), got[i].status) == (names, status), CASES[i]
    assert licenses.scan(docs_of([])).count() == 0


def wrapped(mark, *sentences):
    """The sentences as one paragraph of a comment, in lines of 60 characters."""
    return "\n".join(mark + line for line in textwrap.wrap(" ".join(s + ("" if s.endswith(":") else ".") for s in sentences), 60))


def test_wrapped_notices():
    says = {k: v.replace("<version>", "3").replace("<any>", "Some Owner") for k, v in licenses.SENTENCES.items()}
    read = licenses.Recogniser().licences
    for mark in ("", "# ", " * ", "// "):
        blank = "\n" + mark.rstrip() + "\n"
        gpl = wrapped(mark, says["gpl-free"]) + blank + wrapped(mark, says["gpl-hope"], says["gpl-details"])
        assert read(gpl) == (["GPL-3-or-later"], ["gpl-free", "gpl-hope", "gpl-details"], [])
        assert read(wrapped(mark, says["lgpl-free"]) + blank + mark + "more")[0] == ["LGPL-3-or-later"]
        mit = wrapped(mark, says["mit-grant"]) + blank + wrapped(mark, says["mit-notice"]) + blank + wrapped(mark, says["as-is"], says["no-liability"])
        assert read(mit)[0::2] == (["MIT"], [])
        bsd = blank.join(wrapped(mark, says[k]) for k in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names"))
        assert read(bsd)[0::2] == (["BSD-3-Clause"], [])


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""


def test_named_licences_in_usual_notices():
    read = licenses.Recogniser().licences
    for mark in ("", "# ", " * "):
        assert read("\n".join((mark + line).rstrip() for line in APACHE.split("\n")))[0::2] == (["Apache-2.0"], [])
    for text, name in (
        ("This project is released under the MIT License.", "MIT"), ("This code is licensed under the MIT licence.", "MIT"),
        ("licensed under the 3-Clause BSD License", "BSD-3-Clause"), ("It is released under the BSD 2-Clause License.", "BSD-2-Clause"),
        ("This tool is licensed under the GNU General Public License version 3.", "GPL-3"), ("The photos are licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
    ):
        assert read(text)[0] == [name], text
    assert read("This project is not released under the MIT License.")[0] == []
    assert read("If this part is released under the MIT License.")[0] == []
