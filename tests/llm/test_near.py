"""SimHash, repeated paragraphs, components and decontamination against brute force."""

from __future__ import annotations

import itertools
import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from trailmark.llm import decontaminate, paragraphs, simhash
from trailmark.llm.components import components


def classes_of(nodes, linked):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        x, y = sorted((top(a), top(b)))
        root[y] = x
    return {n: top(n) for n in nodes}


def test_components_of_chains_stars_and_nothing(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 40)] + [(7, 7), (500, 501), (501, 500)]
    links += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(80)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    want = classes_of({n for p in links for n in p}, links)
    assert got == {n: r for n, r in want.items() if any(n in p for p in links if p[0] != p[1])}
    assert components(spark.createDataFrame([(1, 1), (None, 2)], "u long, v long")).count() == 0


def brute_fingerprint(text, shingle=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", low) if w]
    if not words:
        return 0
    runs = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_components(docs_of):
    texts = [None, "", "  \t", "A b", "a B", "É b c d", "é b c d", "a b c", "w " * 40_000, "one two three", "one two three four"]
    got = {r.id: r for r in simhash.near_duplicates(docs_of(texts).withColumn("fp", F.lit("x"))).collect()}
    for i, t in enumerate(texts):
        assert got[i].fp % 2**64 == brute_fingerprint(t)
    assert got[2].component_id == 0 and got[4].component_id == 3
    assert simhash.near_duplicates(docs_of([])).count() == 0
    repeated = simhash.near_duplicates(docs_of(["z y x", "z y x", None], [9, 9, None])).collect()
    assert sorted((r.id or -1, r.component_id or -1) for r in repeated) == [(-1, -1), (9, 9), (9, 9)]


def test_links_connect_all_close_pairs_in_small_and_full_buckets(spark):
    rng = random.Random(11)
    base = [rng.getrandbits(64) for _ in range(6)]
    words = set(base)
    for b in base:
        for _ in range(60):
            words.add(b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    words |= {rng.getrandbits(64) for _ in range(60)}
    signed = sorted(w - (1 << 64) if w >> 63 else w for w in words)
    fps = spark.createDataFrame([(w,) for w in signed], "fp long")
    for bits, bucket in ((1, 64), (2, 64), (2, 2), (3, 64)):
        close = [(a, b) for a, b in itertools.combinations(signed, 2) if ((a ^ b) % 2**64).bit_count() <= bits]
        got = [(r.u, r.v) for r in simhash.links(fps, bits, bucket).collect()]
        assert classes_of(signed, got) == classes_of(signed, close), (bits, bucket)
        if bucket == 64 and bits == 1:
            assert all(((a ^ b) % 2**64).bit_count() <= bits for a, b in got)


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def test_repeated_passages_and_paragraphs(docs_of):
    rng = random.Random(2)
    passage, line = prose(rng, 60), prose(rng, 80)
    words = line.split()
    near = " ".join([*words[:40], "changed", *words[41:]])
    far = " ".join(w if i % 8 else "other" for i, w in enumerate(words))
    texts = [
        prose(rng, 30) + " " + passage + " " + prose(rng, 33) + ".",
        prose(rng, 200),
        prose(rng, 11) + "\n" + prose(rng, 7) + " " + passage.upper() + " " + prose(rng, 50),
        "intro " + prose(rng, 3) + "\n" + line,
        near + "\n" + prose(rng, 40),
        far,
        None, "", prose(rng, 3), "same word " * 3000, line + "\n" + prose(rng, 30) + "\n" + line,
    ]
    got = paragraphs.repeated_spans(docs_of(texts).withColumn("key", F.lit("clash"))).collect()
    passages = {r.id: r for r in got if r.kind == "passage" and r.id in (0, 2)}
    assert {i: (r.source, r.removed) for i, r in passages.items()} == {0: (0, False), 2: (0, True)}
    assert 30 <= passages[0].start and passages[0].start + passages[0].words <= 90 and passages[0].words >= 15
    lines = sorted((r.id, r.start, r.source, r.removed) for r in got if r.kind == "paragraph")
    assert lines == [(3, 4, 3, False), (4, 0, 3, True), (10, 0, 3, True), (10, 110, 3, True)]
    assert not {1, 5, 6, 7, 8, 9} & {r.id for r in got}
    assert paragraphs.repeated_spans(docs_of([])).count() == 0


def test_short_repeated_lines(docs_of):
    rng = random.Random(8)
    nine, five, two = prose(rng, 9), prose(rng, 5), prose(rng, 2)
    many = prose(rng, 18).split()
    near = " ".join(["changed", *many[1:]])  # 13 of 15 shingles
    texts = [f"{prose(rng, 4)}\n{nine}\n{five}", nine.upper(), f"{two}\n{five}", f"{prose(rng, 6)}\n\n{two}", " ".join(many), near, prose(rng, 3)]
    got = sorted((r.id, r.start, r.words, r.source, r.removed) for r in paragraphs.repeated_spans(docs_of(texts)).collect() if r.kind == "paragraph")
    assert got == [
        (0, 4, 9, 0, False), (0, 13, 5, 0, False), (1, 0, 9, 0, True), (2, 0, 2, 2, False), (2, 2, 5, 0, True),
        (3, 6, 2, 2, True), (4, 0, 18, 4, False), (5, 0, 18, 4, True),
    ]


def test_full_buckets_give_the_same_classes(docs_of):
    rng = random.Random(4)
    base = prose(rng, 90).split()
    texts = []
    for i in range(120):
        w = base[:]
        for _ in range(rng.choice((0, 1, 1, 2))):
            w[rng.randrange(90)] = f"v{rng.randrange(40)}"
        texts.append(" ".join(w))
    sets = [{tuple(t.split()[k : k + 5]) for k in range(86)} for t in texts]
    close = [(a, b) for a, b in itertools.combinations(range(120), 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    want = classes_of(range(120), close)
    for bucket in (2, 1000):
        got = {r.id: r.source for r in paragraphs.paragraph_classes(docs_of(texts), bucket=bucket).collect()}
        assert got == {i: s for i, s in want.items() if list(want.values()).count(s) > 1}


QUESTION = "If Anna buys 12 apples and gives 5 apples to Ben how many kilometers does Anna walk to the market after the rain"


def test_contamination_of_reworded_and_partial_items(docs_of, spark):
    bench = spark.createDataFrame([(1, QUESTION), (1, QUESTION), (2, None), (3, "too short"), (4, "A B C D E F G H I J K")], "item_id long, text string")
    swapped = QUESTION.replace("Anna", "Maria").replace("12", "1,200.5").replace("5 ", "7 ").replace("kilometers", "miles")
    broken = QUESTION.replace("does Anna", "does Carla")
    rng = random.Random(1)
    texts = [
        prose(rng, 40) + " " + QUESTION + " " + prose(rng, 9), swapped, prose(rng, 5) + "\n" + swapped.replace(" ", "\n"),
        " ".join(QUESTION.split()[:9]), broken, None, "", "A B C D E F G H I J K", prose(rng, 20_000), QUESTION,
    ]
    docs = docs_of(texts).withColumn("item_id", F.lit(1)).withColumn("hash", F.lit(0))
    got = {r.doc_id: r for r in decontaminate.contamination(docs, bench).collect()}
    assert set(got) >= {0, 1, 2, 9} and not set(got) & {3, 5, 6, 7, 8}
    assert 4 not in got or got[4].coverage < 1
    assert (got[0].reworded, got[1].reworded, got[2].reworded, got[9].reworded) == (False, True, True, False)
    assert all(r.item_id == 1 and r.coverage == 1 for i, r in got.items() if i != 4)
    assert {r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()} >= {3, 5, 6, 7, 8}
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0
    assert decontaminate.contamination(docs, bench.limit(0)).count() == 0


def test_contamination_whatever_the_letter_case(docs_of, spark):
    bench = spark.createDataFrame([(1, QUESTION)], "item_id long, text string")
    other = QUESTION.replace("12", "13")
    docs = docs_of([QUESTION.upper(), QUESTION.title(), QUESTION.lower(), other.upper(), "so " + other.title(), prose(random.Random(3), 60).upper()])
    got = {r.doc_id: (r.coverage, r.reworded) for r in decontaminate.contamination(docs, bench).collect()}
    assert got == {0: (1.0, False), 1: (1.0, False), 2: (1.0, False), 3: (1.0, True), 4: (1.0, True)}
    assert [r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()] == [5]


def test_one_inconsistent_slot_leaves_the_other_windows(docs_of, spark):
    tail = " then " + prose(random.Random(5), 30)
    bench = spark.createDataFrame([(1, QUESTION + tail)], "item_id long, text string")
    docs = docs_of([(QUESTION + tail).replace("does Anna", "does Carla"), QUESTION.replace("does Anna", "does Carla"), prose(random.Random(6), 60)])
    got = {r.doc_id: r for r in decontaminate.contamination(docs, bench).collect()}
    assert set(got) == {0, 1}
    # The second Anna is token 16 of 54; no window with it is left, all others are.
    assert [(r.matched_tokens, r.item_tokens, r.reworded) for r in (got[0],)] == [(53, 54, False)]


def test_items_without_a_usable_window(docs_of, spark):
    items = ["Who wrote Hamlet?", "12 + 5 - 3 * 44 / 2 + 9 - 17 + 6 =", "Anna Maria Carla Ben Tom Rosa Paul Nina Otto",
             "\u4e2d\u56fd\u7684\u9996\u90fd\u662f\u54ea\u4e2a\u57ce\u5e02\uff1f", "\u65e5\u672c\u306e\u9996\u90fd", "A B C D E F G H I J"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = [f"so {x.upper()} and" for x in items]
    texts[3] = "\u8bf7\u95ee" + items[3][:-1] + "\u5462"
    texts += ["Who wrote it", "12 + 5 - 3 * 44 / 2 + 9 - 17 + 7", "\u4e2d\u56fd\u4eba", None, "12"]
    got = {(r.doc_id, r.item_id): (r.coverage, r.reworded) for r in decontaminate.contamination(docs_of(texts), bench).collect()}
    assert got == {(i, i): (1.0, False) for i in range(5)}


def test_runs_hash_by_all_their_tokens(spark):
    tokens = [5, 6, 7, 8, 5, 6, 7, 8, 5, 6, 7, 9, 5]
    for length in (1, 2, 3, 5, 7, 8, 13, 14):
        row = decontaminate._hash_runs(spark.createDataFrame([(tokens,)], "t array<long>"), "t", length).first()
        usable = max(len(tokens) - length + 1, 0)
        runs = [tuple(tokens[i : i + length]) for i in range(usable)]
        assert len(set(zip(runs, row.t[:usable]))) == len(set(runs)) == len(set(row.t[:usable])), length


def test_documents_hash_a_token_once_not_once_a_window(docs_of, spark):
    bench = spark.createDataFrame([(1, "twelve red birds cross the wide river near Paris at dawn")], "item_id long, text string")
    windows = decontaminate.benchmark_windows(bench, "item_id", "text", 8, 3)
    found = decontaminate.matched_windows(docs_of(["x"]), windows, "doc_id", "text", 8)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64(slice(template" not in plan and "xxhash64(slice(folded" not in plan


def test_lower_case_of_a_text_is_that_of_its_tokens(docs_of, spark):
    words = "ΟΔΟΣ ΣΑΣ İzmir ǅungla STRASSE Straße Ωμέγα Iİ ΑΣ_Σ x9Σ Kg Two 3Kg".split()
    text = " ".join(f"{w}{mark}" for w, mark in zip(words, ".,;:!?'-()/*\""))
    got = decontaminate._tokens(docs_of([text, None, "", " . "]), "doc_id", "text").orderBy("id").collect()
    one = spark.createDataFrame([(w,) for w in got[0].raw], "w string").selectExpr("lower(w) AS w").collect()
    assert got[0].raw == words and got[0].low == [r.w for r in one]
    assert [(r.raw, r.low) for r in got[1:]] == [([], [])] * 3


def test_lines_hashed_together_have_the_signatures_of_each_line():
    rng = random.Random(9)
    texts = [prose(rng, 3) + "\n" + prose(rng, 5) + "\n\n" + prose(rng, 31).upper(), None, "", prose(rng, 4), "\n" + prose(rng, 12) + " ", "a b c d e"]
    for least in (1, 5, 6):
        hasher = paragraphs.Hasher()
        got = paragraphs._lines(hasher, list(range(len(texts))), texts, least, True).to_pylist()
        want = []
        for i, text in enumerate(texts):
            at = 0
            for words in paragraphs.split_paragraphs(text):
                if len(words) >= least:
                    hashes = hasher.words(words)
                    shingles = hasher.runs(hashes, 5)
                    keys = np.arange(1, paragraphs.BANDS + 1, dtype=np.uint64)
                    for r in range(paragraphs.ROWS if len(shingles) else 0):
                        low = (shingles[:, None] * hasher.mul + hasher.add).min(axis=0).reshape(-1, paragraphs.ROWS)[:, r]
                        keys = paragraphs.mixed(keys * paragraphs.BASE + low)
                    bands = keys.view(np.int64).tolist() if len(shingles) else None
                    want.append({"id": i, "start": at, "words": len(words), "key": paragraphs.span_key(hashes), "bands": bands})
                at += len(words)
        assert got == want


def test_long_texts_are_hashed_apart():
    long = "x" * paragraphs.CHUNK
    assert [c[0] for c in paragraphs._chunks([1, 2, 3, 4, 5], ["a", long, None, "b", ""])] == [[1, 2], [3, 4, 5]]
