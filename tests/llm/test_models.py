"""Tokens by round trip and a reference encoder; classifiers by held-out accuracy and special texts."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from trailmark.llm import bpe, quality, toxicity
from trailmark.llm.common import held_out, table

SF = "/root/testdata/sf0.001"
BIG = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_ranks(PATH), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def test_the_perfect_hash_has_every_key_and_no_other(codec):
    ranks = bpe.read_ranks(PATH)
    assert None not in codec.table.keys and len(codec.table.keys) == len(ranks)
    assert all(codec.table.get(k) == v for k, v in ranks.items())
    assert codec.table.get(b"not a token at all") is None and bpe.PerfectHash({}).get(b"x") is None


def test_random_texts_encode_as_the_reference_does(codec, reference):
    rng = random.Random(1)
    letters = "ab 's'tre\n\t    \x1c\x85é1½²,.!?あ😀́Z  "
    for _ in range(4000):
        s = "".join(rng.choice(letters) for _ in range(rng.randint(0, 16)))
        assert codec.encode(s) == reference.encode_ordinary(s), repr(s)
    long = "ab" * 60_000
    assert codec.decode(codec.encode(long)) == long.encode()


def test_ranks_beyond_twenty_bits_and_other_patterns():
    ranks = {bytes([b]): b for b in range(256)} | {b"ac": 1 << 20 | 5, b"xa": 300, b"!\n": 256}
    far = tiktoken.Encoding("far", pat_str=bpe.WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = bpe.Codec(ranks, bpe.WORD_PATTERN)
    for s in ("xac", "ac", "xa ac", "acx"):
        assert codec.encode(s) == far.encode_ordinary(s)
    pattern = r" ?[^\s\p{L}\p{N}]+[\r\n]*|\p{L}+|\p{N}|\s+"
    other = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    codec = bpe.Codec(ranks, pattern)
    for s in ("a!\nb", "!\n!\n", " !\n\n x", "12ab", "", "\n"):
        assert codec.encode(s) == other.encode_ordinary(s), s
    assert public_tokenizers.PATTERN == bpe.WORD_PATTERN


def test_a_small_memo_changes_nothing(reference):
    codec = bpe.Codec(bpe.read_ranks(PATH), public_tokenizers.PATTERN, memo=3)
    text = "some words, and some, more words and words " * 20
    assert codec.encode(text) == reference.encode_ordinary(text)


def test_documents_round_trip(spark, docs_of, reference):
    shared = bpe.shared_codec(spark, PATH, public_tokenizers.PATTERN)
    texts = [None, "", " ", "a <|endoftext|> b", "é" * 3000, *[r.text for r in table(spark, SF, "documents").limit(700).collect()]]
    docs = docs_of(texts).withColumn("ids", F.lit("clash")).withColumn("decoded", F.lit(0)).coalesce(1)
    rows = bpe.decode(bpe.encode(docs, shared), shared).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.ids == reference.encode_ordinary(texts[r.doc_id] or "") and bytes(r.decoded) == (texts[r.doc_id] or "").encode()
    assert bpe.decode(bpe.encode(docs.limit(0), shared), shared).count() == 0


@pytest.mark.parametrize(("module", "label", "threshold"), [(quality, "quality", 0.3), (toxicity, "toxic", 0.5)])
def test_held_out_accuracy(spark, module, label, threshold):
    docs, labels = table(spark, BIG, "documents"), table(spark, BIG, "labels")
    model = module.fit(docs, labels)
    scored = docs.select("doc_id", module.score(F.col("text"), model).alias("s")).join(labels, "doc_id")
    rows = scored.where(held_out(F.col("doc_id"))).collect()
    assert sum((r.s >= threshold) == (r[label] == 1) for r in rows) >= 0.93 * len(rows)
    wrong = [r for r in rows if r.s >= threshold and r[label] == 0]
    assert len(wrong) <= 0.02 * len(rows)
    for text in (None, "", " \n ", "word " * 50_000):
        assert 0 <= model.score(text) <= 1


@pytest.mark.parametrize("module", [quality, toxicity])
def test_labels_of_one_class_or_none(spark, docs_of, module):
    docs = docs_of(["a b c", "d e", None]).withColumn("label", F.lit(1))
    one = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 1, 0), (None, 1, 1), (0, None, None)], "doc_id long, quality int, toxic int")
    for labels in (one, one.limit(0)):
        model = module.fit(docs, labels)
        assert 0 <= docs.select(module.score(F.col("text"), model).alias("s")).first().s <= 1
    assert docs.limit(0).select(module.score(F.col("text"), model)).count() == 0


def test_identity_terms_are_no_evidence():
    """A term that goes with toxic text in the labels must not move the score when the fit is regularised."""
    names = ["muslim", "christian", "awful"]
    x = [[0, 2]] * 30 + [[0]] * 6 + [[1]] * 30 + [[1, 2]] * 3 + [[]] * 20
    y = np.array([1.0] * 30 + [1.0] * 3 + [0.0] * 3 + [0.0] * 30 + [1.0] * 3 + [0.0] * 20)
    pairs = [([0], [1])] * 30 + [([1], [0])] * 30
    free, _ = toxicity.fit_weights(x, y, [], len(names), 1e-4, 0.0)
    fair, _ = toxicity.fit_weights(x, y, pairs, len(names), 1e-4, 5.0)
    assert free[0] - free[1] > 1 and abs(fair[0] - fair[1]) < 0.3 and fair[2] > 1
    assert toxicity.swapped("The Muslim women.", toxicity.IDENTITY) == "the christian men"
    assert toxicity.swapped("nobody here", toxicity.IDENTITY) is None


def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(0)
    for n in (1, 2, 5):
        potential, move = rng.normal(size=n), rng.normal(size=(2, 2))
        total, good = 0.0, np.zeros(n)
        for path in np.ndindex(*(2,) * n):
            w = sum(potential[i] for i in range(n) if path[i]) + sum(move[a, b] for a, b in zip(path, path[1:]))
            total += np.exp(w)
            good += np.exp(w) * np.array(path)
        assert np.allclose(quality.good_marginals(potential, move), good / total)
        z, marg, _ = quality._expected(potential[None, :], np.ones((1, n), bool), move)
        assert np.isclose(z, np.log(total)) and np.allclose(marg[0], good / total)


def test_lines_keep_their_labels(spark, docs_of):
    docs = docs_of(["good line here.\n%%% *** ###", None])
    model = quality.fit(table(spark, BIG, "documents"), table(spark, BIG, "labels"), rows=200)
    rows = quality.line_quality(docs, model).collect()
    assert sorted((r.id, r.line) for r in rows) == [(0, 0), (0, 1), (1, 0)]
