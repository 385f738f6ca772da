"""Tokenizer alignment against a byte-by-byte form with plain loops."""

from __future__ import annotations

import hashlib
import json
import random
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trailmark.llm import alignment as A
from trailmark.llm.common import table

PATHS = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def shared(spark):
    return A.shared_aligner(spark, *PATHS)


@pytest.fixture(scope="module")
def plain():
    """text -> (ids, bytes) of both sides, by the libraries and the JSON's own byte letters."""
    tokenizer = Tokenizer.from_file(PATHS[0])
    tokenizer.encode_special_tokens = True
    entry = {i: e for e, i in json.load(open(PATHS[0]))["model"]["vocab"].items()}
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = {}, 0
    for b in range(256):
        if b in printable:
            letters[chr(b)] = b
        else:
            letters[chr(256 + extra)], extra = b, extra + 1
    pieces = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])

    def both(text):
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids
        b = pieces.encode(text)
        spell_b = [bytes([int(pieces.id_to_piece(i)[1:-1], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode() for i in b]
        return a, [bytes(letters[c] for c in entry[i]) for i in a], b, spell_b

    return both


def brute(texts, plain):
    seen = []
    for text in texts:
        if not text:
            seen.append(None)
            continue
        a, bytes_a, b, bytes_b = plain(text)
        raw = (" " + text).encode()
        if b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            seen.append(None)
            continue
        links, groups, i, j, end_a, end_b, start = [], [], 0, 0, len(bytes_a[0]), len(bytes_b[0]), (0, 0)
        while True:
            links.append((a[i], b[j]))
            if end_a == end_b:
                groups.append((a[start[0] : i + 1], b[start[1] : j + 1]))
                start = (i + 1, j + 1)
            step_a, step_b = end_a <= end_b, end_b <= end_a
            if step_a:
                i += 1
            if step_b:
                j += 1
            if i == len(a) and j == len(b):
                break
            end_a += len(bytes_a[i]) if step_a else 0
            end_b += len(bytes_b[j]) if step_b else 0
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        seen.append((len(a), len(b), len(groups), links, hashlib.sha256(written.encode()).hexdigest()))
    count = Counter(p for s in seen if s for p in set(s[3]))
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    return [
        (0, 0, 0, 0, 0, 0, "") if s is None
        else (*s[:3], len(s[3]), sum(count[p] == most[p[0]] for p in s[3]), sum(count[p] for p in s[3]), s[4])
        for s in seen
    ]


def rows_of(df):
    return {r.id: tuple(r[c] for c in df.columns if c != "id") for r in df.collect()}


TEXTS = [
    None, "", " ", "a", " a", "Hello world.", "Hello world.", "two  spaces", "tab\tand\nline", "<|endoftext|> <s> </s> <unk> <0x41>", "▁ mark",
    "é😀漢字 नमस्ते", "ﬁ ligature", "x" * 3_000, "é combining", "trailing ", "1234567890 12,5 %", "  nbsp", "\x00 nul", "Straße größer",
]


@pytest.mark.parametrize("hot", [1, 50, A.HOT_PAIRS])
def test_measures_equal_plain_loops(spark, docs_of, shared, plain, hot):
    rng = random.Random(4)
    letters = "ab eé ß漢😀.,\n 12the of and"
    texts = TEXTS + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(80)] + ["Copied text, here."] * 40
    got = rows_of(A.alignment(docs_of(texts), shared, hot_pairs=hot))
    assert got == dict(enumerate(brute(texts, plain)))


def test_documents_of_the_test_tables(spark, shared, plain):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    want = brute([t for _, t in rows], plain)
    assert rows_of(A.alignment(docs, shared)) == {i: w for (i, _), w in zip(rows, want)}


def test_small_and_large_encoding_batches_agree(spark, shared, plain, monkeypatch):
    aligner = A.Aligner(A.ByteLevel(open(PATHS[0], "rb").read()), A.Pieces(open(PATHS[1], "rb").read()))
    texts = [t for t in TEXTS if t]
    whole = aligner.align(texts)
    for i, t in enumerate(texts):
        one = aligner.align([t])[0]
        assert (one is None) == (whole[i] is None)
        if one is not None:
            assert one[:3] == whole[i][:3] and one[5] == whole[i][5] and (one[3] == whole[i][3]).all() and (one[4] == whole[i][4]).all()


def test_the_rank_encoder_sorts_its_letters_as_the_tokenizer_does():
    side = A.ByteLevel(open(PATHS[0], "rb").read())
    assert side.ranks is not None
    texts = []
    for code in range(0x10000):
        c = chr(code)
        if not 0xD800 <= code < 0xE000 and not A.UNSETTLED(c):
            texts.append(f"a{c}b {c} 1{c}{c}2 {c}'s\n{c}  {c}!")
    assert len(texts) > 30_000 and A.UNSETTLED("\u1c80") and A.UNSETTLED("😀")
    got = side.encode(texts)
    want = [e.ids for e in side.tokenizer.encode_batch([" " + t for t in texts], add_special_tokens=False)]
    assert got == want
    model = json.load(open(PATHS[0]))
    model["model"]["merges"][:2] = model["model"]["merges"][1::-1]
    assert A.ByteLevel(json.dumps(model).encode()).ranks is None  # merges in another order than the ids


def test_null_and_repeated_ids_clashing_columns_and_empty_tables(spark, docs_of, shared, plain):
    docs = docs_of(["same", "same", None, "other one"], ids=[None, None, 3, 3])
    docs = docs.withColumn("key", F.lit(1)).withColumn("n_a", F.lit("x")).withColumn("documents", F.lit(0)).withColumn("id", F.lit(9))
    got = sorted(tuple(r)[1:] for r in A.alignment(docs, shared).collect())
    assert got == sorted(brute(["same", "same", None, "other one"], plain))
    assert A.alignment(docs_of([]), shared).count() == 0 and A.alignment(docs_of([None, ""]), shared).count() == 2


def test_a_model_beyond_the_limit_is_refused(spark, monkeypatch):
    monkeypatch.setattr(A, "MODEL_LIMIT", 1000)
    with pytest.raises(ValueError, match="longer than"):
        A.shared_aligner(spark, *PATHS)
