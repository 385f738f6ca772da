"""The stages on hand-made documents, and the pipeline's contract."""

from __future__ import annotations

import random

import corpus_pipeline as cp
from pyspark.sql import functions as F

from trailmark.llm.common import table

BIG = "/root/testdata/sf0.01"


def test_stages_keep_columns_and_rows_that_are_clean(spark, docs_of):
    rng = random.Random(6)
    clean = [" ".join("".join(rng.choice("klmnop") for _ in range(5)) for _ in range(60)) for _ in range(20)]
    item = table(spark, BIG, "benchmark").orderBy("item_id").first().text
    docs = docs_of([*clean, clean[0], clean[1] + "\n", clean[2] + " end", "x " + item + " y"])
    for name, stage in cp.STAGES[1:4]:
        kept = stage(spark, docs, BIG)
        assert kept.columns == docs.columns, name
        ids = {r.doc_id for r in kept.collect()}
        assert set(range(2, 20)) <= ids
        assert {"exact_dedup": 20, "simhash_near_dedup": 20, "decontamination": 23}[name] not in ids
    assert stage(spark, docs.limit(0), BIG).count() == 0


def test_run_goes_through_all_stages(spark):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "exact_dedup", "simhash_near_dedup", "decontamination", "byte_bpe"]
    out = cp.run(spark, BIG)
    docs = table(spark, BIG, "documents")
    assert 0 < out.count() < docs.count()
    assert out.select("doc_id").distinct().count() == out.count()
    assert out.where(~F.col("round_trip") | (F.col("n_tokens") != F.size("ids"))).count() == 0
    toxic = table(spark, BIG, "labels").where("toxic = 1").select("doc_id")
    assert out.join(toxic, "doc_id").count() <= 0.2 * toxic.count()


def test_round_trip_in_one_pass_equals_encode_then_decode(spark):
    import public_tokenizers

    from trailmark.llm import bpe

    codec = bpe.shared_codec(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    rows = [(1, "Hello  world, grüße 東京\n\n12345", "x"), (2, "", "y"), (3, None, "z"), (4, "a" * 5000, None), (4, "a" * 5000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    both = bpe.round_trip(df, codec).orderBy("doc_id").collect()
    apart = bpe.decode(bpe.encode(df, codec), codec).orderBy("doc_id").collect()
    assert both == apart and bytes(both[0]["decoded"]) == rows[0][1].encode()
    assert bpe.round_trip(df.limit(0), codec).count() == 0
