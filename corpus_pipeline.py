"""The corpus pipeline: documents in, token ids out, one operator of ``trailmark.llm`` a stage.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns what it keeps. ``run``
writes each stage as Parquet and reads it again for the next, so a lost executor costs at most one stage.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.llm import bpe, decontaminate, exact_dedup, simhash, toxicity
from trailmark.llm.common import table
from trailmark.plans.lineage import ensure_checkpoint_dir

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, does not call toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model, threshold=0.5)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal without white characters."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.keep_one_each(docs, shingle=3, max_bits=2)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids, round_trip): the ids of each text, and whether they decode to it."""
    codec = bpe.shared_codec(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    coded = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), codec)
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return coded.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip")
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("byte_bpe", to_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the stages' tables go below the checkpoint folder."""
    ensure_checkpoint_dir(spark)
    base = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs


#: Fitted scores, fingerprints and token ids have no SQL form: the stages are tested against brute force.
ORACLE_SQL = None
