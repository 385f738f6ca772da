"""The registered queries of this subpackage: each applies one operator to its whole table.

``QUERIES`` maps names to callables (spark, sf_dir); ``ORACLES`` has SQL for those that SQL can express.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.llm import (
    alignment, bpe, conversations, decontaminate, exact_dedup, fixity, licenses, paragraphs, quality, quality_rules, sharding, simhash, toxicity,
)
from trailmark.llm.common import held_out, table
from trailmark.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]

SHARDS = 24
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op1_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every repeated paragraph and passage of the documents with its class's first document."""
    found = paragraphs.repeated_spans(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "kind", F.col("start").alias("start_word"), F.col("words").alias("n_words"),
        F.col("source").alias("source_doc_id"), "removed",
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every document."""
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.array_join("licenses", ";").alias("licenses"),
        F.array_join("sentences", ";").alias("sentences"), F.size("unmatched").alias("n_unmatched"), "status",
    )


def op3_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 23 by jump consistent hashing of doc_id."""
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return sharding.assign_shards(rows, "doc_id", SHARDS, ["size", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), "grown_shard"
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of 3-word shingles and their components at 2 or fewer differing bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select(F.col("id").alias("doc_id"), simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def _replica(pages: DataFrame) -> DataFrame:
    """The pages as a replica holds them whose storage has overwritten the first character of some bodies."""
    damaged = F.crc32(F.coalesce("url", F.lit(""))) % 97 == 0
    return pages.withColumn("html", F.when(damaged, F.concat(F.lit("\x01"), F.substr("html", F.lit(2)))).otherwise(F.col("html")))


def op5_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The damaged records of a replica of all pages, found by descending the trees from their roots."""
    pages = table(spark, sf_dir, "pages")
    found = fixity.audit(fixity.warc_records(pages), fixity.warc_records(_replica(pages)))
    return found.select(
        "page_id", F.col("file").alias("file_no"), F.col("place").cast("long").alias("record_no"), F.col("start").alias("offset_start"),
        F.col("stop").alias("offset_stop"), "fault", F.col("digest").alias("sha256"), F.col("other_digest").alias("replica_sha256"),
    )


def op6_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item that it contains, also with other numbers, names and units."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "matched_tokens", F.col("item_tokens").cast("long").alias("item_tokens"), "coverage", "reworded"
    )


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays of its group of equal texts."""
    docs = table(spark, sf_dir, "documents")
    found = exact_dedup.exact_duplicates(docs)
    settled = found.where("full_hash is not null").select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("full_hash").alias("text_sha256"), "level"
    )
    # The digest column wants the hash of texts too that the operator never had to read in full.
    alone = found.where("full_hash is null").select("id", "keep_id", "group_size", "kept", "level", "chars", "length", "prefix_hash")
    hashed = exact_dedup.with_sketch(docs).select("id", "chars", "length", "prefix_hash", exact_dedup.text_hash(F.col("text")).alias("text_sha256"))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"h.{c}")) for c in ("id", "chars", "length", "prefix_hash")]
    rest = alone.alias("a").join(hashed.alias("h"), same).select(
        F.col("a.id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256", "level"
    )
    return settled.unionByName(rest).drop("level")


def op8_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document by a conditional random field over its lines."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return _predicted(docs, quality.score(F.col("text"), model), 0.3)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded to token ids and decoded again."""
    codec = bpe.shared_codec(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, memo=400_000)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, codec).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), bpe.ids_digest(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document by the counterfactually regularised classifier."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return _predicted(docs, toxicity.score(F.col("text"), model), 0.5)


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's counts, the rules of the default table that it fails, and the verdict."""
    judged = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_lines",
        F.array_join("failed_rules", ";").alias("failed_rules"), "base_failed", "kept",
    )


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repair of every conversation after known damage: faults, cheapest edits, the hash of the repaired text."""
    turns = table(spark, sf_dir, "conversations")
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    return conversations.report(conversations.damaged(turns, F.crc32(name) % 20), every=turns).withColumnRenamed("conversation", "conv_id")


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How a byte-level and a piece tokenizer cut every document, and how common its token pairs are in all of them."""
    shared = alignment.shared_aligner(spark, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return alignment.alignment(table(spark, sf_dir, "documents"), shared).withColumnRenamed("id", "doc_id")


def _predicted(docs: DataFrame, score, threshold: float) -> DataFrame:
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_paragraph_dedup, op2_license_scan, op3_jump_sharding, op4_simhash, op5_merkle_fixity, op6_template_decontamination,
        op7_exact_dedup, op8_crf_quality, op9_byte_bpe, op10_counterfactual_toxicity,
        op11_quality_rules, op12_conversation_repair, op13_tokenizer_alignment,
    )
}
