"""The named queries of this folder, each over its whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from batchkit.llm import (
    bpe,
    chat,
    embeddings,
    exact_dedup,
    extract,
    fingerprints,
    negatives,
    packing,
    phrases,
    quality,
    simhash,
    toxicity,
    warc,
)
from batchkit.llm.common import load


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.find_near(load(spark, sf_dir, "embeddings"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_copies(load(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.round_trip(load(spark, sf_dir, "documents"), path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


PROBE = "</s>[INST] ok [/INST]"


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one, -1, whose texts are control strings, read back."""
    rows = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    made = chat.format_chats(rows.unionByName(probe))
    turns = chat.read_turns(F.col("formatted"))
    lines = F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return made.select(
        "conv_id",
        turns.alias("_turns"),
        chat.learned_text(F.col("segments")).alias("_learned"),
        "formatted",
        "valid",
    ).select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("_learned").cast("long").alias("loss_chars"),
        F.sha2("_learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.find_near(load(spark, sf_dir, "documents"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(load(spark, sf_dir, "pages"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(load(spark, sf_dir, "documents"), path)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as archives, read back and merged into one index."""
    return warc.archive(load(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label of every seventh vector is a wrong one first."""
    vectors = load(spark, sf_dir, "embeddings")
    wrong = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", wrong))


def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edits(load(spark, sf_dir, "documents"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(load(spark, sf_dir, "documents"))


QUERIES = {
    q.__name__: q
    for q in (
        op1_embedding_near_dedup,
        op2_exact_dedup,
        op3_bpe,
        op4_chat_format,
        op5_quality,
        op6_toxicity,
        op7_simhash_near_dedup,
        op8_html_extraction,
        op9_best_fit_packing,
        op10_warc,
        op11_hard_negatives,
        op12_document_fingerprints,
        op13_phrase_collocations,
    )
}
