"""From raw documents to packed sequences, in five stages.

Documents of low quality, toxic ones, exact copies and near copies go, in this order; what is left is
packed. Each stage works on all that the one before kept, is written and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from batchkit.llm import exact_dedup, packing, quality, simhash, toxicity
from batchkit.llm.common import load
from batchkit.operators.staging import Stage


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, load(spark, sf_dir, "labels"))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    return toxicity.drop_toxic(docs, load(spark, sf_dir, "labels"))


def no_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id."""
    return exact_dedup.drop_copies(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the one with the smallest id."""
    return simhash.drop_near(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, with their places in sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", good_quality),
    ("toxicity", not_toxic),
    ("exact_dedup", no_copies),
    ("near_dedup", no_near_copies),
    ("packing", packed),
]

# Fitted models, transitive links and tokens are beyond SQL; tests/llm/test_pipeline.py holds each
# stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written to the shared folder and read by the next."""
    stage = Stage(spark)
    docs = load(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage.put(step(spark, docs, sf_dir), name)
    return docs
