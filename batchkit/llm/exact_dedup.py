"""Exact duplicates by local, salted and global combining. DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from batchkit.llm.common import keep_one, text_sha
from batchkit.operators.staging import Stage


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def find_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise=lambda text: text,
    digest=sha256,
    salts: int | None = None,
    stage: Stage | None = None,
) -> DataFrame:
    """One row per document: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal if they are identical after ``normalise`` (default: no change). Of equal texts
    the row with the largest id stays. A text is compared in full at each of three stages:

    1. rows of one scan task with the same digest and text become one (partial aggregate),
    2. those of the same salt meet and become one; the salt is the scan task's number modulo
       ``salts``, so that a text with a third of all rows is spread over as many reducers and each
       gets one row per task,
    3. the winners of all salts meet; the largest id wins, the sizes add up.

    ``salts`` is the root of the number of shuffle partitions unless given, which makes stages 2
    and 3 equally wide for a hot text. Only groups of two or more are written and joined back, a
    join of narrow rows that Spark splits where a digest is hot. Should different texts share
    a digest, their groups are kept apart and joined by the text itself.

    Null texts count as empty. A null id loses to any other; a group in which all ids are null
    keeps no row and has a null ``keep_id``. Rows repeated with the same id all count in
    ``group_size`` and all are ``kept`` if their id is the largest. An empty table gives no rows.
    Other columns are not read.
    """
    spark = docs.sparkSession
    stage = stage or Stage(spark)
    if salts is None:
        salts = max(2, math.isqrt(int(spark.conf.get("spark.sql.shuffle.partitions"))))
    text = F.coalesce(normalise(F.col(text_col)), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text")).withColumns(
        {"_digest": digest(F.col("_text")), "_sha": sha256(F.col("_text"))}
    )
    salted = (
        rows.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        .groupBy("_digest", "_salt", "_text")
        .agg(F.max("_id").alias("_keep"), F.count(F.lit(1)).alias("_n"))
    )
    groups = (
        salted.repartition(F.col("_digest"))
        .groupBy("_digest", "_text")
        .agg(F.max("_keep").alias("_keep"), F.sum("_n").alias("_n"))
    )
    texts = groups.groupBy("_digest").agg(
        F.count(F.lit(1)).alias("_texts"),
        F.max("_keep").alias("_keep"),
        F.max("_n").alias("_n"),
    )
    copies = stage.put(texts.filter("_n > 1 OR _texts > 1"), "copies")
    lone = copies.filter("_texts = 1").drop("_texts")
    mixed = copies.filter("_texts > 1").select("_digest")
    if mixed.isEmpty():
        found = rows.drop("_text").join(lone, "_digest", "left")
    else:
        classes = stage.put(groups.join(mixed, "_digest", "left_semi"), "mixed")
        apart = rows.join(mixed, "_digest", "left_semi").join(classes, ["_digest", "_text"])
        found = (
            rows.join(mixed, "_digest", "left_anti")
            .drop("_text")
            .join(lone, "_digest", "left")
            .unionByName(apart.drop("_text"))
        )
    keep = F.when(F.col("_n").isNull(), F.col("_id")).otherwise(F.col("_keep"))
    return found.select(
        F.col("_id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("_n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("_id") == keep, F.lit(False)).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def drop_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """One whole row of each group of ``find_copies``, with all its columns.

    It has the largest id of the group, or none if no row of the group has one. Of rows that repeat
    this id any one stays.
    """
    stage = options.pop("stage", None) or Stage(docs.sparkSession)
    found = find_copies(docs, id_col, text_col, stage=stage, **options)
    lost = ~F.col("kept") & F.col("keep_id").isNotNull()
    settled = (
        found.filter("group_size > 1")
        .groupBy(F.col(id_col).alias("id"), F.col("text_sha256").alias("sha"))
        .agg(F.max(lost).alias("lost"), F.count(F.lit(1)).alias("n"))
        .filter("lost OR n > 1")
    )
    normalise = options.get("normalise", lambda text: text)
    return keep_one(docs, id_col, text_sha(normalise(docs[text_col])), stage.put(settled, "settled"))
