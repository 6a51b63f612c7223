"""Bounded samples of labelled documents to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from batchkit.llm.common import crc_mod, text_sha
from batchkit.operators.staging import Stage


def first_places(known: DataFrame, rows: int, count: int, spare: float = 4.0) -> DataFrame:
    """The ``rows`` rows of smallest ``place`` and id, of ``count`` rows with places spread over all longs.

    Only places below a bound under which ``spare`` times that many are expected are sorted, so that the
    task which makes the choice reads a few times ``rows`` whatever the number of rows and tasks. If too
    few are below the bound it is doubled; the rows chosen do not depend on it.
    """
    below, share = known, spare * rows / max(count, 1)
    while share < 1:
        few = known.filter(F.col("place") < int((share - 0.5) * 2**64))
        if few.count() >= rows:
            below = few
            break
        share *= 2
    return below.orderBy("place", "_id").limit(rows)


def sample(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str,
    divisor: int,
    held_out: int,
    rows_per_class: int,
    stage: Stage,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, dict[int, int]]:
    """``text``, ``label`` and a random but fixed ``place`` of a sample, and all training rows by label.

    Only ids whose crc32 modulo ``divisor`` is not ``held_out`` are used, at most ``rows_per_class``
    for each of the labels 0 and 1. An id that is labelled more than once has its largest label; null
    ids and labels are left out. The sample is small enough to be broadcast: two numbers a row. Of an
    id that repeats with several texts the one of the smallest digest is taken, found in each task
    before the shuffle, so that the sample has one row for each chosen id. Texts are whole, however long;
    an empty table or one label alone gives what there is.
    """
    known = (
        labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label"))
        .filter("_id IS NOT NULL AND label IN (0, 1)")
        .filter(crc_mod("_id", divisor) != held_out)
        .groupBy("_id")
        .agg(F.max("label").alias("label"))
    )
    present = docs.select(F.col(id_col).alias("_id")).filter("_id IS NOT NULL").distinct()
    known = stage.put(
        known.join(present, "_id", "left_semi").withColumn("place", F.xxhash64("_id")),
        f"known-{label_col}",
    )
    counts = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    chosen = None
    for label in (0, 1):
        part = first_places(known.filter(F.col("label") == label), rows_per_class, counts.get(label, 0))
        chosen = part if chosen is None else chosen.union(part)
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    found = texts.join(F.broadcast(stage.put(chosen, f"chosen-{label_col}")), "_id")
    once = found.groupBy("_id", "label", "place").agg(F.min_by("text", text_sha(F.col("text"))).alias("text"))
    return once.select("text", "label", "place"), counts
