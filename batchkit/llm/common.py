"""What several operators of this folder share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def narrow(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, null texts as empty ones.

    All other columns end here, so their names cannot clash with those an operator adds.
    """
    return df.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias(text_col))


def crc_mod(id_col: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % divisor


def text_sha(text: Column) -> Column:
    """SHA-256 in hex digits; a null text counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def keep_one(docs: DataFrame, id_col: str, sha: Column, settled: DataFrame) -> DataFrame:
    """``docs`` without the ``id`` and ``sha`` that ``settled`` calls ``lost``, one row of each other in it.

    ``settled`` is a written table without repeats; null ids are equal. What it does not name stays.
    """
    key = "_sha"
    while key in {c.lower() for c in docs.columns}:
        key += "_"
    rows = docs.withColumn(key, sha)

    def same(some: DataFrame) -> Column:
        return rows[id_col].eqNullSafe(some["id"]) & (rows[key] == some["sha"])

    left = rows.join(settled, same(settled), "left_anti")
    repeated = settled.filter("NOT lost")
    if not repeated.isEmpty():
        some = rows.join(repeated, same(repeated), "left_semi")
        left = left.unionByName(some.dropDuplicates([id_col, key]))
    return left.drop(key)


def slices(
    batches: Iterator[pa.RecordBatch], column: str, size: int = 1 << 20
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of ``column``, one row at least."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch[column]).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop
