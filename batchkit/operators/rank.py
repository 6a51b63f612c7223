"""Top-k rows, overall and per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_k(df: DataFrame, order: list[Column], k: int = 5) -> DataFrame:
    """The first ``k`` rows in ``order``.

    Each task keeps only its own best ``k`` rows, so k rows per task reach the last step.
    ``order`` should end in a key, or equal rows are picked arbitrarily.
    """
    return df.orderBy(*order).limit(k)


def top_per_group(df: DataFrame, group: list[str], order: list[Column], k: int = 1) -> DataFrame:
    """The first ``k`` rows of every group in ``order``.

    The rank filter is applied inside each task before the shuffle, so a group that holds
    a third of all rows sends k rows per task.
    """
    ranked = df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    )
    return ranked.filter(F.col("_rank") <= k).drop("_rank")
