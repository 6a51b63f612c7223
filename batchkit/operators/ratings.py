"""Normalising the ratings of each user, and the mean normalised rating of a product."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from batchkit.operators.staging import Stage


def zscore(df: DataFrame, group: str, value: str, eps: float = 1e-8) -> DataFrame:
    """Add ``zscore``: distance of the row from the mean of its group in sample deviations.

    It is 0 for a group of one row and where the deviation is at most ``eps``. Rows without
    a group are left out. Mean and deviation come from an aggregate that is joined back
    rather than from a window: a window would sort all rows of a user in one task. The aggregate
    is written, by a job that runs at once, so that Spark knows its size for the join and can
    split the rows of a user who holds very many.
    """
    stats = df.groupBy(group).agg(
        F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_std")
    )
    stats = Stage(df.sparkSession).put(stats, "stats")
    joined = df.join(stats, group)
    score = F.when(F.col("_std") > eps, (F.col(value) - F.col("_mean")) / F.col("_std"))
    return joined.withColumn("zscore", score.otherwise(F.lit(0.0))).drop("_mean", "_std")


def mean_normalised(
    df: DataFrame, group: str, item: str, value: str, eps: float = 1e-8
) -> DataFrame:
    """Mean z-score per item, where scores are normalised within ``group``."""
    scored = zscore(df.select(group, item, value), group, value, eps)
    return scored.groupBy(item).agg(F.avg("zscore").alias("mean_zscore"))
