"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from batchkit.operators.staging import Stage


def connected_components(edges: DataFrame, stage: Stage, name: str = "components") -> DataFrame:
    """``node`` and ``component`` (smallest node reachable) of every node in ``edges``.

    ``edges`` are two columns of comparable ids in any direction; repeated edges, loops and nulls
    are allowed and change nothing. A node that no other node is linked to is not in the result.

    Alternates two steps until each node hangs directly on the smallest of its component. The large
    step hangs the larger neighbours of every node on the node's smallest neighbour, the small step
    does so for the smaller neighbours and the node itself. Rounds grow with the logarithm of the
    longest path. Every step is written, as are the minima, so that both sides of the joins have
    known sizes and Spark can split a node with very many neighbours.
    """
    a, b = (F.col(f"`{c}`") for c in edges.columns)
    pairs = (
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter((a != b) & a.isNotNull() & b.isNotNull())
        .distinct()
    )
    links, old = stage.put(pairs, f"{name}-0"), f"{name}-0"
    turn = 0
    while not _stars(links):
        turn += 1
        both = links.union(links.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = stage.put(least.withColumn("m", F.least("u", "m")), f"{name}-{turn}-least")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage.put(large.distinct(), f"{name}-{turn}-large")
        small = stage.put(large.groupBy("u").agg(F.min("v").alias("m")), f"{name}-{turn}-small")
        moved = large.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = stage.put(moved.filter("u != v").union(small).distinct(), f"{name}-{turn}")
        parts = (f"{name}-{turn}-{part}" for part in ("least", "large", "small"))
        stage.remove(old, *parts)
        old = f"{name}-{turn}"
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _stars(links: DataFrame) -> bool:
    """Whether every node either hangs on exactly one other or has others hanging on it."""
    ends = links.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        links.select("v", F.lit(0), F.lit(1))
    )
    ends = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.filter("up > 1 OR (up = 1 AND down = 1)").isEmpty()
