"""Expressions over arrays that are known to be short."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def pairs(products: Column) -> Column:
    """All pairs of entries at positions i < j, as an array of ``(first, second)``.

    The array of a row grows with the square of its input; for baskets of any size use
    ``operators.basket.pair_counts``.
    """

    def with_later(entry: Column, position: Column) -> Column:
        later = F.slice(products, position + 2, F.size(products))
        return F.transform(later, lambda other: F.struct(entry.alias("first"), other.alias("second")))

    return F.flatten(F.transform(products, with_later))
