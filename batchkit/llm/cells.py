"""Comparing all rows that share a cell, with large cells cut into blocks.

A cell is what a hash table calls a bucket. ``meetings`` deals the rows out so that every two rows
of a cell meet in exactly one group and no group is larger than about two blocks, whatever the size
of the cell. ``whole_groups`` and ``pairs`` then walk through a partition in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from batchkit.operators.staging import Stage

GROUP = ["_i", "_j"]


def meetings(
    rows: DataFrame, cell: list[str], id_col: str, stage: Stage, block: int = 1024
) -> DataFrame:
    """Rows with the group they take part in, partitioned and sorted by it.

    A cell with n rows is cut into k = ceil(n / block) chunks by a hash of the id. Group (i, j) of
    a cell holds the chunks i and j, so a row is copied k times; k is 1 for all but hot cells. The
    sizes of hot cells are counted (combined before the shuffle) and written; Spark splits the join
    with them where a cell is skewed. Adds ``_i``, ``_j`` and ``_chunk``.
    """
    sizes = rows.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > block)
    sizes = stage.put(sizes, "hot-cells")
    return gather(deal(rows.join(sizes, cell, "left"), id_col, block), cell, id_col)


def deal(sized: DataFrame, id_col: str, block: int) -> DataFrame:
    """A copy of each row for every group it takes part in; ``_n`` is the size of its cell, if hot."""
    chunks = F.coalesce(F.ceil(F.col("_n") / block), F.lit(1)).cast("int")
    return (
        sized.withColumn("_k", chunks)
        .withColumn("_chunk", F.pmod(F.xxhash64(id_col, F.lit(block)), F.col("_k")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
        .withColumn("_i", F.least("_chunk", "_other"))
        .withColumn("_j", F.greatest("_chunk", "_other"))
        .drop("_n", "_k", "_other")
    )


def gather(dealt: DataFrame, cell: list[str], id_col: str) -> DataFrame:
    """The rows of each group in one partition, one behind the other."""
    keys = [*cell, *GROUP]
    return dealt.repartition(*[F.col(c) for c in keys]).sortWithinPartitions(*keys, id_col)


def whole_groups(
    batches: Iterable[pa.RecordBatch], keys: list[str]
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables made of whole groups, with the number of rows after each row in its group."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        starts = _starts(table, keys)
        if len(starts) > 1:
            yield table.slice(0, starts[-1]), _after(starts[:-1], starts[-1])
        rest = table.slice(starts[-1]) if len(starts) else table
    if rest is not None and rest.num_rows:
        starts = _starts(rest, keys)
        yield rest, _after(starts, rest.num_rows)


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    if not table.num_rows:
        return np.empty(0, np.int64)
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for key in keys:
        values = table[key].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _after(starts: np.ndarray, end: int) -> np.ndarray:
    ends = np.append(starts[1:], end)
    return np.repeat(ends, ends - starts) - np.arange(end) - 1


def pairs(after: np.ndarray, table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of rows that have to be compared, each once, as arrays of bounded length.

    Rows of one chunk meet in their own group (i = j); elsewhere only rows of different chunks do.
    """
    chunk = table["_chunk"].to_numpy()
    cross = table["_i"].to_numpy() != table["_j"].to_numpy()
    left = np.flatnonzero(after > 0)
    step = 1
    while len(left):
        right = left + step
        meet = ~cross[left] | (chunk[left] != chunk[right])
        yield left[meet], right[meet]
        step += 1
        left = left[after[left] >= step]


class Forest:
    """Which rows of a table are linked; ``root`` is the first row of each linked set."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.root[a], self.root[b]
            apart = a != b
            a, b = a[apart], b[apart]
            if not len(a):
                return
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while True:
                further = self.root[self.root]
                if np.array_equal(further, self.root):
                    break
                self.root = further
