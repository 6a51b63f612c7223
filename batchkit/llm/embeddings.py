"""Near duplicates among embeddings by random hyperplanes and exact cosines."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from batchkit.llm import cells
from batchkit.llm.components import connected_components
from batchkit.operators.staging import Stage


def hyperplanes(dim: int, tables: int, bits: int, seed: int = 11) -> np.ndarray:
    """The normals of all tables' planes, (dim, tables * bits), the same wherever it is called."""
    return np.random.default_rng([seed, dim]).standard_normal((dim, tables * bits))


def signatures(unit: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """For each vector and table, the sides of ``bits`` planes it lies on, as one number."""
    sides = unit @ hyperplanes(unit.shape[1], tables, bits) > 0
    return sides.reshape(len(unit), tables, bits) @ (1 << np.arange(bits, dtype=np.int64))


def tables_for(bits: int, threshold: float, recall: float) -> int:
    """How many tables of ``bits`` planes find a pair with a cosine of ``threshold`` with probability ``recall``."""
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return math.ceil(math.log(1 - recall) / math.log(1 - same))


def first_meetings(
    a: np.ndarray, b: np.ndarray, keys: np.ndarray, number: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The pairs whose keys agree in no table before the one they meet in, which is ``number`` of their rows.

    Near copies agree in most tables, so nearly all of their pairs go after the first few.
    """
    start, tables = 0, keys.shape[1]
    while start < tables and len(a):
        end = min(tables, 2 * start + 1)
        earlier = np.arange(start, end) < number[a][:, None]
        new = ~(earlier & (keys[a, start:end] == keys[b, start:end])).any(axis=1)
        a, b, start = a[new], b[new], end
    return a, b


def is_usable(vector: Column) -> Column:
    """Whether a vector has a direction: finite components, not all of them zero."""
    finite = F.forall(vector, lambda x: F.abs(x) < float("inf"))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def find_near(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str | None = "label",
    threshold: float = 0.93,
    bits: int = 16,
    recall: float = 0.997,
    block: int = 1024,
    stage: Stage | None = None,
) -> DataFrame:
    """Id, ``n_links``, ``component_id`` and ``kept`` of every vector.

    Two vectors of equal, non-null label (any, without ``label_col``) and equal length are linked if
    they agree on all planes of at least one table and their cosine, in double precision, is at
    least ``threshold``. A pair at angle a is found with probability
    1 - (1 - (1 - a/pi)**bits)**tables, and there are as many tables as ``recall`` needs at the
    threshold itself; nearer pairs are found more often. A pair that meets in several tables is
    compared in the first one only. ``component_id`` is the smallest id reachable, its own included; ``kept`` says
    that it is the vector's own.

    Equal vectors of a label are one point with a weight, whose links count for each of them, so a
    group of copies costs no comparisons. A table has 2**bits cells for each label: with ``bits``
    near the logarithm of the rows of a label, up to 30, few unlike points share a cell. Only ids are
    dealt to the cells, and vectors follow to cells of two points or more.

    A vector that is null, empty, zero or holds a null or non-finite component links with nothing.
    Rows that repeat an id are one vector, the largest by label and components. Rows without an id
    are one row that links with nothing and is not kept. An empty table gives no rows; other columns
    are not read, so their names cannot clash. Cells of any size are cut into blocks (see ``cells``).
    """
    spark = vectors.sparkSession
    stage = stage or Stage(spark)
    tables = tables_for(bits, threshold, recall)
    label = F.col(label_col) if label_col else F.lit(0)
    rows = stage.put(
        vectors.select(
            F.col(id_col).alias("id"),
            F.struct(label.alias("label"), F.col(vector_col).alias("vector")).alias("_row"),
        )
        .groupBy("id")
        .agg(F.max("_row").alias("_row"))
        .select("id", "_row.label", "_row.vector"),
        "vectors",
    )
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("id", "label", "vector")}
    usable = rows.filter("id IS NOT NULL AND label IS NOT NULL").filter(is_usable(F.col("vector")))
    points = usable.groupBy("label", "vector").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("weight")
    )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch["vector"]
            flat, starts = column.flatten(), column.offsets.to_numpy()
            flat = flat.to_numpy(zero_copy_only=False).astype(np.float64)
            starts = starts - starts[0]
            lengths = np.diff(starts)
            for dim in np.unique(lengths):
                at = np.flatnonzero(lengths == dim)
                exact = flat[starts[at][:, None] + np.arange(dim)]
                exact /= np.abs(exact).max(axis=1, keepdims=True)
                exact /= np.sqrt((exact * exact).sum(axis=1, keepdims=True))
                keys = pa.array(signatures(exact, tables, bits).astype(np.int32).ravel())
                keys = pa.FixedSizeListArray.from_arrays(keys, tables).cast(pa.list_(pa.int32()))
                some = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array(np.full(len(at), dim, np.int32)), keys],
                    [*some.schema.names, "dim", "keys"],
                )

    signed = stage.put(
        points.mapInArrow(
            sign,
            f"label {kinds['label']}, vector {kinds['vector']}, id {kinds['id']}, weight long, "
            "dim int, keys array<int>",
        ),
        "signed",
    )
    cell = ["label", "dim", "_table", "_key"]
    met = signed.select("id", "label", "dim", F.posexplode("keys").alias("_table", "_key"))
    sizes = met.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    dealt = cells.deal(met.join(stage.put(sizes, "cells"), cell), "id", block)
    dealt = cells.gather(dealt.join(signed.select("id", "vector", "weight", "keys"), "id"), cell, "id")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, after in cells.whole_groups(batches, [*cell, *cells.GROUP]):
            busy = after > 0
            busy[1:] |= busy[:-1].copy()
            at = np.flatnonzero(busy)
            if not len(at):
                continue
            # the rows of one table may have vectors of several lengths
            vector = table["vector"].combine_chunks()
            flat, starts = vector.flatten().to_numpy().astype(np.float64), vector.offsets.to_numpy()
            starts = starts - starts[0]
            unit = np.zeros((table.num_rows, np.diff(starts).max()))
            for i in at:
                unit[i, : starts[i + 1] - starts[i]] = flat[starts[i] : starts[i + 1]]
            unit[at] /= np.abs(unit[at]).max(axis=1, keepdims=True)
            unit[at] /= np.sqrt((unit[at] * unit[at]).sum(axis=1, keepdims=True))
            keys = table["keys"].combine_chunks().flatten().to_numpy().reshape(-1, tables)
            number, weight = table["_table"].to_numpy(), table["weight"].to_numpy()
            forest = cells.Forest(table.num_rows)
            links = np.zeros(table.num_rows, np.int64)
            for a, b in cells.pairs(after, table):
                for part in np.array_split(np.arange(len(a)), len(a) // 100_000 + 1):
                    x, y = first_meetings(a[part], b[part], keys, number)
                    near = np.einsum("ij,ij->i", unit[x], unit[y]) >= threshold
                    x, y = x[near], y[near]
                    forest.link(x, y)
                    np.add.at(links, x, weight[y])
                    np.add.at(links, y, weight[x])
            hung = np.flatnonzero((links > 0) | (forest.root != np.arange(len(links))))
            ids = table["id"].combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(hung)),
                    ids.take(pa.array(forest.root[hung])),
                    pa.array(links[hung]),
                ],
                ["id", "root", "n"],
            )

    found = stage.put(
        dealt.mapInArrow(link, f"id {kinds['id']}, root {kinds['id']}, n long"), "links"
    )
    linked = connected_components(found.select("id", "root"), stage)
    counted = found.groupBy("id").agg(F.sum("n").alias("n"))
    # what has links or twins, one row for each point, so that only the other side of the last join is skewed
    settled = stage.put(
        signed.select("id", "label", "vector", "weight")
        .join(counted, "id", "left")
        .join(linked, F.col("id") == F.col("node"), "left")
        .filter("weight > 1 OR n IS NOT NULL")
        .select(
            "label",
            "vector",
            (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n"),
            F.coalesce("component", "id").alias("component"),
        ),
        "settled",
    )
    known = F.col("id").isNotNull()
    return (
        rows.join(settled, ["label", "vector"], "left")
        .select(
            F.col("id").alias(id_col),
            F.when(known, F.coalesce("n", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
            F.when(known, F.coalesce("component", "id")).alias("component_id"),
        )
        .withColumn(
            "kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False))
        )
    )
