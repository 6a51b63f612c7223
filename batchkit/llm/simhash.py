"""Near duplicates by SimHash fingerprints, compared through tables of pivot distances."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from batchkit.llm import cells
from batchkit.llm.common import keep_one, narrow, text_sha
from batchkit.llm.components import connected_components
from batchkit.operators.staging import Stage

BITS = 64


def fingerprint(text: str, words: int = 4, seed: int = 42) -> int:
    """The SimHash of a text as a signed number.

    A-Z are lower-cased, words are what ASCII white space separates, and every ``words`` of them in
    a row are a shingle (all of them if there are fewer). A bit is set if it is set in over half of
    the shingles' XXH64. A text without words has fingerprint zero.
    """
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    last = max(1, len(parts) - words + 1)
    hashes = np.fromiter(
        (xxhash.xxh64_intdigest(b" ".join(parts[i : i + words]), seed) for i in range(last)),
        np.uint64,
        last,
    )
    ones = np.zeros(BITS, np.int64)
    for start in range(0, last, 1 << 14):  # a long text is unpacked piece by piece
        part = hashes[start : start + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    packed = np.packbits(ones * 2 > last, bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4
) -> DataFrame:
    """Id and ``fingerprint`` (signed 64 bits) of every document; null texts count as empty."""
    rows = narrow(docs, id_col, text_col).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t, words) for t in batch["text"].to_pylist()]
            prints = pa.array(values, pa.int64())
            yield pa.RecordBatch.from_arrays([batch["id"], prints], ["id", "fingerprint"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, fingerprint long").withColumnRenamed("id", id_col)


def block_masks(distance: int, shared: int) -> list[int]:
    """Masks such that any two prints at most ``distance`` apart agree under one of them.

    The bits are cut into ``distance + shared`` blocks. Differing bits spoil ``distance`` of them
    at most, so ``shared`` blocks are equal; there is a mask for every choice of so many blocks.
    """
    blocks = np.array_split(np.arange(BITS), distance + shared)
    masks = [sum(1 << int(b) for b in block) for block in blocks]
    return [sum(chosen) for chosen in combinations(masks, shared)]


def signed(number: int) -> int:
    return number - (1 << BITS) if number >> (BITS - 1) else number


def pivot_prints(pivots: int, seed: int = 7) -> np.ndarray:
    """Reference fingerprints, drawn at random from a fixed seed."""
    return np.random.default_rng(seed).integers(0, 1 << 63, pivots, np.uint64) << np.uint64(1)


def find_near(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    distance: int = 4,
    words: int = 4,
    shared_blocks: int = 2,
    pivots: int = 32,
    block: int = 1024,
    stage: Stage | None = None,
) -> DataFrame:
    """Id, ``fingerprint`` (16 hex digits) and ``component_id`` of every document.

    Fingerprints that differ in at most ``distance`` bits are linked; ``component_id`` is the
    smallest id reachable by links, its own included. Documents of equal fingerprint become one
    point first, so a group of copies of any size costs one row. An id that repeats with another text
    links nothing: each row has the component of its own fingerprint.

    Candidates are points that agree in ``shared_blocks`` whole blocks of bits (``block_masks``
    misses no link; more blocks mean more tables with smaller cells, for larger inputs). In a
    cell, each point has its distances to ``pivots`` reference prints. Pairs with any two of these
    further apart than ``distance`` are discarded (triangle inequality), the others are verified.
    A cell hands on at most one link per point, to the first point it is connected to.

    Null texts count as empty, and texts without words have fingerprint zero, linked like any
    other. Rows without an id are returned with the component of their fingerprint, and link like
    others; the smallest id is taken of those that have one. An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    stage = stage or Stage(spark)
    prints = stage.put(
        fingerprints(docs, id_col, text_col, words).withColumnRenamed(id_col, "_id"), "prints"
    )
    points = stage.put(
        prints.groupBy("fingerprint").agg(F.min("_id").alias("node")), "points"
    )
    tables = F.array(
        *[
            F.struct(
                F.lit(i).alias("_table"),
                F.col("fingerprint").bitwiseAND(F.lit(signed(mask))).alias("_key"),
            )
            for i, mask in enumerate(block_masks(distance, shared_blocks))
        ]
    )
    cell = ["_table", "_key"]
    rows = points.select("fingerprint", F.inline(tables))
    dealt = cells.meetings(rows, cell, "fingerprint", stage, block)
    reference = pivot_prints(pivots)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, after in cells.whole_groups(batches, [*cell, *cells.GROUP]):
            nodes = table["fingerprint"].to_numpy()
            points = nodes.view(np.uint64)
            forest = cells.Forest(len(points))
            busy = after > 0
            busy[1:] |= busy[:-1].copy()
            far = np.zeros((len(points), len(reference)), np.int8)
            far[busy] = np.bitwise_count(points[busy, None] ^ reference)
            for a, b in cells.pairs(after, table):
                for part in np.array_split(np.arange(len(reference)), 4):
                    near = (np.abs(far[a][:, part] - far[b][:, part]) <= distance).all(axis=1)
                    a, b = a[near], b[near]
                near = np.bitwise_count(points[a] ^ points[b]) <= distance
                forest.link(a[near], b[near])
            hung = np.flatnonzero(forest.root != np.arange(len(points)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[hung]), pa.array(nodes[forest.root[hung]])], ["a", "b"]
            )

    edges = dealt.mapInArrow(link, "a long, b long")
    linked = connected_components(edges, stage).withColumnRenamed("node", "fingerprint")
    least = linked.join(points, "fingerprint").groupBy("component").agg(F.min("node").alias("least"))
    linked = linked.join(stage.put(least, "least"), "component").select("fingerprint", "component", "least")
    reached = points.join(linked, "fingerprint", "left").select(
        "fingerprint",
        F.when(F.col("component").isNull(), F.col("node")).otherwise(F.col("least")).alias("component_id"),
    )
    # written, so that its size is known: joined by broadcast, or with the prints of a hot one split
    reached = stage.put(reached, "reached")
    return prints.join(reached, "fingerprint").select(
        F.col("_id").alias(id_col),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One whole row of each group of near copies, with all its columns.

    It has the smallest id of the group, or none if no row of the group has one; then the first text
    by digest. Documents are told apart by id and text, so rows that share an id and differ in the text
    stay or go by their own groups. Of rows that repeat both any one stays.
    """
    stage = options.pop("stage", None) or Stage(docs.sparkSession)
    sha = text_sha(docs[text_col])
    name = F.struct(docs[id_col].isNull().alias("none"), docs[id_col].alias("id"), sha.alias("sha"))
    named = docs.select(name.alias("name"), docs[text_col].alias("text"))
    settled = (
        find_near(named, "name", "text", stage=stage, **options)
        .groupBy("name", "component_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("name.id", "name.sha", (F.col("name") != F.col("component_id")).alias("lost"), "n")
        .filter("lost OR n > 1")
    )
    return keep_one(docs, id_col, sha, stage.put(settled, "settled"))
