"""Hard negatives by exact inner-product search with length buckets and coordinate pruning."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from batchkit.operators.staging import Stage

SLACK = 1e-9  # bounds in floating point are widened by this, so that rounding prunes nothing
EXACT = 1 << 53  # whole numbers below this are exact in double precision


def whole_vectors(
    vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int
) -> DataFrame:
    """``id``, ``label``, ``dim`` and ``vector`` (floor(scale * x) of every component) of the rows that take part."""
    vector = F.col(vector_col)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.struct(F.col(label_col).alias("label"), vector.alias("vector")).alias("_row"),
    ).filter(
        F.col("id").isNotNull()
        & F.col("_row.label").isNotNull()
        & F.col("_row.vector").isNotNull()
        & F.forall(
            "_row.vector",
            lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")),
        )
    )
    once = rows.groupBy("id").agg(F.max("_row").alias("_row"))
    return once.select(
        "id",
        "_row.label",
        F.size("_row.vector").alias("dim"),
        F.transform("_row.vector", lambda x: F.floor(x.cast("double") * scale)).alias("vector"),
    )


class Bucket:
    """Rows of similar length, with the rows in the order of each coordinate."""

    def __init__(self, at: np.ndarray, unit: np.ndarray, lengths: np.ndarray):
        self.at = at
        self.unit = unit[at]
        self.longest = float(lengths[at].max())
        self.order = np.argsort(self.unit, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(self.unit.T, self.order, axis=1)

    def may_reach(self, q: np.ndarray, focus: np.ndarray, cosine: float) -> np.ndarray:
        """Rows whose cosine with the unit vector ``q`` may be ``cosine`` or more, by some coordinates.

        Where a row's cosine is x, its coordinate p lies within sqrt((1 - x*x) * (1 - q*q)) of q * x. Over
        all x from ``cosine`` to 1 the furthest p are at an angle of acos(cosine) before and behind the
        angle of q. The sorted list of each coordinate in ``focus`` gives the rows in this range; the
        shortest of them is intersected with the others.
        """
        turn = math.acos(min(1.0, cosine))
        angle = np.arccos(np.clip(q[focus], -1.0, 1.0))
        high = np.cos(np.maximum(angle - turn, 0.0)) + SLACK
        low = np.cos(np.minimum(angle + turn, np.pi)) - SLACK
        first = [self.sorted[f].searchsorted(x, "left") for f, x in zip(focus, low, strict=True)]
        last = [self.sorted[f].searchsorted(x, "right") for f, x in zip(focus, high, strict=True)]
        by_size = np.argsort(np.subtract(last, first))
        best = by_size[0]
        rows = self.order[focus[best]][first[best] : last[best]]
        for k in by_size[1:]:
            if not len(rows):
                break
            column = self.unit[rows, focus[k]]
            rows = rows[(column >= low[k]) & (column <= high[k])]
        return rows


class Wanted:
    """The best ``k`` (score, then smaller id) of the rows offered with ``low`` <= score <= ``high``."""

    def __init__(self, k: int, low: float = -math.inf, high: float = math.inf):
        self.k, self.low, self.high = k, low, high
        self.scores = np.empty(0, np.int64)
        self.ids = np.empty(0, np.int64)

    @property
    def least(self) -> float:
        """What a row has to score to be among them, or to tie with the last."""
        return int(self.scores[-1]) if len(self.scores) == self.k else self.low

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = (scores >= self.least) & (scores <= self.high)
        if good.any():
            scores = np.concatenate([self.scores, scores[good]])
            ids = np.concatenate([self.ids, ids[good]])
            best = np.lexsort((ids, -scores))[: self.k]
            self.scores, self.ids = scores[best], ids[best]


class Rows:
    """Rows of one length of vectors in length buckets, the longest first."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, bucket: int):
        self.ids, self.labels = ids, labels
        self.largest = int(np.abs(vectors).max(initial=0))
        self.vectors = vectors
        lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        unit = vectors / np.where(lengths > 0, lengths, 1)[:, None]
        order = np.lexsort((ids, -lengths))
        self.buckets = [
            Bucket(order[i : i + bucket], unit, lengths) for i in range(0, len(ids), bucket)
        ]
        self.exact = vectors.astype(np.float64)

    def scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Whole inner products, exact."""
        bound = self.largest * int(np.abs(anchor).max(initial=0)) * len(anchor)
        if bound < EXACT:
            return (self.exact[rows] @ anchor.astype(np.float64)).astype(np.int64)
        exact = self.vectors[rows].astype(object) @ anchor.astype(object)
        return np.array(exact, np.int64)

    def search(
        self,
        anchor: np.ndarray,
        wanted: list[Wanted],
        allowed: np.ndarray,
        focus: int,
    ) -> None:
        """Offers all rows that may be among the ``wanted`` ones, bucket by bucket.

        ``wanted`` raise the score they need as they fill. A bucket whose longest row cannot reach the
        least of these scores ends the search, as all later ones are shorter.
        """
        length = math.sqrt(float((anchor.astype(np.float64) ** 2).sum()))
        q = anchor / length if length else anchor.astype(np.float64)
        chosen = np.argsort(-np.abs(q), kind="stable")[:focus]
        for bucket in self.buckets:
            least = min(w.least for w in wanted)
            if least > 0:
                cosine = least / (length * bucket.longest) if length and bucket.longest else 2.0
                if cosine > 1 + SLACK:
                    return
                rows = bucket.at[bucket.may_reach(q, chosen, cosine - SLACK)]
            else:
                rows = bucket.at
            rows = rows[allowed[rows]]
            if len(rows):
                scores = self.scores(rows, anchor)
                for w in wanted:
                    w.offer(scores, self.ids[rows])


def _grid(
    rows: DataFrame,
    anchors: DataFrame,
    group: list[str],
    rows_per_cell: int,
    anchors_per_cell: int,
    stage: Stage,
    name: str,
) -> DataFrame:
    """Rows and anchors of a group dealt to cells so that each row meets each anchor in one cell.

    The rows of a group are cut into chunks and its anchors into blocks by hashes, their numbers from
    counts; a cell is one chunk with one block. ``role`` is 0 for rows, 1 for anchors.
    """
    sizes = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows"))
    asked = anchors.groupBy(*group).agg(F.count(F.lit(1)).alias("_asked"))
    cut = sizes.join(asked, group).select(
        *group,
        F.ceil(F.col("_rows") / rows_per_cell).cast("int").alias("_chunks"),
        F.ceil(F.col("_asked") / anchors_per_cell).cast("int").alias("_blocks"),
    )
    cut = stage.put(cut, f"grid-{name}")
    sides = []
    for role, side, own, other in ((0, rows, "_chunks", "_blocks"), (1, anchors, "_blocks", "_chunks")):
        place = F.pmod(F.xxhash64("id", F.lit(role)), F.col(own)).cast("int")
        copies = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        dealt = side.join(cut, group).withColumn("_place", place).withColumn("_copy", copies)
        chunk, block = ("_place", "_copy") if role == 0 else ("_copy", "_place")
        sides.append(
            dealt.withColumns(
                {"role": F.lit(role), "chunk": F.col(chunk), "block": F.col(block)}
            ).drop("_place", "_copy", "_chunks", "_blocks")
        )
    return sides[0].unionByName(sides[1], allowMissingColumns=True)


def _cells(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, pa.Table]]:
    """Rows and anchors of the cells of a partition sorted by ``keys``, one cell at a time."""
    held: list[pa.Table] = []
    now = None

    def split() -> tuple[pa.Table, pa.Table]:
        table = pa.concat_tables(held).combine_chunks()
        role = table["role"].to_numpy()
        return table.take(pa.array(np.flatnonzero(role == 0))), table.take(pa.array(np.flatnonzero(role == 1)))

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        columns = [table[k].to_numpy() for k in keys]
        new = np.zeros(table.num_rows, bool)
        for column in columns:
            new[1:] |= column[1:] != column[:-1]
        starts = [0, *np.flatnonzero(new).tolist()]
        for first, last in zip(starts, [*starts[1:], table.num_rows], strict=True):
            cell = tuple(column[first] for column in columns)
            if held and cell != now:
                yield split()
                held.clear()
            now = cell
            held.append(table.slice(first, last - first))
    if held:
        yield split()


def _matrix(table: pa.Table) -> np.ndarray:
    flat = table["vector"].combine_chunks().flatten().to_numpy()
    return flat.reshape(table.num_rows, len(flat) // max(1, table.num_rows))


def nearest(
    rows: DataFrame,
    anchors: DataFrame,
    same_label: bool,
    k: int,
    rows_per_cell: int,
    anchors_per_cell: int,
    bucket: int,
    focus: int,
    stage: Stage,
    name: str,
) -> DataFrame:
    """The best ``k`` rows for every anchor: ``anchor_id``, ``place``, ``score``, ``id``, ``rank``.

    ``anchors`` may have ``bands``, an array of (place, low, high); then each band of scores has its own best
    rows. With ``same_label`` rows of the anchor's label other than itself are searched, else those of
    other labels. Cells hand on their best rows, the best of these are written.
    """
    group = ["dim", "label"] if same_label else ["dim"]
    keys = [*group, "chunk", "block"]
    dealt = _grid(rows, anchors, group, rows_per_cell, anchors_per_cell, stage, name)
    dealt = dealt.repartition(*keys).sortWithinPartitions(*keys, "role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, asked in _cells(batches, keys):
            if not table.num_rows or not asked.num_rows:
                continue
            searched = Rows(table["id"].to_numpy(), table["label"].to_numpy(), _matrix(table), bucket)
            bands = asked["bands"].to_pylist() if "bands" in asked.column_names else [None] * asked.num_rows
            out = []
            for id, label, anchor, ranges in zip(
                asked["id"].to_pylist(), asked["label"].to_pylist(), _matrix(asked), bands, strict=True
            ):
                if ranges is None:
                    wanted = {0: Wanted(k)}
                else:
                    wanted = {b["place"]: Wanted(k, b["low"], b["high"]) for b in ranges}
                allowed = (searched.labels == label) == same_label
                allowed &= searched.ids != id
                searched.search(anchor, list(wanted.values()), allowed, focus)
                for place, w in wanted.items():
                    best = zip(w.scores.tolist(), w.ids.tolist(), strict=True)
                    out += [(id, place, score, row) for score, row in best]
            columns = list(zip(*out, strict=True)) or [()] * 4
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                ["anchor_id", "place", "score", "id"],
            )

    found = dealt.mapInArrow(run, "anchor_id long, place int, score long, id long")
    order = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order))
    return stage.put(ranked.filter(F.col("rank") <= k), name)


def mine(
    vectors: DataFrame,
    positives: int = 5,
    negatives: int = 10,
    lowest: int = 30,
    highest: int = 90,
    every: int = 100,
    scale: int = 256,
    rows_per_cell: int = 4096,
    anchors_per_cell: int = 4096,
    bucket: int = 512,
    focus: int = 3,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    stage: Stage | None = None,
) -> DataFrame:
    """Rows of other labels that score nearly as high as a positive, for every anchor.

    Components become floor(``scale`` * x); scores are whole inner products. Anchors are the rows whose id
    ``every`` divides, an anchor's positives its first ``positives`` other rows of the same label, by score
    (descending) and id. For each of them the first ``negatives`` rows of other labels with ``lowest`` *
    positive_score <= 100 * negative_score <= ``highest`` * positive_score are returned: ``anchor_id``,
    ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    The result is exact. Rows and anchors meet in cells of bounded size; in a cell the rows lie in
    buckets by length, with sorted lists of every coordinate. The scores found so far say how far a
    row's coordinates may be from the anchor's (``Bucket.may_reach``); rows in the ranges of the ``focus``
    largest coordinates are verified. Each cell hands on its best few rows for each anchor.

    Rows without an id or a label, and those whose vector is null or has a null or non-finite
    component, take no part. Only vectors of equal length are compared. Rows that repeat an id are one,
    the largest by label and components. A score beyond 64 bits is an error. An empty table gives no
    rows; other columns are not read.
    """
    stage = stage or Stage(vectors.sparkSession)
    rows = stage.put(whole_vectors(vectors, id_col, vector_col, label_col, scale), "vectors")
    anchors = rows.filter(F.col("id") % every == 0)
    sizes = (rows_per_cell, anchors_per_cell, bucket, focus, stage)
    close = nearest(rows, anchors, True, positives, *sizes, "positives")
    # below zero nothing lies between the lower share of a score and the higher one
    bands = close.filter("score >= 0").select(
        F.col("anchor_id").alias("id"),
        F.struct(
            F.col("rank").alias("place"),
            F.expr(f"({lowest} * cast(score AS decimal(20, 0)) + 99) div 100").alias("low"),
            F.expr(f"({highest} * cast(score AS decimal(20, 0))) div 100").alias("high"),
        ).alias("band"),
    )
    bands = bands.groupBy("id").agg(F.sort_array(F.collect_list("band")).alias("bands"))
    asked = stage.put(anchors.join(bands, "id"), "asked")
    found = nearest(rows, asked, False, negatives, *sizes, "negatives")
    close = close.select(
        "anchor_id",
        F.col("rank").alias("place"),
        F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return found.join(close, ["anchor_id", "place"]).select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
