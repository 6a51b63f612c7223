"""Toxicity of documents: FTRL-proximal logistic regression over hashed word features."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from batchkit.llm import labels as sampling
from batchkit.llm.common import crc_mod, slices
from batchkit.llm.words import Codes
from batchkit.operators.staging import Stage

BITS = 20  # features are hashed to 2**BITS places
STEM = 4
EDGE = re.compile(r"^\W+|\W+$")
# Fixed odd factors, one for each part of a feature.
FIRST, SECOND, SKIP = (np.uint64(f) for f in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def code(word: str) -> int:
    """Hashes of a word, lower-cased and without outer punctuation, and of its first letters."""
    plain = (EDGE.sub("", word) or word).lower()
    whole = zlib.crc32(plain.encode("utf-8", "surrogatepass"))
    stem = zlib.crc32(b"^" + plain[:STEM].encode("utf-8", "surrogatepass"))
    return whole << 32 | stem


@lru_cache(maxsize=1)
def codes() -> Codes:
    return Codes(code)


def features(text: str) -> np.ndarray:
    """Places of a document's features, with repeats: words, their stems, pairs and skip pairs.

    A pair is two neighbouring words, a skip pair has one word between.
    """
    both = codes().of(text, np.uint64)
    word, stem = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
    with np.errstate(over="ignore"):
        mixed = np.concatenate(
            [
                word * FIRST,
                stem * SECOND,
                word[:-1] * FIRST + word[1:] * SECOND,
                word[:-2] * SKIP + word[2:] * SECOND,
            ]
        )
        mixed ^= mixed >> np.uint64(29)
        mixed *= SECOND
    return (mixed >> np.uint64(64 - BITS)).astype(np.int32)


class Ftrl:
    """FTRL-proximal with a learning rate of its own for every coordinate; bias at the last place."""

    def __init__(self, alpha: float = 1.0, beta: float = 1.0, l1: float = 5.0, l2: float = 1.0):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((1 << BITS) + 1)
        self.n = np.zeros((1 << BITS) + 1)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        pull = np.sign(z) * self.l1 - z
        w = pull / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, places: np.ndarray, label: int) -> None:
        """One step on one document; ``places`` are the different features it has."""
        at = np.append(places, 1 << BITS)
        w = self.weights(at)
        w[-1] = -self.z[-1] / ((self.beta + np.sqrt(self.n[-1])) / self.alpha)  # no penalty on it
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label
        rate = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - rate * w
        self.n[at] += g * g

    def bias(self) -> float:
        return float(-self.z[-1] / ((self.beta + np.sqrt(self.n[-1])) / self.alpha))


@dataclass
class Model:
    """The non-zero weights only: places and values, as small as L1 leaves them."""

    places: np.ndarray
    values: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << BITS, np.float32)
        out[self.places] = self.values
        return out

    def score(self, text: str, dense: np.ndarray) -> float:
        at = features(text)
        at = np.unique(at[dense[at] != 0])
        logit = self.bias + float(dense[at].sum(dtype=np.float64))
        return 1 / (1 + float(np.exp(-np.clip(logit, -30, 30))))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    divisor: int = 5,
    held_out: int = 0,
    rows_per_class: int = 6_000,
    epochs: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    stage: Stage | None = None,
) -> Model:
    """Learn from a bounded sample of labelled documents, one after another in a fixed order.

    ``rows_per_class`` bounds the sample. It is written as arrays of places (at most 2**BITS a document),
    and one task reads it again for each epoch, a batch at a time. Labels of held-out ids are not read (see ``labels.sample``). The bias is corrected
    for the share of the labels in the sample. Without labels of both classes nothing is learned but
    the smoothed share of class 1.
    """
    stage = stage or Stage(docs.sparkSession)
    rows, counts = sampling.sample(
        docs, labels, label_col, divisor, held_out, rows_per_class, stage, id_col, text_col
    )
    clean, toxic = counts.get(0, 0), counts.get(1, 0)
    if not clean or not toxic:
        share = (toxic + 1) / (clean + toxic + 2)
        return Model(np.empty(0, np.int32), np.empty(0, np.float32), float(np.log(share / (1 - share))))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            places = [np.unique(features(t)) for t in batch["text"].to_pylist()]
            offsets = pa.array(np.cumsum([0, *map(len, places)]).astype(np.int32))
            flat = pa.array(np.concatenate([np.empty(0, np.int32), *places]))
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(offsets, flat), batch["label"], batch["place"]],
                ["places", "label", "place"],
            )

    def epoch(model: Ftrl) -> Ftrl:
        shared = docs.sparkSession.sparkContext.broadcast(model)

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = Ftrl()
            model.z, model.n = shared.value.z.copy(), shared.value.n.copy()
            for batch in batches:
                for p, label in zip(batch["places"], batch["label"].to_pylist(), strict=True):
                    model.learn(p.values.to_numpy(), label)
            at = np.flatnonzero(model.n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int32()), pa.array(model.z[at]), pa.array(model.n[at])], ["at", "z", "n"]
            )

        one = found.repartition(1).sortWithinPartitions("place", "label", "places")
        state = one.mapInArrow(learn, "at int, z double, n double").toArrow()
        shared.destroy()
        after = Ftrl()
        at = state["at"].to_numpy()
        after.z[at], after.n[at] = state["z"].to_numpy(), state["n"].to_numpy()
        return after

    found = stage.put(rows.mapInArrow(find, "places array<int>, label int, place long"), "features")
    model = Ftrl()
    for _ in range(epochs):
        model = epoch(model)
    stage.remove("features")
    values = model.weights(slice(0, 1 << BITS))
    places = np.flatnonzero(values).astype(np.int32)
    taken = {c: min(n, rows_per_class) for c, n in counts.items()}
    shift = np.log(toxic / clean) - np.log(taken[1] / taken[0])
    return Model(places, values[places].astype(np.float32), float(model.bias() + shift))


def score(model: Model, text: Column, spark) -> Column:
    """Probability that a text is toxic; null texts count as empty, which have a score too."""
    shared = spark.sparkContext.broadcast(model)

    @arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        dense = model.dense()
        for texts in batches:
            yield pa.array([model.score(t.as_py(), dense) for t in texts], pa.float64())

    return run(F.coalesce(text, F.lit("")))


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
    divisor: int = 5,
    held_out: int = 0,
    **options,
) -> DataFrame:
    """Id, ``held_out``, ``score`` and ``predicted`` (1 from ``threshold`` on) of every document.

    Rows with null or repeated ids are scored like others; equal texts have equal scores. An empty
    table gives no rows. Other columns are never inputs.
    """
    model = fit(
        docs, labels, divisor=divisor, held_out=held_out, id_col=id_col, text_col=text_col, **options
    )
    return docs.select(
        id_col,
        (crc_mod(id_col, divisor) == held_out).alias("held_out"),
        score(model, F.col(text_col), docs.sparkSession).alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
    **options,
) -> DataFrame:
    """The documents with a score under ``threshold``, with all their columns."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col, **options)
    return docs.filter(score(model, docs[text_col], docs.sparkSession) < threshold)
