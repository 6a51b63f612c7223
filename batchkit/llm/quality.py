"""Quality of documents: random-indexing word vectors, a small network, calibrated probabilities."""

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

# Words and word shapes are hashed to so many rows of one table of vectors.
WORDS, SHAPES, DIM, NONZERO = 1 << 13, 1 << 9, 32, 4
ROWS = WORDS + SHAPES
PARTS = 32
EDGE = re.compile(r"^\W+|\W+$")
RUNS = re.compile(r"([A-Z])\1+|([a-z])\2+|(.)\3+")


def shape(word: str) -> str:
    """The kinds of characters in a word, runs of one kind as one: ``A`` capital, ``a`` small, ``0``."""
    body, end = word[:-1], word[-1:]
    if body.isalpha() and body.islower() and not end.isalnum():
        return f"a{end}"
    kinds = "".join(
        "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word
    )
    return RUNS.sub(lambda m: m.group()[0] + ("+" if len(m.group()) > 1 and m.group(3) else ""), kinds)


def shape_row(kinds: str) -> int:
    return WORDS + zlib.crc32(kinds.encode("utf-8", "surrogatepass")) % SHAPES


LOWER = shape_row("a")


def code(word: str) -> int:
    """Table rows of a word and of its shape, packed into one number."""
    if word.isalpha() and word.islower():
        plain, kind = word, LOWER
    else:
        plain = EDGE.sub("", word).lower() or word
        kind = shape_row(shape(word))
    return zlib.crc32(plain.encode("utf-8", "surrogatepass")) % WORDS << 16 | kind


@lru_cache(maxsize=1)
def codes() -> Codes:
    return Codes(code)


@lru_cache(maxsize=1)
def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the few non-zero components of each row's random index vector."""
    rng = np.random.default_rng(17)
    places = np.argsort(rng.random((ROWS, DIM)), axis=1)[:, :NONZERO]
    return places, rng.choice([-1.0, 1.0], (ROWS, NONZERO))


def context_sums(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """For each table row, the sum of the index vectors of its neighbours in all documents.

    Neighbours are the two words, or the one shape, to either side. Tasks add up their own documents
    and hand on one table of fixed size in parts; parts are summed in two steps, so that no task
    reads one from every other. The sums are whole numbers, so their order changes nothing.
    """
    rows = docs.select(F.coalesce(text_col, F.lit("")).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = codes()
        places, signs = index_vectors()
        total = np.zeros(ROWS * DIM)
        for batch in slices(batches, "text"):
            arrays = [known.of(t) for t in batch["text"].to_pylist()]
            if not arrays:
                continue
            both = np.concatenate(arrays)
            text = np.repeat(np.arange(len(arrays)), list(map(len, arrays)))
            for values, reach in ((both >> 16, 2), (both & 0xFFFF, 1)):
                for step in range(1, reach + 1):
                    same = text[step:] == text[:-step]
                    a, b = values[:-step][same], values[step:][same]
                    for row, other in ((a, b), (b, a)):
                        at = (row[:, None] * DIM + places[other]).ravel()
                        total += np.bincount(at, signs[other].ravel(), ROWS * DIM)
        yield from _parts(total.astype(np.int64).reshape(PARTS, -1), enumerate)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(batch["part"].to_pylist(), batch["sums"].to_pylist(), strict=True):
                values = np.frombuffer(data, np.int64)
                sums[part] = sums[part] + values if part in sums else values
        yield from _parts(sums, dict.items)

    schema = "part int, sums binary"
    partial = rows.mapInArrow(count, schema).withColumn(
        "salt", F.pmod(F.spark_partition_id(), F.lit(PARTS))
    )
    once = partial.repartition(F.col("part"), F.col("salt")).select("part", "sums").mapInArrow(add, schema)
    twice = once.repartition(PARTS, F.col("part")).mapInArrow(add, schema)
    total = np.zeros((PARTS, ROWS * DIM // PARTS))
    for row in twice.collect():
        total[row.part] += np.frombuffer(row.sums, np.int64)
    return total.reshape(ROWS, DIM)


def _parts(sums, items) -> Iterator[pa.RecordBatch]:
    found = [(part, values.tobytes()) for part, values in items(sums)]
    yield pa.RecordBatch.from_arrays(
        [pa.array([p for p, _ in found], pa.int32()), pa.array([s for _, s in found], pa.binary())],
        ["part", "sums"],
    )


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """Directions of the context sums; a row never seen has a zero vector."""
    norms = np.linalg.norm(sums, axis=1, keepdims=True)
    return (sums / np.maximum(norms, 1.0)).astype(np.float32)


def pool(text: str, vectors: np.ndarray) -> np.ndarray:
    """What the network sees of a document: mean vectors of words and shapes, and three rates.

    These are the share of words that repeat the one before, that of different words, and the
    logarithm of the length.
    """
    both = codes().of(text)
    out = np.zeros(2 * DIM + 3, np.float32)
    if len(both):
        words = both >> 16
        out[:DIM] = vectors[words].mean(axis=0)
        out[DIM : 2 * DIM] = vectors[both & 0xFFFF].mean(axis=0)
        out[2 * DIM] = np.count_nonzero(words[1:] == words[:-1]) / len(words)
        seen = np.zeros(WORDS, bool)
        seen[words] = True
        out[2 * DIM + 1] = np.count_nonzero(seen) / min(len(words), WORDS)
        out[2 * DIM + 2] = np.log1p(len(words))
    return out


@dataclass
class Network:
    """Two layers on standardised inputs; ``temperature`` calibrates what comes out."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def train(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 40, seed: int = 5) -> Network:
    """Fit the network by Adam on four fifths of the rows and the temperature on the rest.

    With rows of one class only, or none, every score is the smoothed share of class 1.
    """
    rng = np.random.default_rng(seed)
    width = x.shape[1]
    if len(np.unique(y)) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        return Network(
            np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1),
            float(np.log(share / (1 - share))),
        )
    rest = np.arange(len(y)) % 5 == 4
    fit_x, fit_y = x[~rest], y[~rest]
    net = Network(
        fit_x.mean(axis=0), fit_x.std(axis=0) + 1e-3,
        rng.standard_normal((width, hidden)) / np.sqrt(width), np.zeros(hidden),
        rng.standard_normal(hidden) / np.sqrt(hidden), 0.0,
    )
    z = (fit_x - net.mean) / net.scale
    params = [net.w1, net.b1, net.w2, np.zeros(1)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(fit_y))
        for at in np.array_split(order, max(1, len(order) // 256)):
            step += 1
            h = np.tanh(z[at] @ params[0] + params[1])
            p = 1 / (1 + np.exp(-np.clip(h @ params[2] + params[3], -30, 30)))
            d = (p - fit_y[at]) / len(at)
            back = d[:, None] * params[2] * (1 - h * h)
            grads = [z[at].T @ back, back.sum(axis=0), h.T @ d, np.array([d.sum()])]
            for k, g in enumerate(grads):
                g = g + 1e-4 * params[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                rate = 0.005 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                params[k] = params[k] - rate * first[k] / (np.sqrt(second[k]) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = params[0], params[1], params[2], float(params[3][0])
    check_x, check_y = (x[rest], y[rest]) if len(np.unique(y[rest])) == 2 else (fit_x, fit_y)
    logits = net.logits(check_x)
    grid = np.geomspace(0.25, 8, 61)
    loss = [np.logaddexp(0, np.where(check_y == 1, -1, 1) * logits / t).mean() for t in grid]
    net.temperature = float(grid[int(np.argmin(loss))])
    return net


@dataclass
class Model:
    vectors: np.ndarray
    network: Network

    def score(self, text: str) -> float:
        return float(self.network.score(pool(text, self.vectors)[None])[0])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    divisor: int = 4,
    held_out: int = 2,
    rows_per_class: int = 10_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    stage: Stage | None = None,
) -> Model:
    """Word vectors from all documents, the network from a bounded sample of labelled ones.

    ``rows_per_class`` bounds the sample. Labels of held-out ids are not read (see ``labels.sample``).
    The table of vectors has a fixed size of about 1 MB whatever the corpus.
    """
    stage = stage or Stage(docs.sparkSession)
    vectors = word_vectors(context_sums(docs, text_col))
    rows, counts = sampling.sample(
        docs, labels, label_col, divisor, held_out, rows_per_class, stage, id_col, text_col
    )
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pooled = [pool(t, shared.value).tobytes() for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(pooled, pa.binary()), batch["label"], batch["place"]], ["x", "y", "place"]
            )

    found = rows.mapInArrow(features, "x binary, y int, place long").collect()
    found.sort(key=lambda r: (r.place, r.x))
    x = np.frombuffer(b"".join(bytes(r.x) for r in found), np.float32).reshape(-1, 2 * DIM + 3)
    y = np.array([r.y for r in found], float)
    network = train(x.astype(np.float64), y)
    if min(counts.get(0, 0), counts.get(1, 0)):  # the sample may have other shares than the labels
        network.b2 += network.temperature * float(
            np.log(counts[1] / counts[0]) - np.log(max(1, y.sum()) / max(1, (1 - y).sum()))
        )
    return Model(vectors, network)


def score(model: Model, text: Column, spark) -> Column:
    """Probability that a text is of class 1; null texts count as empty, which have a score too."""
    shared = spark.sparkContext.broadcast(model)

    @arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([shared.value.score(t.as_py()) for t in texts], pa.float64())

    return run(F.coalesce(text, F.lit("")))


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.7,
    id_col: str = "doc_id",
    text_col: str = "text",
    divisor: int = 4,
    held_out: int = 2,
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


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.7,
    id_col: str = "doc_id",
    text_col: str = "text",
    **options,
) -> DataFrame:
    """The documents with a score of at least ``threshold``, with all their columns."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col, **options)
    return docs.filter(score(model, docs[text_col], docs.sparkSession) >= threshold)
