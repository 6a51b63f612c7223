"""Held-out accuracy, the bounds of the samples and defined results for odd input."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from batchkit.llm import labels as sampling
from batchkit.llm import quality, queries, toxicity
from batchkit.llm.common import load
from batchkit.operators.staging import Stage

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, score int, label string"


@pytest.mark.parametrize(
    ("query", "label", "divisor", "rest", "threshold", "least"),
    [
        (queries.op5_quality, "quality", 4, 2, 0.7, 0.93),
        (queries.op6_toxicity, "toxic", 5, 0, 0.5, 0.85),
    ],
)
def test_held_out(spark, query, label, divisor, rest, threshold, least):
    rows = {r.doc_id: r for r in query(spark, SF_DIR).collect()}
    docs = load(spark, SF_DIR, "documents")
    assert set(rows) == {r.doc_id for r in docs.select("doc_id").collect()}
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % divisor == rest)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= threshold)
    truth = {r.doc_id: r[label] for r in load(spark, SF_DIR, "labels").collect()}
    right = [rows[i].predicted == y for i, y in truth.items() if rows[i].held_out]
    assert np.mean(right) >= least


@pytest.mark.parametrize("spare", [4.0, 0.01])
def test_the_choice_does_not_depend_on_the_bound(spark, spare):
    known = spark.range(30_000).select(F.col("id").alias("_id"), F.xxhash64("id").alias("place"))
    want = known.orderBy("place", "_id").limit(50).collect()
    assert sampling.first_places(known, 50, 30_000, spare).collect() == want
    assert sampling.first_places(known.limit(9), 50, 9, spare).count() == 9
    assert sampling.first_places(known.limit(0), 50, 0, spare).count() == 0
    tied = known.withColumn("place", F.lit(2**62))
    assert [r._id for r in sampling.first_places(tied, 3, 30_000, spare).collect()] == [0, 1, 2]


@pytest.mark.parametrize("module", [quality, toxicity])
def test_edges(spark, module):
    long = "fine words here " * 20_000
    texts = [None, "", "  \n", long, "BAD!! BAD!! idiot", "nice small words", "one"]
    data = [(i, t, 7, "x") for i, t in enumerate(texts)] * 2 + [(None, "nice small words", 7, "x")]
    docs = spark.createDataFrame(data, SCHEMA)
    column = "quality" if module is quality else "toxic"
    labels = spark.createDataFrame(
        [(i, i % 2, i % 2) for i in range(7)] + [(1, None, None), (None, 1, 1), (99, 0, 0), (3, 5, 5)],
        "doc_id long, quality int, toxic int",
    )
    rows = module.score_documents(docs, labels).collect()
    assert len(rows) == 15 and all(0 <= r.score <= 1 for r in rows)
    by_text = {}
    for r in rows:
        by_text.setdefault(texts[r.doc_id] or "" if r.doc_id is not None else "nice small words", set()).add(r.score)
    assert all(len(s) == 1 for s in by_text.values())
    assert module.score_documents(docs.limit(0), labels).count() == 0
    for some in (labels.limit(0), labels.filter(f"{column} = 1")):
        scores = {r.score for r in module.score_documents(docs, some).collect()}
        assert len(scores) == 1
    kept = module.keep_good(docs, labels) if module is quality else module.drop_toxic(docs, labels)
    assert kept.columns == docs.columns


def test_held_out_labels_are_not_learned(spark):
    docs = spark.createDataFrame([(i, f"word{i % 3} text") for i in range(60)], "doc_id long, text string")
    flipped = lambda rest, divisor: spark.createDataFrame(
        [
            (i, 1 - i % 2 if zlib.crc32(str(i).encode()) % divisor == rest else i % 2)
            for i in range(60)
        ],
        "doc_id long, label int",
    )
    plain = flipped(9, 4)
    for module, divisor, rest, column in ((quality, 4, 2, "quality"), (toxicity, 5, 0, "toxic")):
        scores = [
            sorted(module.score_documents(docs, y.withColumnRenamed("label", column)).collect())
            for y in (plain, flipped(rest, divisor))
        ]
        assert scores[0] == scores[1]


def test_context_sums_against_a_plain_loop(spark):
    texts = ["a b c d a", "a B, c!", "x", "", None, "a a a b"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    places, signs = quality.index_vectors()
    want = np.zeros((quality.ROWS, quality.DIM))
    for text in texts:
        both = [quality.code(w) for w in (text or "").split()]
        for values, reach in (([b >> 16 for b in both], 2), ([b & 0xFFFF for b in both], 1)):
            for i, row in enumerate(values):
                for j in range(max(0, i - reach), min(len(values), i + reach + 1)):
                    if i != j:
                        np.add.at(want[row], places[values[j]], signs[values[j]])
    assert np.array_equal(quality.context_sums(docs), want)


def test_the_network_separates_and_calibrates():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((3000, 5))
    y = (rng.random(3000) < 1 / (1 + np.exp(-3 * x[:, 0] * x[:, 1]))).astype(float)
    net = quality.train(x, y)
    p = net.score(x)
    assert ((p > 0.5) == y).mean() > 0.75
    high = (p > 0.8) & (p < 0.95)
    assert abs(p[high].mean() - y[high].mean()) < 0.08


def test_ftrl_keeps_only_what_matters():
    rng = np.random.default_rng(1)
    model = toxicity.Ftrl()
    for k in range(3000):
        some = rng.integers(100, 4000, 50)
        model.learn(np.unique(np.append(some, 7) if k % 4 == 0 else some), int(k % 4 == 0))
    w = model.weights(slice(0, 1 << toxicity.BITS))
    assert w[7] > 1 and np.count_nonzero(w) < 500


def test_the_sample_has_one_row_for_each_chosen_id(spark):
    data = [(1, f"copy {k}") for k in range(300)] + [(i, f"words of {i}") for i in range(2, 60)] + [(2, None), (None, "x")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    for some in (docs, docs.repartition(5, "text")):
        found, counts = sampling.sample(some, labels, "toxic", 1, 1, 20, Stage(spark))
        rows = found.collect()
        assert len({r.place for r in rows}) == len(rows) == 40 and counts == {0: 29, 1: 30}
        found, _ = sampling.sample(some, labels, "toxic", 1, 1, 99, Stage(spark))
        texts = sorted(r.text for r in found.collect())
        first = min((t for i, t in data if i == 1), key=lambda t: hashlib.sha256(t.encode()).hexdigest())
        assert len(texts) == 59 and [t for t in texts if t.startswith("copy")] == [first]


def test_epochs_over_the_stored_sample(spark):
    docs = spark.createDataFrame([(i, f"word{i % 7} text {'bad' if i % 2 else 'fine'} {i}") for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    rows, counts = sampling.sample(docs, labels, "toxic", 5, 0, 1000, Stage(spark))
    plain = toxicity.Ftrl()
    seen = sorted(rows.collect(), key=lambda r: r.place)
    for _ in range(3):
        for r in seen:
            plain.learn(np.unique(toxicity.features(r.text)), r.label)
    model = toxicity.fit(docs, labels)
    assert np.array_equal(model.dense(), plain.weights(slice(0, 1 << toxicity.BITS)).astype(np.float32))
    assert model.bias == plain.bias() and len(model.places)
