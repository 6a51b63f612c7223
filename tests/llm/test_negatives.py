import math

import numpy as np
import pytest

from batchkit.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, id string, dim int, score int, chunk int"


def plain(rows, every=10):
    kept = {}
    for id, v, label in rows:
        if id is not None and label is not None and v is not None:
            if all(x is not None and math.isfinite(x) for x in v):
                kept[id] = max(kept.get(id, (label, v)), (label, v))
    whole = {i: (label, [math.floor(256 * float(np.float32(x))) for x in v]) for i, (label, v) in kept.items()}
    out = []
    for a, (label, v) in whole.items():
        if a % every:
            continue
        scored = [
            (-sum(x * y for x, y in zip(v, w, strict=True)), i, other)
            for i, (other, w) in whole.items()
            if i != a and len(w) == len(v)
        ]
        for ps, p in sorted((s, i) for s, i, other in scored if other == label)[:5]:
            fits = sorted((s, i) for s, i, other in scored if other != label and -30 * ps <= -100 * s <= -90 * ps)
            out += [(a, p, k, n, -ps, -s) for k, (s, n) in enumerate(fits[:10], 1)]
    return sorted(out)


def mined(spark, rows, **options):
    named = [(i, v, label, "x", 1, 2, 3) for i, v, label in rows]
    df = spark.createDataFrame(named, SCHEMA)
    return sorted(tuple(r) for r in negatives.mine(df, every=10, **options).collect())


def clusters(n, dim, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((4, dim))
    label = rng.integers(0, 4, n)
    scale = rng.uniform(0.2, 3, n)[:, None]
    v = scale * (centres[(label + (rng.random(n) < 0.3)) % 4] + 0.7 * rng.standard_normal((n, dim)))
    return [(i, [float(x) for x in v[i].astype(np.float32)], int(label[i])) for i in range(n)]


@pytest.mark.parametrize("cut", [{}, {"rows_per_cell": 40, "anchors_per_cell": 7, "bucket": 8, "focus": 5}])
def test_against_all_pairs(spark, cut):
    rows = clusters(400, 12)
    rows += [(400 + i, rows[7][1], 2) for i in range(30)]  # ties
    want = plain(rows)
    assert want and mined(spark, rows, **cut) == want


def test_what_takes_no_part(spark):
    rows = clusters(80, 3, 2) + [
        (None, [1.0, 2.0, 3.0], 1), (90, None, 1), (91, [1.0, None, 2.0], 1), (92, [1.0, math.nan, 0.0], 1),
        (93, [math.inf, 0.0, 0.0], 2), (94, [1.0, 1.0, 1.0], None), (100, [0.0, 0.0, 0.0], 1), (95, [], 2),
        (110, [1.0, 2.0], 1), (111, [1.0, 1.9], 1), (112, [0.5, 1.0], 2), (10, [3.0, 3.0, 3.0], 9),
    ]
    rows += rows[:5]
    want = plain(rows)
    assert want and mined(spark, rows) == want


def test_beyond_exact_doubles(spark):
    rows = [(i, [x * 1e6 for x in v], label) for i, v, label in clusters(60, 8, 5)]
    assert mined(spark, rows, bucket=7) == plain(rows) != []


def test_empty(spark):
    assert mined(spark, []) == []


def test_pruning_leaves_nothing_out_and_leaves_out_much():
    rows = clusters(600, 16, 3)
    vectors = np.array([[math.floor(256 * x) for x in v] for _, v, _ in rows], np.int64)
    index = negatives.Rows(np.arange(600), np.zeros(600, int), vectors, 100)
    lengths = np.linalg.norm(vectors, axis=1)
    seen = 0
    for a in range(0, 600, 20):
        q = vectors[a] / lengths[a]
        for bucket in index.buckets:
            for cosine in (0.3, 0.8, 0.95):
                real = vectors[bucket.at] @ vectors[a] / lengths[bucket.at] / lengths[a]
                found = set(bucket.may_reach(q, np.argsort(-np.abs(q))[:4], cosine).tolist())
                assert set(np.flatnonzero(real >= cosine)) <= found
                seen += len(found) * (cosine == 0.95)
    assert seen < 0.2 * 30 * 600
