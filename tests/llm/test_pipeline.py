"""Each stage of the pipeline against a plain version on what the stage before kept."""

from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from batchkit.llm import quality, toxicity
from batchkit.llm.common import load
from batchkit.operators.staging import Stage
from tests.llm.test_near import brute_fingerprint, closure
from tests.llm.test_packing import gapless

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    stage, docs, found = Stage(spark), load(spark, SF_DIR, "documents"), []
    found.append(docs)
    for name, step in corpus_pipeline.STAGES:
        docs = stage.put(step(spark, docs, SF_DIR), name)
        found.append(docs)
    return found


def texts(df):
    return {r.doc_id: r.text or "" for r in df.collect()}


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality", "toxicity", "exact_dedup", "near_dedup", "packing"
    ]
    assert all(df.columns == stages[0].columns for df in stages[:-1])
    counts = [df.count() for df in stages[:-1]]
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0


def test_classifiers_decide(spark, stages):
    labels = load(spark, SF_DIR, "labels")
    model = quality.fit(stages[0], labels)
    assert texts(stages[1]) == {i: t for i, t in texts(stages[0]).items() if model.score(t) >= 0.7}
    model = toxicity.fit(stages[1], labels)
    dense = model.dense()
    assert texts(stages[2]) == {i: t for i, t in texts(stages[1]).items() if model.score(t, dense) < 0.5}


def test_exact_and_near_copies_go(stages):
    keep = {}
    for i, t in texts(stages[2]).items():
        keep[t] = max(keep.get(t, i), i)
    assert texts(stages[3]) == {i: t for t, i in keep.items()}
    rest = texts(stages[3])
    ids = sorted(rest)
    prints = np.array([brute_fingerprint(rest[i]) for i in ids], np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints) <= 4
    group = closure(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near), strict=True)])
    assert texts(stages[4]) == {i: rest[i] for i in ids if group[i] == i}


def test_all_that_is_left_is_packed(stages):
    rows = stages[5].collect()
    ends = defaultdict(list)
    for r in rows:
        ends[r.doc_id].append((r.start, r.start + r.length))
    assert set(ends) == set(texts(stages[4]))
    for parts in ends.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a[1] == b[0] for a, b in zip(parts, parts[1:], strict=False))
    gapless(rows, 2048)


def test_odd_rows_pass_all_stages(spark):
    columns = "doc_id long, text string, lang string, source string, n_chars long, label int, score int"
    rows = [(1, None, None, None, None, 1, 1), (2, "", "en", "s", 0, 1, 1), (3, "a b", "en", "s", 3, 1, 1)]
    stage = Stage(spark)
    for data in (rows, []):
        docs = spark.createDataFrame(data, columns)
        for name, step in corpus_pipeline.STAGES[:-1]:
            docs = stage.put(step(spark, docs, SF_DIR), f"{name}-{len(data)}")
            assert docs.columns == [c.split()[0] for c in columns.split(", ")]
        corpus_pipeline.packed(spark, docs, SF_DIR).count()
