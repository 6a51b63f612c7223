import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from batchkit.llm import fingerprints, queries
from batchkit.llm.common import load

SF_DIR = "/root/testdata/sf0.001"


def distance(a, b):
    return (int(a, 16) ^ int(b, 16)).bit_count()


def check(got, docs, radius=12):
    """Rows as sorted tuples against a plain walk; ``docs`` are (id, text) in the order of the walk."""
    want = []
    prints = [fingerprints.fingerprint(t).hex() for _, t in docs]
    for k, (id, text) in enumerate(docs):
        other = (k + 1) % len(docs)
        half = len(text) // 2
        edited = text[: len(text) - half] + docs[other][1][:half]
        changed = fingerprints.fingerprint(edited).hex()
        want.append(
            (
                id, len(text), hashlib.sha256(edited.encode()).hexdigest(), prints[k], changed,
                1 - distance(prints[k], changed) / 256, 1 - distance(prints[k], prints[other]) / 256,
                sum(distance(prints[k], p) <= radius for p in prints) - 1,
            )
        )
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_every_document_against_plain_walk(spark):
    docs = [(r.doc_id, r.text or "") for r in load(spark, SF_DIR, "documents").orderBy("doc_id").collect()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = [tuple(r) for r in queries.op12_document_fingerprints(spark, SF_DIR).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    check(got, docs)
    assert np.mean([r[5] > r[6] for r in got]) > 0.95
    by_text = dict(docs)
    assert len({(by_text[r[0]], r[3]) for r in got}) == len({by_text[r[0]] for r in got})


def test_null_repeated_clashing_and_long(spark):
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [(3, "b a"), (1, None), (2, ""), (7, long), (8, "x" * 5000), (4, "b a"), (5, "b a")]
    named = [(i, t, i, t, "p") for i, t in rows]
    df = spark.createDataFrame(named, "doc_id long, text string, id long, point string, fingerprint string")
    got = [tuple(r) for r in fingerprints.compare_edits(df).collect()]
    check(got, sorted((i, t or "") for i, t in rows))
    # a null id is before all others; equal rows are told apart by nothing
    df = spark.createDataFrame([(None, "a b c d"), (1, "e f g h"), (1, "e f g h")], "doc_id long, text string")
    got = [tuple(r) for r in fingerprints.compare_edits(df).collect()]
    check(got, [(None, "a b c d"), (1, "e f g h"), (1, "e f g h")])


def test_single_and_empty(spark):
    one = spark.createDataFrame([(1, "one two three four")], "doc_id long, text string")
    check([tuple(r) for r in fingerprints.compare_edits(one).collect()], [(1, "one two three four")])
    assert fingerprints.compare_edits(one.limit(0)).collect() == []
    assert fingerprints.fingerprint("") == fingerprints.fingerprint(" \n") == bytes(32)


@pytest.mark.parametrize("radius, shared", [(6, 1), (7, 2), (12, 1)])
def test_tables_miss_nothing(spark, radius, shared):
    rng = random.Random(5)
    prints = []
    for _ in range(40):
        centre = rng.getrandbits(256)
        for _ in range(rng.choice([1, 3, 6])):
            spread = rng.sample(range(256), rng.choice([0, radius - 1, radius, radius + 1]))
            prints.append(centre ^ sum(1 << b for b in spread))
    prints += prints[:5] * 3
    rows = [(bytearray(p.to_bytes(32)),) for p in prints] + [(None,)]
    df = spark.createDataFrame(rows, "fingerprint binary")
    got = fingerprints.count_within(df, radius, shared_blocks=shared, block=8)
    want = {}
    for p in prints:
        n = sum((p ^ q).bit_count() <= radius for q in prints) - 1
        if n:
            want[p.to_bytes(32)] = n
    assert {bytes(r.fingerprint): r.n_near for r in got.collect()} == want


def test_crowded_cell_is_cut(spark):
    # one bit each: all in the cells of all blocks but one
    rows = [(bytearray((1 << i).to_bytes(32)),) for i in range(256)]
    df = spark.createDataFrame(rows, "fingerprint binary")
    got = fingerprints.count_within(df, 6, shared_blocks=1, block=16)
    assert {r.n_near for r in got.collect()} == {255} and got.count() == 256
    assert got.agg(F.countDistinct("fingerprint")).first()[0] == 256
