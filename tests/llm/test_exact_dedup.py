import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from batchkit.llm import exact_dedup

SCHEMA = "doc_id long, text string"


def expected(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(i)
    out = []
    for text, ids in groups.items():
        keep = max(ids)
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), i == keep, sha) for i in ids]
    return sorted(out)


def test_groups_of_copies(spark, rows):
    data = [(i, "same") for i in range(300)] + [(i, f"text {i % 40}") for i in range(300, 380)]
    data += [(400, None), (401, ""), (402, " "), (403, "é" * 50_000), (404, "é" * 50_000)]
    df = spark.createDataFrame(data, SCHEMA).repartition(7)
    assert rows(exact_dedup.find_copies(df)) == sorted(expected(data), key=repr)


def test_a_digest_shared_by_different_texts_does_not_join_them(spark, rows):
    data = [(i, f"text {i % 5}") for i in range(20)] + [(30, "lone")]
    df = spark.createDataFrame(data, SCHEMA)
    weak = lambda text: F.substring(text, 1, 2).cast("binary")
    assert rows(exact_dedup.find_copies(df, digest=weak)) == sorted(expected(data), key=repr)


def test_ids_that_are_null_or_repeated(spark, rows):
    data = [(None, "a"), (1, "a"), (None, "b"), (None, "b"), (2, "c"), (2, "c"), (2, "d")]
    found = exact_dedup.find_copies(spark.createDataFrame(data, SCHEMA)).drop("text_sha256")
    assert rows(found) == sorted(
        [
            (None, 1, 2, False), (1, 1, 2, True), (None, None, 2, False), (None, None, 2, False),
            (2, 2, 2, True), (2, 2, 2, True), (2, 2, 1, True),
        ],
        key=repr,
    )


def test_empty_table_and_clashing_columns(spark):
    schema = "doc_id long, text string, keep_id int, kept string, _text int, _digest int"
    assert exact_dedup.find_copies(spark.createDataFrame([], schema)).count() == 0
    df = spark.createDataFrame([(1, "a", 9, "x", 0, 0), (2, "a", 9, "x", 0, 0)], schema)
    assert {(r.doc_id, r.keep_id) for r in exact_dedup.find_copies(df).collect()} == {(1, 2), (2, 2)}
    kept = exact_dedup.drop_copies(df)
    assert kept.columns == df.columns and [r.doc_id for r in kept.collect()] == [2]


def test_one_whole_row_of_each_group_stays(spark, rows):
    data = [(None, "a"), (1, "a"), (None, "b"), (None, "b"), (2, "c"), (2, "c"), (2, "d"), (3, "d"), (3, "e"), (None, "f"), (4, None)]
    kept = exact_dedup.drop_copies(spark.createDataFrame(data, SCHEMA).repartition(3))
    want = [(1, "a"), (None, "b"), (2, "c"), (3, "d"), (3, "e"), (None, "f"), (4, None)]
    assert rows(kept) == sorted(want, key=repr)
    twice = kept.unionByName(kept)
    assert rows(exact_dedup.drop_copies(twice)) == sorted(want, key=repr)
