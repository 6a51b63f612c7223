"""Embeddings and fingerprints against brute force."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from batchkit.llm import cells, embeddings, simhash
from batchkit.llm.components import connected_components
from batchkit.operators.staging import Stage

SF_DIR = "/root/testdata/sf0.01"


def closure(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = np.random.default_rng(1)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 400)]
    links += [tuple(map(int, p)) for p in rng.integers(500, 900, (300, 2))] + [(7, 7)]
    df = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    got = {r.node: r.component for r in connected_components(df, Stage(spark)).collect()}
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert got == closure(linked, links)
    assert connected_components(df.limit(0), Stage(spark)).count() == 0


@pytest.mark.parametrize("block", [3, 8, 1000])
def test_every_two_rows_of_a_cell_meet_once(spark, block):
    rows = spark.range(60).select("id", (F.col("id") < 40).cast("int").alias("cell"))
    dealt = cells.meetings(rows, ["cell"], "id", Stage(spark), block)

    def run(batches):
        import pyarrow as pa

        for table, after in cells.whole_groups(batches, ["cell", *cells.GROUP]):
            ids = table["id"].to_numpy()
            for a, b in cells.pairs(after, table):
                yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])], ["a", "b"])

    met = [tuple(sorted(r)) for r in dealt.mapInArrow(run, "a long, b long").collect()]
    want = {(a, b) for a in range(60) for b in range(a + 1, 60) if (a < 40) == (b < 40)}
    assert len(met) == len(want) and set(met) == want


@pytest.mark.parametrize("block", [16, 1024])
def test_embeddings(spark, block):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((12, 32))
    vectors = np.repeat(centres, 25, axis=0) + rng.standard_normal((300, 32)) * 0.08
    data = [(i, v.astype(np.float32).tolist(), i % 2) for i, v in enumerate(vectors)]
    odd = [None, [], [0.0] * 32, [float("nan")] + [1.0] * 31, [None] + [1.0] * 31, [1e30] * 32]
    data += [(1000 + i, v, 0) for i, v in enumerate(odd)]
    data += [(2000, [1.0] * 32, 0), (2001, [1.0] * 32, None), (2002, [1.0] * 31, 0)]
    data += [data[0], (None, [1.0] * 32, 0)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in embeddings.find_near(df, block=block).collect()}
    unit = vectors.astype(np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.93) & (np.arange(300)[:, None] % 2 == np.arange(300) % 2)
    np.fill_diagonal(near, False)
    links = [(int(a), int(b)) for a, b in zip(*np.nonzero(near), strict=True)] + [(1005, 2000)]
    want = closure([i for i, _, _ in data if i is not None], links)
    assert {i: r.component_id for i, r in got.items() if i is not None} == want
    assert [got[i].n_links for i in range(300)] == near.sum(axis=1).tolist()
    assert [got[1000 + i].n_links for i in range(6)] == [0, 0, 0, 0, 0, 1]
    assert all(r.kept == (i == r.component_id) for i, r in got.items() if i is not None)
    assert (got[None].n_links, got[None].component_id, got[None].kept) == (0, None, False)
    assert embeddings.find_near(df.limit(0)).count() == 0


def test_embeddings_in_columns_of_clashing_names(spark):
    data = [(1, [1.0, 2.0], None), (2, [2.0, 4.0], 1), (3, [1.0, 2.0], 1), (4, [-1.0, 2.0], 1), (None, None, 1)]
    df = spark.createDataFrame(data, "n long, vector array<double>, label int")
    df = df.withColumns({c: F.lit(7) for c in ("id", "node", "weight", "component", "keys", "_n", "dim", "_row")})
    got = embeddings.find_near(df, "n", "vector", None).collect()
    got = {r[0]: (r.n_links, r.component_id, r.kept) for r in got}
    assert got == {1: (2, 1, True), 2: (2, 1, False), 3: (2, 1, False), 4: (0, 4, True), None: (0, None, False)}


def test_groups_of_equal_vectors_cost_no_comparisons(spark):
    """Nearly all rows are one vector, a smaller group lies beside it, others are apart."""
    rng = np.random.default_rng(8)
    apart = rng.standard_normal((200, 16))
    few = spark.createDataFrame([(30_000 + i, v.tolist()) for i, v in enumerate(apart)], "id long, v array<double>")
    v, w = (F.array(*map(F.lit, [1.0] * 15 + [last])) for last in (1.0, 1.2))
    hot = spark.range(20_300).select("id", F.when(F.col("id") < 20_000, v).otherwise(w).alias("v"))
    got = embeddings.find_near(hot.union(few), "id", "v", None).collect()
    unit = np.vstack([np.ones(16), [1.0] * 15 + [1.2], apart])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.93
    assert near[0].tolist() == [True, True] + [False] * 200  # the random ones are apart
    hot_rows = [r for r in got if r.id < 20_300]
    assert len(got) == 20_500 and len(hot_rows) == 20_300
    assert {(r.n_links, r.component_id) for r in hot_rows} == {(20_299, 0)}
    assert [r.id for r in hot_rows if r.kept] == [0]
    links = near[2:, 2:].sum(axis=1) - 1
    assert [r.n_links for r in sorted(got, key=lambda r: r.id)[20_300:]] == links.tolist()


def test_pairs_are_compared_where_they_first_meet():
    keys = np.random.default_rng(2).integers(0, 4, (40, 9))
    a, b = np.triu_indices(40, 1)
    for table in range(9):
        x, y = embeddings.first_meetings(a, b, keys, np.full(40, table))
        want = [(i, j) for i, j in zip(a, b, strict=True) if (keys[i, :table] != keys[j, :table]).all()]
        assert list(zip(x, y, strict=True)) == want


@pytest.mark.parametrize("bits", [12, 16, 20])
def test_recall_of_more_planes(bits):
    tables = embeddings.tables_for(bits, 0.93, 0.997)
    same = (1 - np.arccos(0.93) / np.pi) ** bits
    assert 1 - (1 - same) ** tables >= 0.997 > 1 - (1 - same) ** (tables - 1)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(5)
    a = rng.standard_normal((2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((2000, 64))
    b -= (b * a).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    b = 0.93 * a + np.sqrt(1 - 0.93**2) * b
    tables = embeddings.tables_for(16, 0.93, 0.997)
    met = (embeddings.signatures(a, tables, 16) == embeddings.signatures(b, tables, 16)).any(axis=1)
    assert met.mean() > 0.985


def brute_fingerprint(text):
    words = [w for w in text.encode().lower().split() if w]
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_simhash_of_all_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    prints = {r.doc_id: brute_fingerprint(r.text or "") for r in docs.collect()}
    ids = sorted(prints)
    values = np.array([prints[i] for i in ids], np.uint64)
    near = np.bitwise_count(values[:, None] ^ values) <= 4
    want = closure(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near), strict=True)])
    got = simhash.find_near(docs, block=16).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: int(r.fingerprint, 16) for r in got} == prints


def test_simhash_edges(spark):
    long = "word " * 60_000
    texts = [None, "", " \n", "One two", "one\ttwo", "É é", long, long + "x", "a b c d e"]
    df = spark.createDataFrame(
        [*enumerate(texts), (3, "One two"), (None, "one two"), (None, "alone")], "doc_id long, text string"
    )
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.find_near(df).collect()]
    by_id = {i: (f, c) for i, f, c in got}
    assert len(got) == 12
    assert all(by_id[i] == ("0" * 16, 0) for i in (0, 1, 2))
    assert by_id[3] == by_id[4] and by_id[4][1] == 3
    assert all(int(by_id[i][0], 16) == brute_fingerprint(texts[i] or "") for i in range(9))
    assert sorted(c for i, _, c in got if i is None and c is not None) == [3]
    assert simhash.find_near(df.limit(0)).count() == 0
    clash = df.withColumns({"fingerprint": F.lit(1), "component_id": F.lit(2), "node": F.lit(3)})
    assert simhash.drop_near(clash.filter("doc_id IN (3, 4, 8)")).columns == clash.columns


def test_documents_that_share_an_id(spark):
    near, far, other = ("one two three four", "ONE two three four", "quite another text of words")
    data = [(3, near, "a"), (5, far, "b"), (5, other, "c"), (5, other, "c"), (None, "no id", "d"), (None, "NO id", "e")]
    data += [(None, near, "f"), (7, near + " five", "g"), (7, near + " five", "g")]
    df = spark.createDataFrame(data, "doc_id long, text string, _sha string").repartition(3)
    got = sorted((r.doc_id or 0, r.component_id or 0) for r in simhash.find_near(df).collect())
    assert got == [(0, 0), (0, 0), (0, 3), (3, 3), (5, 3), (5, 5), (5, 5), (7, 7), (7, 7)]
    kept = simhash.drop_near(df)
    assert kept.columns == df.columns
    kept = sorted((r.doc_id or 0, r.text.lower(), r._sha) for r in kept.collect())
    assert [k[:2] for k in kept] == [(0, "no id"), (3, near), (5, other), (7, near + " five")]
    assert [k[2] for k in kept[1:]] == ["a", "c", "g"]


def test_masks_miss_no_link():
    rng = np.random.default_rng(2)
    masks = simhash.block_masks(4, 2)
    for _ in range(300):
        flips = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(mask & flips == 0 for mask in masks)
