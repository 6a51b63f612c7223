import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from batchkit.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")
SF_DIR = "/root/testdata/sf0.01"


def gapless(rows, size):
    """Whether every sequence is filled from 0 without gaps, and how many there are."""
    found = defaultdict(list)
    for r in rows:
        found[r.sequence_id].append((r.offset, r.length))
    for parts in found.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= size
    return len(found)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=200), st.integers(1, 6))
def test_best_fit_against_a_plain_list(lengths, limit):
    bins, plain, closed = packing.OpenBins(32, limit), {}, 0
    for n in lengths:
        number, offset = bins.put(n)
        fitting = {b: used for b, used in plain.items() if 32 - used >= n}
        if fitting:
            assert number in fitting and fitting[number] == max(fitting.values())
        else:
            assert number not in plain and offset == 0
        plain[number] = offset + n
        if plain[number] == 32:
            del plain[number]
        if len(plain) > limit:
            full = max(plain.values())
            gone = [b for b, used in plain.items() if used == full and b not in _open(bins)]
            assert len(gone) == 1
            del plain[gone[0]]
            closed += 1
        assert set(plain) == _open(bins) and len(plain) <= limit


def _open(bins):
    return {b for group in bins.bins for b in group}


def test_the_whole_table(spark):
    library = Tokenizer.from_file(PATH)
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = queries.op9_best_fit_packing(spark, SF_DIR).collect()
    got = defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    assert set(got) == set(docs)
    total = 0
    for i, text in docs.items():
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        total += len(ids)
        want = []
        for k, start in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[start : start + 2048], "<u4")
            want.append((k, start, len(part), zlib.crc32(part.tobytes())))
        assert sorted(got[i]) == want
    assert gapless(rows, 2048) <= -(-total // 2048) * 1.01 + 1


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(i, "some words here " * (i % 7)) for i in range(40)], "doc_id long, text string")
    placed = packing.pack(packing.pieces(docs, PATH, 8, with_ids=True).cache(), 8)
    parts = {(r.sequence_id, r.offset): bytes(r.ids) for r in placed.collect()}
    for r in packing.sequences(placed).collect():
        assert len(r.ids) == 4 * r.length
        for (number, offset), data in parts.items():
            if number == r.sequence_id:
                assert bytes(r.ids)[4 * offset : 4 * offset + len(data)] == data


def test_few_open_bins_and_edges(spark):
    data = [(1, None), (2, ""), (3, "a"), (3, "a"), (None, "b c"), (4, "word " * 30_000), (5, "x" * 50_000)]
    df = spark.createDataFrame(data, "doc_id long, text string").withColumn("piece", F.lit("clash"))
    rows = packing.pack(packing.pieces(df, PATH).cache(), open_bins=1).collect()
    gapless(rows, 2048)
    assert sum(r.doc_id == 3 for r in rows) == 2
    assert sum(r.length for r in rows if r.doc_id == 4) == 30_001
    assert sorted((r.length for r in rows if r.doc_id in (1, 2))) == [1, 1]
    assert packing.pack_documents(df.limit(0), PATH).count() == 0


def test_bins_close_and_repeats_are_spread(spark):
    rng = np.random.default_rng(8)
    lengths = rng.integers(1, 1200, 3000).tolist()
    df = spark.createDataFrame(
        [(None, 0, 0, n, 7, "c") for n in lengths],
        "doc_id long, piece int, start long, length long, ids_crc32 long, _order string",
    )
    used = {}
    for limit, ahead in ((4, 1), (256, 1), (256, 256)):
        rows = packing.pack(df, open_bins=limit, ahead=ahead).collect()
        used[limit, ahead] = gapless(rows, 2048)
        assert sorted(r.length for r in rows) == sorted(lengths)
    least = -(-sum(lengths) // 2048)
    whole = gapless(packing.pack(df, longest_first=True).collect(), 2048)
    assert least <= whole <= used[256, 256] <= used[256, 1] < used[4, 1]
    assert used[256, 256] <= 1.02 * least
    # one id and one checksum in all rows: still dealt to all tasks
    tasks = packing.pack(df, pieces_per_task=300).groupBy((F.col("sequence_id") / (1 << 36)).cast("int")).count()
    assert tasks.count() >= 8 and tasks.agg(F.max("count")).first()[0] < 900
