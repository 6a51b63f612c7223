"""The encoder against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from batchkit.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF_DIR = "/root/testdata/sf0.01"
PARTS = (
    "a aa aaa th ing the word 's 'll 12 !! $$$ - <|endoftext|> <|endo é ß 日本 \U0001f600 ́".split()
    + [" ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "​", " the", "　", "٠"]
)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(data):
    return np.frombuffer(data, "<i4").tolist()


def test_random_texts(library):
    rng, own = random.Random(1), bpe.load(PATH)
    texts = ["".join(rng.choices(PARTS, k=rng.randrange(25))) for _ in range(3000)]
    texts += ["".join(rng.choices("abcdeinorstxz", k=rng.randrange(1, 40))) for _ in range(3000)]
    texts += [rng.choice("ae -=#") * rng.randrange(1, 300) for _ in range(300)]
    want = library.encode_batch(texts, add_special_tokens=False)
    for text, encoding in zip(texts, want, strict=True):
        got = ids(own.encode(text))
        assert got == encoding.ids
        assert own.decode(got) == library.decode(got, skip_special_tokens=False)


def test_decoding_of_any_ids(library):
    rng, own = random.Random(2), bpe.load(PATH)
    for _ in range(500):
        some = [rng.randrange(50257) for _ in range(rng.randrange(12))]
        assert own.decode(some) == library.decode(some, skip_special_tokens=False)
    assert own.decode([5, 10**6]) == library.decode([5])


def test_the_whole_table(spark, library):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    got = {r.doc_id: r for r in queries.op3_bpe(spark, SF_DIR).collect()}
    assert len(got) == len(docs)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for d in docs:
        want = library.encode(d.text or "", add_special_tokens=False).ids
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(want), sha(",".join(map(str, want))))
        assert r.decoded_sha256 == sha(library.decode(want, skip_special_tokens=False))


def test_edges(spark, library):
    long = "x" * 200_000 + " " + "word " * 30_000
    data = [(1, None, 5), (2, "", 5), (3, long, 5), (3, long, 5), (None, "a b", 5)]
    df = spark.createDataFrame(data, "doc_id long, text string, ids int")
    tokens = bpe.encode(df, PATH)
    assert tokens.columns == ["doc_id", "ids"]
    rows = bpe.decode(tokens, PATH).collect()
    assert sorted((r.doc_id or 0, r.text) for r in rows) == sorted((i or 0, t or "") for i, t, _ in data)
    assert [r.ids for r in rows if r.doc_id == 3][0] == library.encode(long).ids
    assert bpe.encode(df.limit(0), PATH).count() == 0
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert bpe.decode(nothing, PATH).collect()[0].text == ""


def test_other_kinds_of_files_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        bpe.Bpe(public_tokenizers.path("word_bpe_49k.json"))
