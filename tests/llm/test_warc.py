import gzip
import hashlib
import random
from pathlib import Path

from hypothesis import given, strategies as st

from batchkit.llm import queries, warc
from batchkit.operators.staging import Stage

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "page_id long, url string, html string"
NASTY = ["\r\n", "\r\n\r\n", "\r", "\n", "\r\r\n\r\n", "\r\n\r\n\r\n", "WARC/1.1\r\n", "x", "é", "\0"]


@given(st.lists(st.lists(st.integers(0, 30), max_size=12).map(sorted), max_size=9))
def test_loser_tree(runs):
    got = [r[0] for r in warc.LoserTree([iter([(v,) for v in run]) for run in runs])]
    assert got == sorted(v for run in runs for v in run)


def test_url_keys():
    keys = {
        "http://www.Example.com/a?b#c": "com,example)/a?b",
        "https://user@m.example.org:443": "org,example,m)/",
        "http://example.org:8080?q": "org,example:8080)?q",
        "no url": "no url",
        "": "",
    }
    assert {u: warc.url_key(u) for u in keys} == keys


def test_records_come_back(spark, tmp_path):
    rng = random.Random(4)
    texts = ["".join(rng.choices(NASTY, k=rng.randrange(30))) for _ in range(200)]
    texts += ["same " * 300] * 20 + ["small"] * 3 + [None, "", "big\r\n\r\n" * 40_000]
    data = [(i - 5, f"http://h{i % 7}.example/{i % 3} \r\n{i % 2}", t) for i, t in enumerate(texts)]
    data += [(500, None, "same " * 300), (500, None, "same " * 300), (-(2**63), "http://x", "y")]
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    rows = warc.archive(df, path=str(tmp_path / "w")).collect()
    want = []
    for i, _, t in data:
        raw = (t or "").encode()
        twin = t == "same " * 300 and i != 500
        want.append(
            (i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if twin else "response", 500 if twin else None)
        )
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    order = [(r.url_key, r.timestamp, r.page_id) for r in rows]
    assert order == sorted(order)
    # the index leads to each record in the unpacked archives
    for r in rows[::17]:
        whole = gzip.decompress(Path(r.file.removeprefix("file:")).read_bytes())
        record = whole[r.offset : r.offset + r.length]
        assert record.startswith(b"WARC/1.1\r\nWARC-Type: " + r.record_type.encode())
        assert record.endswith(b"\r\n\r\n") and whole[r.offset + r.length :][:8] in (b"WARC/1.1", b"")


def test_many_ranges_are_in_order(spark):
    data = [(i, f"http://h{i % 5}.example/", f"page {i}") for i in range(400)]
    stage = Stage(spark)
    path = stage.path("archives")
    warc.write_archives(spark.createDataFrame(data, SCHEMA).repartition(6), path)
    merged = warc.merge_index(warc.read_index(spark, path), stage, rows_per_task=60)
    order = [(r.url_key, r.timestamp, r.page_id) for r in merged.collect()]
    assert len(order) == 400 and order == sorted(order)


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert warc.archive(empty).count() == 0
    df = spark.createDataFrame([(None, None, None, "c", 1)], SCHEMA + ", bytes string, same int")
    assert [(r.page_id, r.url, r.payload_bytes) for r in warc.archive(df).collect()] == [(None, "", 0)]


def test_pages_without_an_id(spark):
    big, alone = "big " * 300, "none of these has an id " * 60
    data = [(None, "http://a", big), (0, "http://a", big), (None, "http://a", big), (-3, "http://a", big)]
    data += [(None, "http://b", alone), (None, "http://b", alone), (None, "http://c", "small"), (0, "http://c", "small")]
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    rows = [(r.url, r.page_id, r.record_type, r.refers_to) for r in warc.archive(df).collect()]
    assert rows == [
        ("http://a", None, "revisit", 0),
        ("http://a", None, "revisit", 0),
        ("http://a", -3, "revisit", 0),
        ("http://a", 0, "response", None),
        ("http://b", None, "response", None),
        ("http://b", None, "response", None),
        ("http://c", None, "response", None),
        ("http://c", 0, "response", None),
    ]


def test_the_whole_table(spark):
    pages = {r.page_id: r.html.encode() for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    rows = queries.op10_warc(spark, SF_DIR).collect()
    assert {r.page_id: (r.payload_bytes, r.payload_digest) for r in rows} == {
        i: (len(h), hashlib.sha1(h).hexdigest()) for i, h in pages.items()
    }
