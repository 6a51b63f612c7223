"""Every named query against SQL in another engine, on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from batchkit.plans import oracle, queries, tables

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES = entry_points.queries()
ORACLE = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    relation = duck.sql(ORACLE[name])
    columns = sorted(df.columns)
    assert columns == sorted(relation.columns)
    places = [relation.columns.index(c) for c in columns]
    want = sorted(tuple(plain(row[i]) for i in places) for row in relation.fetchall())
    got = sorted(tuple(plain(row[c]) for c in columns) for row in df.collect())
    assert got == want


def test_only_models_have_no_sql():
    own = set(queries.QUERIES)
    assert own - set(oracle.ORACLE) == {"text_classifier"}
    assert own <= set(QUERIES) and set(ORACLE) <= set(QUERIES)


def test_text_classifier_predicts_every_test_row(spark):
    rows = QUERIES["text_classifier"](spark, SF_DIR).collect()
    assert len(rows) == len({r.doc_id for r in rows}) > 0
    assert {r.prediction for r in rows} <= {0.0, 1.0}


def test_min_and_max_are_met():
    """On the smallest tables no priority has both; on these one has."""
    folder = "/root/testdata/sf0.01"
    connection = duckdb.connect()
    for name in ("orders", "lineitem"):
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    assert connection.sql(ORACLE["min_max_year_select"]).fetchall()


def test_min_max_year_select_has_rows(spark):
    assert QUERIES["min_max_year_select"](spark, "/root/testdata/sf0.01").count() > 0


def test_min_max_year_select_is_over_every_order(spark):
    """Not over the few priorities: each order is a course, those without a line in both years too."""
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet").select("o_orderkey")
    counts = tables.order_view_counts(spark, SF_DIR)
    assert sorted(r.CID for r in counts.collect()) == sorted(r.o_orderkey for r in orders.collect())
    assert counts.filter("views_1996 = 0 AND views_1999 = 0").count() > 0
    found = QUERIES["min_max_year_select"](spark, SF_DIR)
    assert found.join(orders, found.CID == orders.o_orderkey).count() == found.count() > 0


def left_over(root):
    return {str(p.relative_to(root).parent) for p in root.rglob("part-*")}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_only_what_the_result_reads_is_left(spark, name):
    root = Path(spark.conf.get("spark.checkpoint.dir"))
    before = left_over(root)
    df = QUERIES[name](spark, SF_DIR)
    read = {p.split("file:")[-1].replace("%20", " ") for p in df.inputFiles()}
    read = {str(Path("/" + p.lstrip("/")).parent.relative_to(root)) for p in read if str(root) in p}
    assert left_over(root) - before <= read


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["station", "weekday", "hour", "criticality"]
    assert df.count() > 0
