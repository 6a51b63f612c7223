import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from batchkit.functions import arrays
from batchkit.operators import basket
from batchkit.operators.staging import Stage


def random_rows(seed, crowded=False):
    rng = random.Random(seed)
    rows = [(rng.randrange(12), f"p{rng.randrange(15):02d}") for _ in range(150)]
    if crowded:  # one basket holds a third of all rows and most products
        rows += [(99, f"p{rng.randrange(40):02d}") for _ in range(80)]
    return rows


def brute(rows, distinct):
    by_basket = {}
    for key, product in rows:
        by_basket.setdefault(key, []).append(product)
    pairs = Counter()
    for products in by_basket.values():
        products = sorted(set(products) if distinct else products)
        pairs.update(combinations(products, 2))
    return pairs


def counted(df):
    return {(r.product_a, r.product_b): r.n for r in df.collect()}


def test_golden(spark):
    df = spark.createDataFrame(
        [("u1", "B"), ("u1", "A"), ("u1", "A"), ("u2", "A"), ("u2", "B")], "u string, p string"
    )
    assert counted(basket.pair_counts(df, "u", "p", distinct=False)) == {
        ("A", "B"): 3,
        ("A", "A"): 1,
    }
    assert counted(basket.pair_counts(df, "u", "p")) == {("A", "B"): 2}


@pytest.mark.parametrize("distinct", [True, False])
@pytest.mark.parametrize("block", [1, 3, 7, 500])
def test_cells_of_any_size_give_the_same_pairs(spark, distinct, block):
    rows = random_rows(block, crowded=True)
    df = spark.createDataFrame(rows, "u int, p string")
    assert counted(basket.pair_counts(df, "u", "p", distinct, block)) == brute(rows, distinct)


def test_every_large_basket_is_cut(spark):
    rows = [(1, p) for p in range(2000)] + [(2, p) for p in range(5)] + [(3, p) for p in range(250)]
    stage = Stage(spark)
    items = basket.basket_items(spark.createDataFrame(rows, "u int, p int"), "u", "p")
    cells = basket._cells(stage.put(items, "items"), 100, stage, "t")
    cells = cells.groupBy("basket", "_i", "_j").count()
    assert cells.agg({"count": "max"}).first()[0] < 400
    assert cells.filter("basket = 2").count() == 1
    assert cells.filter("basket = 3").count() == 6


def test_no_rows_are_ranked_but_the_pairs(spark):
    df = spark.createDataFrame(random_rows(1, crowded=True), "u int, p string")
    for counted in (basket.pair_counts(df, "u", "p", block=3), basket.pair_counts(df, "u", "p", False)):
        assert "TakeOrdered" not in counted._jdf.queryExecution().executedPlan().toString()


def test_null_keys_make_no_pairs(spark):
    df = spark.createDataFrame([(1, "A"), (1, None), (None, "A"), (None, "B")], "u int, p string")
    assert counted(basket.pair_counts(df, "u", "p")) == {}
    assert counted(basket.pair_counts(df.limit(0), "u", "p", distinct=False)) == {}


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("k", [1, 5, 40])
def test_top_pairs_are_exact(spark, seed, k):
    rows = random_rows(seed, crowded=seed % 2 == 1)
    df = spark.createDataFrame(rows, "u int, p string")
    want = sorted(brute(rows, True).items(), key=lambda x: (x[1], x[0]), reverse=True)[:k]
    got = [((r.product_a, r.product_b), r.n) for r in basket.top_pairs(df, "u", "p", k, head=4).collect()]
    assert got == want


def test_ties_go_to_the_larger_pair(spark):
    df = spark.createDataFrame(
        [(b, p) for b, ps in enumerate(["AB", "AB", "AC", "AC", "BC"]) for p in ps],
        "u int, p string",
    )
    got = [(r.product_a, r.product_b, r.n) for r in basket.top_pairs(df, "u", "p", 2).collect()]
    assert got == [("A", "C", 2), ("A", "B", 2)]


def test_fewer_pairs_than_k(spark, rows):
    df = spark.createDataFrame([(1, "A"), (1, "B"), (2, "C")], "u int, p string")
    assert rows(basket.top_pairs(df, "u", "p", 5)) == [("A", "B", 1)]


def test_baskets(spark, rows):
    df = spark.createDataFrame([(1, "B"), (1, "A"), (1, "B"), (2, "C")], "u int, p string")
    assert rows(basket.baskets(df, "u", "p")) == [(1, ["A", "B"]), (2, ["C"])]


def in_chunks(rows, size):
    by_basket = {}
    for key, product in rows:
        if key is not None and product is not None:
            by_basket.setdefault(key, set()).add(product)
    return sorted(
        (key, part, sorted(products)[part * size : (part + 1) * size])
        for key, products in by_basket.items()
        for part in range(-(-len(products) // size))
    )


@pytest.mark.parametrize("size, rows_per_range", [(1, 7), (7, 10), (10, 100_000), (1000, 3)])
def test_chunks_do_not_depend_on_ranges(spark, rows, size, rows_per_range):
    data = random_rows(size, crowded=True) + [(5, None), (None, "p01")]
    df = spark.createDataFrame(data, "u int, p string")
    got = rows(basket.basket_chunks(df, "u", "p", size, rows_per_range))
    assert sorted(got) == in_chunks(data, size)
    whole = dict(rows(basket.baskets(df, "u", "p")))
    for key in whole:
        assert sum((products for k, _, products in sorted(got) if k == key), []) == whole[key]


def test_no_task_holds_a_hot_basket(spark, rows):
    # one basket has a third of all rows
    data = [(i // 2, i) for i in range(4000)] + [(-1, i) for i in range(2000)]
    df = spark.createDataFrame(data, "u int, p int")
    stage = Stage(spark)
    items = stage.put(basket.basket_items(df, "u", "p").select("basket", "product"), "items")
    ranged = basket._in_ranges(items, 300, stage)
    held = ranged.groupBy("_range").count().collect()
    assert max(r["count"] for r in held) < 900
    assert ranged.filter("basket = -1").select("_range").distinct().count() > 4
    chunks = basket.basket_chunks(df, "u", "p", 250, 300)
    assert sorted(rows(chunks)) == in_chunks(data, 250)
    assert basket.basket_chunks(df.limit(0), "u", "p").count() == 0


def test_array_route_finds_the_same_pairs(spark):
    rows = random_rows(8)
    df = spark.createDataFrame(rows, "u int, p string")
    pairs = basket.baskets(df, "u", "p").select(F.explode(arrays.pairs(F.col("products"))).alias("x"))
    by_array = pairs.groupBy("x.first", "x.second").count().collect()
    assert {(r.first, r.second): r[2] for r in by_array} == brute(rows, True)
    assert {(r.first, r.second): r[2] for r in by_array} == counted(basket.pair_counts(df, "u", "p"))


def test_pairs_of_short_arrays(spark):
    got = spark.sql("SELECT array('a', 'b', 'c') x UNION ALL SELECT array('a') UNION ALL SELECT array()")
    sizes = [len(r[0]) for r in got.select(arrays.pairs(F.col("x"))).collect()]
    assert sizes == [3, 0, 0]
