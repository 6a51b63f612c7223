import random
import statistics

import pytest
from pyspark.sql import functions as F

from batchkit.operators import rank, ratings


def test_golden(spark, rows):
    df = spark.createDataFrame(
        [("one", "a", 4.0), ("same", "a", 3.0), ("same", "b", 3.0), ("two", "a", 1.0), ("two", "b", 5.0)],
        "u string, p string, s double",
    )
    got = rows(ratings.zscore(df, "u", "s").select("u", "p", F.round("zscore", 4)))
    assert got == [
        ("one", "a", 0.0),
        ("same", "a", 0.0),
        ("same", "b", 0.0),
        ("two", "a", -0.7071),
        ("two", "b", 0.7071),
    ]
    means = dict(rows(ratings.mean_normalised(df, "u", "p", "s")))
    assert means["a"] == pytest.approx(-0.7071 / 3, abs=1e-4)
    assert means["b"] == pytest.approx(0.7071 / 2, abs=1e-4)


def test_against_brute_force(spark):
    rng = random.Random(3)
    data = [(min(rng.randrange(9), 3), i, float(rng.randrange(1, 6))) for i in range(300)]
    df = spark.createDataFrame(data, "u int, p int, s double")
    got = {(r.u, r.p): r.zscore for r in ratings.zscore(df, "u", "s").collect()}
    assert len(got) == len(data)
    for user in {u for u, _, _ in data}:
        scores = [s for u, _, s in data if u == user]
        mean, std = statistics.mean(scores), statistics.stdev(scores)
        for u, p, s in data:
            if u == user:
                assert got[u, p] == pytest.approx((s - mean) / std)
        assert sum(z for (u, _), z in got.items() if u == user) == pytest.approx(0, abs=1e-9)


def test_a_hot_user_is_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    df = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("u"), F.rand(1).alias("s")
    )
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        scored = ratings.zscore(df, "u", "s")
        assert scored.agg(F.count(F.lit(1)), F.round(F.sum("zscore"), 6)).collect()[0][0] == 60_000
        scored.collect()
        assert "skew=true" in scored._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_empty(spark, rows):
    df = spark.createDataFrame([], "u int, p int, s double")
    assert rows(ratings.zscore(df, "u", "s")) == []


def test_top_k_orders_and_cuts(spark):
    df = spark.createDataFrame([("A,B", 2), ("A,C", 2), ("B,C", 1)], "pair string, n int")
    got = rank.top_k(df, [F.desc("n"), F.desc("pair")], 2).collect()
    assert [r.pair for r in got] == ["A,C", "A,B"]


def test_top_k_keeps_the_best_of_each_task_only(spark):
    df = rank.top_k(spark.range(100), [F.desc("id")], 3)
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()


def test_top_per_group(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 2), ("b", 5)], "g string, v int")
    best = rank.top_per_group(df, ["g"], [F.desc("v")], 2)
    assert rows(best) == [("a", 2), ("a", 3), ("b", 5)]
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
