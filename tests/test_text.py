import json
import os
import re
import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Observation, functions as F

from batchkit.functions import text as tx
from batchkit.operators import text

LINES = ["Hello -- World", "", "   ", " a b", "word", "è x", "A b\tc  d ", "x"]


@pytest.fixture
def lines(spark):
    return spark.createDataFrame([(line,) for line in LINES], "line string")


def java_split(line):
    if line == "":
        return [""]
    parts = re.split(r"[ \t\n\x0b\f\r]+", line)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def clean(word):
    return re.sub("[^a-z]", "", word.lower())


def grams(line, n, empty=None):
    words = [clean(w) for w in java_split(line)]
    words = [w or empty for w in words]
    windows = [words[i : i + n] for i in range(len(words) - n + 1)]
    return [" ".join(w) for w in windows if None not in w]


def counted(df):
    return {r[0]: r[1] for r in df.collect()}


def test_word_counts_follow_the_split_rules(lines):
    want = Counter(w.lower() for line in LINES for w in java_split(line))
    assert counted(text.word_counts(lines)) == want
    assert want[""] == 2  # the empty line, and the blank before "a b"


@pytest.mark.parametrize("n", [1, 2, 3])
@pytest.mark.parametrize("empty", [None, "null"])
def test_ngrams(lines, n, empty):
    want = Counter(g for line in LINES for g in grams(line, n, empty))
    assert counted(text.ngram_counts(lines, n, empty)) == want


def test_empty_token_by_name(spark):
    one = spark.createDataFrame([("Hello -- World",)], "line string")
    assert counted(text.ngram_counts(one, 2)) == {}
    assert counted(text.ngram_counts(one, 2, "null")) == {"hello null": 1, "null world": 1}


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aB-é \t7", max_size=30), min_size=1, max_size=20))
def test_ngrams_of_any_line(spark, drawn):
    df = spark.createDataFrame([(line,) for line in drawn], "line string")
    want = Counter(g for line in drawn for g in grams(line, 2))
    assert counted(text.ngram_counts(df, 2)) == want


def test_bad_arguments():
    with pytest.raises(ValueError):
        tx.ngrams(F.lit("x"), 0)
    with pytest.raises(ValueError):
        tx.ngrams(F.lit("x"), 2, "no word")


def test_prefix_words_and_counters(spark, rows):
    df = spark.createDataFrame([("  Home sweet 42",), ("away",)], "line string")
    seen = Observation()
    assert counted(text.prefix_word_counts(df, "ho", observation=seen)) == {
        "home": 1,
        "sweet": 1,
        "": 1,
    }
    assert seen.get == {"selected_words": 3, "unselected_words": 1}
    assert rows(text.prefix_counters(df, "ho")) == [(3, 1)]
    assert counted(text.prefix_word_counts(df, "ho", drop_empty=True)) == {"home": 1, "sweet": 1}
    # the prefix is not lower-cased
    assert counted(text.prefix_word_counts(df, "HO")) == {}
    assert rows(text.prefix_counters(df, "HO")) == [(0, 4)]


def test_counters_add_up_to_all_words(lines):
    got = text.prefix_counters(lines, "a").first()
    words = sum(len(java_split(line.strip())) for line in LINES)
    assert got.selected_words + got.unselected_words == words


def test_counters_of_nothing(lines, rows):
    assert rows(text.prefix_counters(lines.limit(0), "a")) == [(0, 0)]


def test_near_max(spark, rows):
    words = spark.createDataFrame(
        [("house", 10), ("home", 8), ("hope", 9), ("zoo", 99)], "word string, n int"
    )
    assert rows(text.near_max(words, "ho", 0.8)) == [("hope", 9), ("house", 10)]
    assert rows(text.near_max(words, "nothing")) == []


def both_ways(lines, prefix, drop_empty=False):
    counts, totals = text.prefix_words_and_totals(lines, prefix, drop_empty)
    return counted(counts), totals.first().asDict()


@pytest.mark.parametrize("prefix", ["a", "hello", "", "A", "zz"])
@pytest.mark.parametrize("drop_empty", [False, True])
def test_words_and_totals_of_one_pass(lines, prefix, drop_empty):
    counts, totals = both_ways(lines, prefix, drop_empty)
    assert counts == counted(text.prefix_word_counts(lines, prefix, drop_empty))
    assert totals == text.prefix_counters(lines, prefix).first().asDict()


def test_words_and_totals_of_nothing(lines):
    assert both_ways(lines.limit(0), "a") == ({}, {"selected_words": 0, "unselected_words": 0})


RUN_TWICE = """
import json, sys
from pyspark import TaskContext
from pyspark.sql import Observation, SparkSession
from batchkit.operators import text

spark = (
    SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", sys.argv[1]).getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")
lines = spark.range(0, 90, 1, 3).selectExpr("concat(if(id % 3 = 0, 'the ', 'a '), 'x', id % 7) AS line")

def fail_once(batches):
    yield from batches
    # all rows of the task have been handed on, and counted there
    if TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() == 1:
        raise RuntimeError("lost")

counts, totals = text.prefix_words_and_totals(lines.mapInArrow(fail_once, "line string"), "the")
print(json.dumps([{r.word: r.n for r in counts.collect()}, totals.first().asDict()]))
"""


def test_a_task_that_runs_twice_counts_once(tmp_path):
    """In a session of its own, as tasks are tried again only where the master allows it."""
    root = str(Path(__file__).resolve().parents[1])
    done = subprocess.run(
        [sys.executable, "-c", RUN_TWICE, str(tmp_path)], capture_output=True, text=True, timeout=300,
        env=os.environ | {"PYTHONPATH": root}, check=True,
    )
    counts, totals = json.loads(done.stdout.strip().splitlines()[-1])
    assert counts == {"the": 30, "x": 30}
    assert totals == {"selected_words": 60, "unselected_words": 120}
