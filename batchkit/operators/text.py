"""Word and n-gram counting over a ``line`` column.

Every count is one ``groupBy``: Spark combines equal words inside each task before the
shuffle, so a word that makes up a third of the text still sends one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from batchkit.functions import text as tx
from batchkit.operators.staging import Stage


def _count(words: DataFrame) -> DataFrame:
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_counts(lines: DataFrame, column: str = "line") -> DataFrame:
    """Lower-case, white-space separated words and how often each occurs."""
    return _count(lines.select(F.explode(tx.tokens(F.col(column))).alias("word")))


def ngram_counts(
    lines: DataFrame, n: int = 1, empty_token: str | None = None, column: str = "line"
) -> DataFrame:
    """n-grams of cleaned words within a line and how often each occurs."""
    grams = tx.ngrams(F.col(column), n, empty_token)
    return (
        lines.select(F.explode(grams).alias("ngram"))
        .groupBy("ngram")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _stripped(lines: DataFrame, column: str) -> DataFrame:
    return lines.select(tx.strip(F.lower(F.col(column))).alias("body"))


def prefix_word_counts(
    lines: DataFrame,
    prefix: str,
    drop_empty: bool = False,
    observation: Observation | None = None,
    column: str = "line",
) -> DataFrame:
    """Count the cleaned words of the lines that begin with ``prefix``.

    Lines are lower-cased, the prefix is not: an upper-case prefix selects nothing. A word
    without letters counts as the empty word unless ``drop_empty`` is set. With an
    ``observation`` the totals of ``prefix_counters`` are collected by the same pass; a task that runs twice
    may count twice in them (``prefix_words_and_totals`` counts once).
    """
    body = _stripped(lines, column)
    if observation is not None:
        body = body.observe(observation, *_counters(prefix))
    words = body.filter(F.col("body").startswith(prefix)).select(
        F.explode(tx.clean_tokens(F.col("body"))).alias("word")
    )
    return _count(words.filter("word <> ''") if drop_empty else words)


def _counters(prefix: str):
    size = F.size(F.split("body", r"\s+"))
    selected = F.col("body").startswith(prefix)
    zero = F.lit(0).cast("bigint")
    return (
        F.coalesce(F.sum(F.when(selected, size)), zero).alias("selected_words"),
        F.coalesce(F.sum(F.when(~selected, size)), zero).alias("unselected_words"),
    )


def prefix_counters(lines: DataFrame, prefix: str, column: str = "line") -> DataFrame:
    """One row: words on the lines that begin with ``prefix``, and words on the others."""
    return _stripped(lines, column).agg(*_counters(prefix))


def prefix_words_and_totals(
    lines: DataFrame, prefix: str, drop_empty: bool = False, column: str = "line"
) -> tuple[DataFrame, DataFrame]:
    """``prefix_word_counts`` and ``prefix_counters`` of one pass over the lines, both exact.

    Each line hands on its words and its number of words, marked by kind, and one aggregate combines
    all of them: in each task before the shuffle, then by kind and word. What a task that failed had
    counted is not in the shuffle, so a task that runs twice counts once. The result is written by a job
    that runs at once, each task committing its words and its share of the totals together; both
    tables are read from the committed files.
    """
    body = _stripped(lines, column)
    chosen = F.col("body").startswith(prefix)
    size = F.size(F.split("body", r"\s+")).cast("bigint")

    def row(kind, word, n):
        return F.struct(kind.alias("kind"), word.alias("word"), n.cast("bigint").alias("n"))

    one = F.lit(1)
    words = F.transform(tx.clean_tokens(F.col("body")), lambda w: row(F.lit("word"), w, one))
    kind = F.when(chosen, "selected").otherwise("unselected")
    total = F.array(row(kind, F.lit(None).cast("string"), size))
    rows = body.select(
        F.explode(F.when(chosen, F.concat(words, total)).otherwise(total)).alias("_row")
    ).select("_row.*")
    with Stage(lines.sparkSession) as stage:
        counted = stage.put(rows.groupBy("kind", "word").agg(F.sum("n").alias("n")), "counted")
    counts = counted.filter("kind = 'word'").select("word", "n")
    zero = F.lit(0).cast("bigint")
    totals = counted.filter("kind <> 'word'").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), zero).alias(f"{k}_words")
            for k in ("selected", "unselected")
        ]
    )
    return counts.filter("word <> ''") if drop_empty else counts, totals


def near_max(
    counts: DataFrame, prefix: str, fraction: float = 0.8, word: str = "word", freq: str = "n"
) -> DataFrame:
    """Words with ``prefix`` whose frequency is above ``fraction`` of the largest among them.

    The largest frequency is a scalar subquery of the same plan: nothing goes through the
    driver, and both uses of ``counts`` read one shuffle.
    """
    chosen = counts.filter(F.col(word).startswith(prefix))
    largest = chosen.select(F.max(freq)).scalar()
    return chosen.filter(F.col(freq) > largest * F.lit(fraction))
