import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from batchkit.operators import classify


def judged(spark, cells):
    rows = [(float(a), float(p)) for (a, p), n in cells.items() for _ in range(n)]
    return spark.createDataFrame(rows, "label double, prediction double")


def test_with_label(spark, rows):
    df = spark.createDataFrame(
        [(9, 10, "t"), (10, 10, "t"), (0, 0, "t"), (1, 1, None)], "num int, den int, text string"
    )
    got = classify.with_label(df, "num", "den", required=("text",))
    assert rows(got.select("num", "label")) == [(10, 1), (9, 0)]


@pytest.mark.parametrize(
    "cells",
    [
        {(1, 1): 5, (1, 0): 3, (0, 1): 2, (0, 0): 7},
        {(1, 0): 4, (0, 0): 3},
        {(1, 1): 2},
        {(0, 0): 1, (1, 1): 1, (2, 1): 3, (2, 2): 2},
    ],
)
def test_metrics_agree_with_the_evaluator(spark, cells):
    df = judged(spark, cells)
    got = classify.metrics(df).first()
    for name, ours in [
        ("accuracy", got.accuracy),
        ("f1", got.f1),
        ("weightedRecall", got.weighted_recall),
        ("weightedPrecision", got.weighted_precision),
    ]:
        evaluator = MulticlassClassificationEvaluator(metricName=name)
        assert ours == pytest.approx(evaluator.evaluate(df)), name


def test_confusion_matrix_and_scores(spark, rows):
    df = judged(spark, {(1, 1): 6, (1, 0): 2, (0, 1): 3, (0, 0): 1})
    assert rows(classify.confusion_matrix(df)) == [(0, 0, 1), (0, 1, 3), (1, 0, 2), (1, 1, 6)]
    assert rows(classify.per_class(df)) == [(0, 1 / 3, 1 / 4), (1, 6 / 9, 6 / 8)]


def test_undefined_scores_are_null(spark, rows):
    assert rows(classify.per_class(judged(spark, {(1, 0): 2, (0, 0): 2}))) == [
        (0, 0.5, 1.0),
        (1, None, 0.0),
    ]
    nothing = judged(spark, {(1, 1): 1}).limit(0)
    assert rows(classify.per_class(nothing)) == [(0, None, None), (1, None, None)]
    assert rows(classify.confusion_matrix(nothing)) == [(0, 0, 0), (0, 1, 0), (1, 0, 0), (1, 1, 0)]


def test_split_by_key_does_not_depend_on_partitions(spark, rows):
    df = spark.range(2000)
    train, test = classify.split(df, "id")
    again, _ = classify.split(df.repartition(7), "id")
    assert rows(train) == rows(again)
    assert train.count() + test.count() == 2000
    assert 1400 < train.count() < 1600
    first, second = classify.split_random(df)
    assert first.count() + second.count() == 2000


def test_words_are_those_of_the_ml_stages(spark):
    texts = ["The  Quick fox,\tisn't here ", "", "a an", " leading", "Ünder the sky"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    words = Tokenizer(inputCol="t", outputCol="w").transform(df)
    kept = StopWordsRemover(inputCol="w", outputCol="k").transform(words)
    both = kept.select("k", classify.kept_words(F.col("t")).alias("own")).collect()
    assert all(r.k == r.own for r in both)


def test_it_learns_a_word(spark):
    rows = [
        (i, f"the {'good' if i % 2 else 'bad'} thing number{i % 7}", f"note {i % 3}", i % 5, i % 2)
        for i in range(200)
    ]
    df = spark.createDataFrame(rows, "id int, text string, summary string, score int, label int")
    model, predictions = classify.fit_predict(df, {"text": 100, "summary": 50}, "id", ("score",))
    # score, two lengths and the hashed words
    assert model.stages[-1].numFeatures == 153
    assert predictions.count() == classify.split(df, "id")[1].count()
    scores = classify.metrics(predictions).first()
    assert scores.accuracy == 1.0
    pairs = predictions.select(F.col("label").cast("double"), "prediction")
    for name, own in (("accuracy", scores.accuracy), ("f1", scores.f1)):
        assert own == pytest.approx(MulticlassClassificationEvaluator(metricName=name).evaluate(pairs))


def test_the_regression_reaches_the_optimum(spark):
    """The regularised loss of the fitted model against Newton steps on the same features."""
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(12)]
    rows = []
    for i in range(400):
        chosen = rng.choice(words, 6)
        score = float(rng.normal())
        lean = sum(w in ("w1", "w2") for w in chosen) - sum(w == "w3" for w in chosen) + 0.5 * score
        rows.append((i, " ".join(chosen), "s", score, int(lean + rng.normal() > 0.7)))
    df = spark.createDataFrame(rows, "id int, text string, summary string, score double, label int")
    texts, reg = {"text": 16, "summary": 4}, 0.01
    model, _ = classify.fit_predict(df, texts, "id", ("score",), max_iter=500, reg_param=reg)
    encoded = classify.encode(df, texts, ["id", "label"], ("score",))
    train, _ = classify.split(encoded, "id")
    got = model.transform(train).select("features", "label").collect()
    x = np.array([r.features.toArray() for r in got])
    y = np.array([r.label for r in got], float)
    spread = x.std(axis=0, ddof=1)
    used = spread > 0
    z = x[:, used] / spread[used]  # the penalty is on coefficients of features of unit deviation

    def loss(w, b):
        margin = z @ w + b
        return np.mean(np.logaddexp(0, margin) - y * margin) + reg / 2 * (w @ w)

    w, b = np.zeros(z.shape[1]), 0.0
    design = np.column_stack([z, np.ones(len(z))])
    penalty = np.diag([reg] * z.shape[1] + [0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-(z @ w + b)))
        gradient = design.T @ (p - y) / len(y) + penalty @ np.append(w, b)
        hessian = (design * (p * (1 - p))[:, None]).T @ design / len(y) + penalty
        step = np.linalg.solve(hessian + 1e-12 * np.eye(len(hessian)), gradient)
        w, b = w - step[:-1], b - step[-1]
    regression = model.stages[-1]
    fitted = loss(regression.coefficients.toArray()[used] * spread[used], regression.intercept)
    assert loss(w, b) <= fitted + 1e-9
    assert fitted - loss(w, b) < 1e-3
    assert loss(np.zeros(len(w)), 0.0) - fitted > 0.05


def test_metrics_of_real_predictions(spark):
    """All measures from the predictions of a fitted model, counted again by hand."""
    rng = np.random.default_rng(3)
    rows = [
        (i, " ".join(rng.choice(["good", "bad", "so", "plain"], 3)), "s", int(rng.random() < 0.5))
        for i in range(300)
    ]
    rows = [(i, t, s, int("good" in t) if i % 5 else label) for i, t, s, label in rows]
    df = spark.createDataFrame(rows, "id int, text string, summary string, label int")
    _, predictions = classify.fit_predict(df, {"text": 32, "summary": 4}, "id")
    pairs = [(int(r.label), int(r.prediction)) for r in predictions.collect()]
    n = len(pairs)
    f1 = recall = precision = 0.0
    for c in (0, 1):
        actual, told = sum(a == c for a, _ in pairs), sum(p == c for _, p in pairs)
        hits = sum(a == p == c for a, p in pairs)
        r, q = hits / actual if actual else 0.0, hits / told if told else 0.0
        recall, precision = recall + actual / n * r, precision + actual / n * q
        f1 += actual / n * (2 * q * r / (q + r) if q + r else 0.0)
    got = classify.metrics(predictions).first()
    want = (sum(a == p for a, p in pairs) / n, f1, recall, precision)
    assert (got.accuracy, got.f1, got.weighted_recall, got.weighted_precision) == pytest.approx(want)
    cells = {(r[0], r[1]): r[2] for r in classify.confusion_matrix(predictions).collect()}
    assert cells == {(a, p): pairs.count((a, p)) for a in (0, 1) for p in (0, 1)}
