"""Binary text classification: labels, features, model and scores."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import IDF, HashingTF, IDFModel, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from batchkit.functions.text import STOP_WORDS
from batchkit.operators.staging import Stage


def with_label(
    df: DataFrame, numerator: str, denominator: str, cut: float = 0.9, required: tuple[str, ...] = ()
) -> DataFrame:
    """Keep rated rows (denominator above 0) and label them 1 where the ratio exceeds ``cut``.

    Rows with NULL in a ``required`` column are dropped.
    """
    ratio = F.try_divide(F.col(numerator), F.col(denominator))
    rated = df.filter(F.col(denominator) > 0).withColumn(
        "label", F.when(ratio > cut, 1).otherwise(0)
    )
    return rated.dropna(subset=list(required)) if required else rated


def in_training(key: Column, train: float = 0.75, seed: int = 10) -> Column:
    """Whether a row with this key is a training row: the start of an md5, as a share of all."""
    digits = F.substring(F.md5(F.concat_ws(":", key.cast("string"), F.lit(seed))), 1, 8)
    return F.conv(digits, 16, 10).cast("long") < F.lit(int(train * 2**32))


def split(
    df: DataFrame, key: str, train: float = 0.75, seed: int = 10
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows. A row's side depends on the key alone and never changes."""
    side = in_training(F.col(key), train, seed)
    return df.filter(side), df.filter(~side)


def split_random(df: DataFrame, train: float = 0.75, seed: int = 10) -> tuple[DataFrame, DataFrame]:
    """``randomSplit``: the sides depend on how rows are partitioned, and overlap if that changes."""
    first, second = df.randomSplit([train, 1 - train], seed)
    return first, second


def kept_words(column: Column) -> Column:
    """Lower-case words of a text, without English stop words. Blanks in a row hold empty words."""
    words = F.split(F.regexp_replace(F.lower(column), r"\s+$", ""), r"\s")
    return F.filter(words, lambda word: ~word.isin(*STOP_WORDS))


def encode(
    df: DataFrame, texts: dict[str, int], keep: list[str], numeric: tuple[str, ...] = ()
) -> DataFrame:
    """``keep`` and ``numeric`` columns, and of each text its length, words kept and hashed counts.

    This is the only step that reads a text. What comes out is small: ``<text>_length``,
    ``<text>_words`` and a sparse vector ``<text>_counts`` with the size that ``texts`` names.
    """
    made = df.select(
        *keep,
        *numeric,
        *[kept_words(F.col(t)).alias(t) for t in texts],
        *[F.length(t).alias(f"{t}_length") for t in texts],
    )
    for column, size in texts.items():
        made = HashingTF(inputCol=column, outputCol=f"{column}_counts", numFeatures=size).transform(made)
        made = made.withColumn(f"{column}_words", F.size(column))
    return made.drop(*texts)


def fit_weights(train: DataFrame, texts: dict[str, int]) -> list[IDFModel]:
    """Inverse document frequencies of the hashed words of each text, over encoded training rows."""
    return [
        IDF(inputCol=f"{t}_counts", outputCol=f"{t}_weights").fit(train.select(f"{t}_counts"))
        for t in texts
    ]


def weight_rows(train: DataFrame, texts: dict[str, int]) -> DataFrame:
    """``text``, ``place``, ``documents`` and ``weight`` of every place that a word is hashed to.

    The weight is ln((n + 1) / (documents + 1)) with n rows in all. A text has as many places as ``texts``
    says, so the rows are bounded by that, whatever the input.
    """
    rows = [
        (t, place, int(n), float(weight))
        for t, model in zip(texts, fit_weights(train, texts), strict=True)
        for place, (n, weight) in enumerate(zip(model.docFreq, model.idf.toArray(), strict=True))
    ]
    return train.sparkSession.createDataFrame(
        rows, "text string, place int, documents long, weight double"
    )


def fit_predict(
    df: DataFrame,
    texts: dict[str, int],
    key: str,
    numeric: tuple[str, ...] = (),
    label: str = "label",
    max_iter: int = 10,
    reg_param: float = 0.01,
) -> tuple[PipelineModel, DataFrame]:
    """Fit a logistic regression on the training rows of ``df`` and predict its test rows.

    The encoded rows are written once; weighting by inverse document frequency, the regression and
    the prediction all read them. Runs jobs at once. Persist the predictions if used repeatedly.

    The regression is saved and loaded again. A freshly fitted one carries its training
    summary and with it the session, which cannot be sent to the tasks once the session has
    observed any metrics.
    """
    stage = Stage(df.sparkSession)
    encoded = stage.put(encode(df, texts, [key, label], numeric), "encoded")
    train, test = split(encoded, key)
    weights = fit_weights(train, texts)
    inputs = [*numeric, *(f"{t}_{part}" for t in texts for part in ("length", "weights"))]
    features = PipelineModel([*weights, VectorAssembler(inputCols=inputs, outputCol="features")])
    regression = LogisticRegression(
        featuresCol="features", labelCol=label, maxIter=max_iter, regParam=reg_param
    ).fit(features.transform(train).select(label, "features"))
    path = stage.path("regression")
    regression.write().save(path)
    model = PipelineModel([*features.stages, LogisticRegressionModel.load(path)])
    stage.remove("regression")
    return model, model.transform(test)


def _per_class_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Per class: actual, predicted and correctly predicted rows; one row per class seen.

    Rows are counted per (label, prediction) first, so only a handful go any further.
    """
    cells = df.groupBy(
        F.col(label).cast("double").alias("_label"),
        F.col(prediction).cast("double").alias("_prediction"),
    ).agg(F.count(F.lit(1)).alias("_n"))
    hit = F.when(F.col("_label") == F.col("_prediction"), F.col("_n")).otherwise(0)
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(
                    F.col("_label").alias("label"),
                    F.col("_n").alias("actual"),
                    F.lit(0).cast("bigint").alias("predicted"),
                    hit.alias("correct"),
                ),
                F.struct(
                    F.col("_prediction").alias("label"),
                    F.lit(0).cast("bigint").alias("actual"),
                    F.col("_n").alias("predicted"),
                    F.lit(0).cast("bigint").alias("correct"),
                ),
            )
        ).alias("_side")
    ).select("_side.*")
    return sides.groupBy("label").agg(
        *[F.sum(c).alias(c) for c in ("actual", "predicted", "correct")]
    )


def metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: accuracy, F1, weighted recall and weighted precision.

    Classes weigh by their share of the actual labels; an undefined precision counts as 0.
    """
    recall = F.coalesce(F.try_divide("correct", "actual"), F.lit(0.0))
    precision = F.coalesce(F.try_divide("correct", "predicted"), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    classes = _per_class_counts(df, label, prediction)

    def weighted(score):
        return F.try_divide(F.sum(score * F.col("actual")), F.sum("actual"))

    return classes.agg(
        F.try_divide(F.sum("correct"), F.sum("actual")).alias("accuracy"),
        weighted(f1).alias("f1"),
        weighted(recall).alias("weighted_recall"),
        weighted(precision).alias("weighted_precision"),
    )


def confusion_matrix(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """The four cells of a 0/1 classifier as rows ``label, prediction, n``, empty ones as 0."""
    def cell(actual: int, predicted: int):
        return F.count_if((F.col(label) == actual) & (F.col(prediction) == predicted))

    order = [(1, 1), (1, 0), (0, 1), (0, 0)]
    counted = df.agg(*[cell(a, p).alias(f"c{a}{p}") for a, p in order])
    rows = F.array(
        *[
            F.struct(
                F.lit(a).alias("label"), F.lit(p).alias("prediction"), F.col(f"c{a}{p}").alias("n")
            )
            for a, p in order
        ]
    )
    return counted.select(F.inline(rows))


def per_class(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision and recall of classes 0 and 1, NULL where undefined."""
    cells = confusion_matrix(df, label, prediction)
    sides = cells.select(
        "label", "prediction", "n", F.explode(F.array(F.lit(1), F.lit(0))).alias("class")
    )
    is_label, is_prediction = F.col("label") == F.col("class"), F.col("prediction") == F.col("class")
    correct = F.sum(F.when(is_label & is_prediction, F.col("n")).otherwise(0))
    predicted = F.sum(F.when(is_prediction, F.col("n")).otherwise(0))
    actual = F.sum(F.when(is_label, F.col("n")).otherwise(0))
    return sides.groupBy("class").agg(
        F.try_divide(correct, predicted).alias("precision"),
        F.try_divide(correct, actual).alias("recall"),
    )
