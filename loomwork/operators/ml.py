"""Training and comparing standard classifiers on a labelled feature table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    NaiveBayes,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = 42


def logistic(max_iter: int = 10, reg: float = 0.3, elastic_net: float = 0.8) -> Estimator:
    return LogisticRegression(maxIter=max_iter, regParam=reg, elasticNetParam=elastic_net)


def gbt() -> Estimator:
    return GBTClassifier(seed=SEED)


def random_forest(impurity: str = "variance", depth: int = 5, bins: int = 32) -> Estimator:
    return RandomForestRegressor(impurity=impurity, maxDepth=depth, maxBins=bins, seed=SEED)


def decision_tree(impurity: str = "gini", depth: int = 7, bins: int = 32) -> Estimator:
    return DecisionTreeClassifier(impurity=impurity, maxDepth=depth, maxBins=bins, seed=SEED)


def naive_bayes() -> Estimator:
    return NaiveBayes()


MODELS: dict[str, Callable[[], Estimator]] = {
    "naive_bayes": naive_bayes,
    "tree_gini": lambda: decision_tree("gini"),
    "tree_entropy": lambda: decision_tree("entropy"),
    "random_forest": random_forest,
    "gbt": gbt,
    "logistic": logistic,
}

#: Trees of one split, which can be found exactly by counting.
STUMPS: dict[str, Callable[[], Estimator]] = {
    f"stump_{impurity}": lambda impurity=impurity: decision_tree(impurity, depth=1) for impurity in ("gini", "entropy")
}

PLACES = 10_000


def hash_place(*row_id: str) -> Column:
    """A place in ``0..PLACES-1`` that follows from the row's id alone."""
    return F.pmod(F.xxhash64(*row_id), F.lit(PLACES))


def split(df: DataFrame, fraction: float, place: Column) -> tuple[DataFrame, DataFrame]:
    """The first part, of about ``fraction`` of the places, trains; the second tests."""
    first = place < int(fraction * PLACES)
    return df.where(first), df.where(~first)


def evaluate(model: Model, test: DataFrame) -> tuple[str, float]:
    """Accuracy on the test rows, or root mean square error for a regressor."""
    if isinstance(model, RandomForestRegressionModel):
        return "rmse", RegressionEvaluator(metricName="rmse").evaluate(model.transform(test))
    scorer = MulticlassClassificationEvaluator(metricName="accuracy")
    return "accuracy", scorer.evaluate(model.transform(test))


def baseline(train: DataFrame, test: DataFrame) -> dict[str, float]:
    """What needs no model: accuracy of the training rows' commonest label (the smaller of two),
    and error of their mean."""
    labels = train.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    common, mean = labels.agg(
        F.max_by("label", F.struct("n", -F.col("label"))), F.sum(F.col("label") * F.col("n")) / F.sum("n")
    ).first()
    found = test.agg(
        F.avg((F.col("label") == common).cast("double")), F.sqrt(F.avg(F.pow(F.col("label") - mean, F.lit(2))))
    ).first()
    return dict(zip(("accuracy", "rmse"), found))


def compare(
    df: DataFrame, place: Column, fraction: float = 0.7, models: Sequence[str] = tuple(MODELS)
) -> DataFrame:
    """A row per model: ``model, metric, value, n_train, n_test, baseline, beats_baseline``.

    The input has ``label``, ``features`` and what ``place`` is computed from.
    Both parts are cached across the models; a lost cache block is recomputed.
    A model beats the baseline if it is right more often, or has a smaller error.
    """
    train, test = (part.select("label", "features").cache() for part in split(df, fraction, place))
    try:
        n_train, n_test, plain = train.count(), test.count(), baseline(train, test)
        rows = []
        for name in models:
            metric, value = evaluate({**MODELS, **STUMPS}[name]().fit(train), test)
            better = value > plain[metric] if metric == "accuracy" else value < plain[metric]
            rows.append((name, metric, value, n_train, n_test, plain[metric], better))
    finally:
        train.unpersist()
        test.unpersist()
    return df.sparkSession.createDataFrame(
        rows,
        "model string, metric string, value double, n_train long, n_test long, baseline double, beats_baseline boolean",
    )


def tree_text(model: Model) -> str:
    """The rules of a fitted tree or forest."""
    return model.toDebugString
