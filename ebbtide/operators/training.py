"""Fitting classifiers on the feature table and measuring them on held-out people."""

from __future__ import annotations

import time
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.operators import balance, evaluate, registry
from ebbtide.operators.customers import LABEL, PERSON

# The features used when none are named.
DEFAULT_FEATURES = ["recency", "frequency", "monetary"]


@dataclass(frozen=True)
class TrainedRun:
    run_id: str
    model: PipelineModel
    metrics: dict[str, float]
    rows: list[tuple]


@contextmanager
def kept(*frames: DataFrame):
    """Keep frames that are read many times; a lost executor's share is computed again."""
    for frame in frames:
        frame.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield frames
    finally:
        for frame in frames:
            frame.unpersist()


def assembler(feature_cols: Sequence[str] | None = None) -> VectorAssembler:
    return VectorAssembler(inputCols=list(feature_cols or DEFAULT_FEATURES), outputCol="features")


def pipeline(estimator: Estimator, feature_cols: Sequence[str] | None = None) -> Pipeline:
    return Pipeline(stages=[assembler(feature_cols), estimator])


def baselines() -> dict[str, Estimator]:
    """The three class-weighted models that every search is compared with."""
    roles = {"labelCol": LABEL, "featuresCol": "features", "weightCol": balance.WEIGHT}
    # The hyperparameters of the baselines.
    return {
        "RF_Baseline": RandomForestClassifier(**roles, numTrees=50, maxDepth=5, seed=42),
        "GBT_Baseline": GBTClassifier(**roles, maxIter=20, maxDepth=5, seed=42),
        "LogisticReg_Baseline": LogisticRegression(**roles, regParam=0.01, elasticNetParam=1.0),
    }


def weighted(df: DataFrame, based_on: DataFrame | None = None) -> DataFrame:
    """``df`` with class weights, unless it has them; they come from ``based_on`` or ``df``."""
    if balance.WEIGHT in df.columns:
        return df
    return balance.with_class_weight(df, balance.fitted_class_weights(df if based_on is None else based_on))


def quality(predictions: DataFrame, label: str = LABEL) -> dict[str, float]:
    """Accuracy, area under the ROC curve, weighted precision and recall, and F1.

    The predictions are computed once, down to counts per label, prediction and score; every
    metric follows from those.
    """
    counts = predictions.groupBy(
        F.col(label), "prediction", vector_to_array("rawPrediction")[1].alias("score")
    ).agg(F.count("*").alias("rows"))
    with kept(counts):
        ranking = evaluate.auc_roc(counts, label, "score", "rows").first()
        decisions = evaluate.classification_metrics(counts, label, "prediction", "rows").first()
    values = (
        decisions["accuracy"],
        ranking["auc_roc"],
        decisions["weighted_precision"],
        decisions["weighted_recall"],
        decisions["f1"],
    )
    return dict(zip(registry.QUALITY_METRICS, values))


def train(
    df: DataFrame,
    estimator: Estimator,
    run_name: str | None = None,
    feature_cols: Sequence[str] | None = None,
    split: str = "hash",
) -> TrainedRun:
    """Fit ``estimator`` on 70 % of the people and measure it on the others.

    ``split="hash"`` assigns people by their key, ``"random"`` uses Spark's seeded split. Without
    a weight column in ``df``, class weights come from the training part.
    """
    wanted = list(dict.fromkeys([PERSON, *(feature_cols or DEFAULT_FEATURES), LABEL]))
    wanted += [balance.WEIGHT] if balance.WEIGHT in df.columns else []
    halves = balance.hash_split if split == "hash" else balance.random_split
    train_part, test_part = halves(df.select(*wanted), 0.7)

    return train_on(train_part, test_part, estimator, run_name, feature_cols)


def train_on(
    train_part: DataFrame,
    test_part: DataFrame,
    estimator: Estimator,
    run_name: str | None = None,
    feature_cols: Sequence[str] | None = None,
) -> TrainedRun:
    """Fit ``estimator`` on one part and measure it on the other."""
    algorithm = type(estimator).__name__
    run_name = run_name or algorithm
    with kept(train_part, test_part):
        started = time.perf_counter()
        model = pipeline(estimator, feature_cols).fit(weighted(train_part))
        train_seconds = time.perf_counter() - started
        speed = evaluate.throughput(model, test_part)
        metrics = quality(model.transform(test_part))
    metrics |= dict(zip(registry.SPEED_METRICS, (train_seconds, speed.seconds, speed.rows_per_second)))

    run_id = registry.new_run_id()
    params = {param.name: value for param, value in estimator.extractParamMap().items()}
    rows = registry.run_rows(run_id, run_name, params, metrics, {"algorithm": algorithm})
    return TrainedRun(run_id, model, metrics, rows)
