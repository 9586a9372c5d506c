"""Scoring people with a fitted model, and the report of those at risk."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.operators.customers import FEATURES, PERSON

# The two risk labels.
HIGH_RISK = "🔴 HIGH RISK"
LOW_RISK = "🟢 LOW RISK"


def churn_probability(probability: str = "probability") -> Column:
    """Probability of class 1 from a model's probability vector."""
    return vector_to_array(F.col(probability))[1]


def risk_status(prediction: str = "prediction") -> Column:
    return F.when(F.col(prediction) == 1, HIGH_RISK).otherwise(LOW_RISK)


def score(model: Model, features: DataFrame) -> DataFrame:
    """All rows with the model's columns, the churn probability and the risk label."""
    scored = model.transform(features)
    return scored.withColumn("churn_probability", churn_probability()).withColumn("risk_status", risk_status())


def churn_report(scored: DataFrame) -> DataFrame:
    """Predicted churners, most probable first.

    The order is by the probability of churning; ordering the vector itself would compare the
    probability of staying first. The key breaks ties, also between the ranges of the sort, so
    many equal probabilities do not end up in one task.
    """
    report = scored.filter(F.col("prediction") == 1).select(
        PERSON, *FEATURES, "probability", "risk_status", "churn_probability"
    )
    return report.orderBy(F.col("churn_probability").desc(), PERSON)
