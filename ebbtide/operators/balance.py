"""Class weights and reproducible splits."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.columns import hash_number
from ebbtide.operators.customers import LABEL, PERSON

WEIGHT = "weight"


class ClassWeights(NamedTuple):
    churned: float
    stayed: float


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """One row: rows per class and the balancing weight ``total / (2 * rows of the class)``.

    A class without rows has a null weight.
    """
    churned = F.coalesce(F.sum((F.col(label) == 1).cast("bigint")), F.lit(0))
    counted = df.agg(F.count("*").alias("total"), churned.alias("churned_rows"))
    counted = counted.withColumn("stayed_rows", F.col("total") - F.col("churned_rows"))
    return counted.select(
        "total",
        "churned_rows",
        "stayed_rows",
        *(
            F.try_divide(F.col("total").cast("double"), 2 * F.col(f"{name}_rows")).alias(f"{name}_weight")
            for name in ClassWeights._fields
        ),
    )


def fitted_class_weights(df: DataFrame, label: str = LABEL) -> ClassWeights:
    """The two weights as numbers; both classes must occur."""
    row = class_weights(df, label).first()
    if not row["churned_rows"] or not row["stayed_rows"]:
        raise ValueError(
            f"both classes are needed to weigh them, found {row['churned_rows']} churned "
            f"and {row['stayed_rows']} staying rows"
        )
    return ClassWeights(row["churned_weight"], row["stayed_weight"])


def with_class_weight(df: DataFrame, weights: ClassWeights, label: str = LABEL) -> DataFrame:
    """Add the weight of each row's class."""
    chosen = F.when(F.col(label) == 1, F.lit(weights.churned)).otherwise(F.lit(weights.stayed))
    return df.withColumn(WEIGHT, chosen)


def hash_split(df: DataFrame, share: float, key: str = PERSON) -> tuple[DataFrame, DataFrame]:
    """Two disjoint parts, the first with about ``share`` of the keys.

    A row's part depends on its key alone, so it stays the same for every run, order and
    partitioning of the data, and rows of one person are never separated.
    """
    if not 0 < share < 1:
        raise ValueError("share must lie between 0 and 1")
    inside = F.coalesce(hash_number(key), F.lit(0)) < F.lit(share * 2.0**32)
    return df.filter(inside), df.filter(~inside)


def random_split(df: DataFrame, share: float, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Spark's own split; which rows it picks depends on partitioning and row order."""
    first, second = df.randomSplit([share, 1 - share], seed=seed)
    return first, second
