"""Quality of scored rows, computed from counts rather than from single rows."""

from __future__ import annotations

import time
from typing import NamedTuple

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.operators.customers import LABEL


class Throughput(NamedTuple):
    rows: int
    seconds: float
    rows_per_second: float


def _weight(rows: str | None) -> Column:
    return F.col(rows) if rows else F.lit(1).cast("bigint")


def auc_roc(
    df: DataFrame,
    label: str = LABEL,
    score: str = "score",
    rows: str | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Exact area under the ROC curve, one row: ``auc_roc``, ``positives``, ``negatives``.

    It is the share of (positive, negative) pairs in which the positive scores higher, ties
    counting one half. Equal scores are counted together first, so a score held by very many rows
    is one row. The distinct scores are then range-partitioned, which Spark balances by a sample when it runs, each
    range is ordered by itself, and one total per range is carried over to the next. Nothing runs before an action, and
    the cuts decide only the balance of the work, not the result.

    ``rows`` names a column with the number of rows each input row stands for; ``ranges`` sets the number of ranges,
    by default that of the session's shuffles. Without positives or without negatives the area is null.
    """
    value = F.col(score).cast("double")
    weight = _weight(rows)
    by_score = (
        df.groupBy(value.alias("score"))
        .agg(
            F.sum(F.when(F.col(label) == 1, weight).otherwise(0)).alias("pos"),
            F.sum(F.when(F.col(label) == 1, 0).otherwise(weight)).alias("neg"),
        )
        .filter(F.col("score").isNotNull())
    )
    ranged = by_score.repartitionByRange(*([ranges] if ranges else []), "score").withColumn("range", F.spark_partition_id())

    lower = Window.partitionBy("range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("neg").over(lower), F.lit(0))
    per_range = (
        ranged.withColumn("wins", F.col("pos").cast("double") * (below + F.col("neg") / 2))
        .groupBy("range")
        .agg(F.sum("wins").alias("wins"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    # One row per range from here on, so the one-partition window is bounded.
    lower_ranges = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.coalesce(F.sum("neg").over(lower_ranges), F.lit(0))
    wins = F.sum(F.col("wins") + F.col("pos").cast("double") * F.col("carried"))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return per_range.withColumn("carried", carried).agg(
        F.try_divide(wins, pairs).alias("auc_roc"),
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
    )


def classification_metrics(
    df: DataFrame,
    label: str = LABEL,
    prediction: str = "prediction",
    rows: str | None = None,
) -> DataFrame:
    """One row: accuracy, and precision, recall and F1 averaged over classes by their frequency.

    Everything follows from the confusion matrix, which is one aggregation over the data.
    """
    cells = df.groupBy(
        F.col(label).cast("double").alias("actual"), F.col(prediction).cast("double").alias("predicted")
    ).agg(F.sum(_weight(rows)).alias("n"))
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    none = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("actual").alias("class"), F.col("n").alias("support"), none.alias("claimed"), hit.alias("hits")),
        F.struct(F.col("predicted").alias("class"), none.alias("support"), F.col("n").alias("claimed"), none.alias("hits")),
    )
    per_class = (
        cells.select(F.inline(sides))
        .groupBy("class")
        .agg(*(F.sum(name).alias(name) for name in ("support", "claimed", "hits")))
        .withColumn("precision", F.coalesce(F.try_divide("hits", "claimed"), F.lit(0.0)))
        .withColumn("recall", F.coalesce(F.try_divide("hits", "support"), F.lit(0.0)))
    )
    f1 = F.coalesce(
        F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)
    )

    def averaged(value: Column) -> Column:
        return F.sum(value * F.col("support")) / F.sum("support")

    return per_class.agg(
        (F.sum("hits") / F.sum("support")).alias("accuracy"),
        averaged(F.col("precision")).alias("weighted_precision"),
        averaged(F.col("recall")).alias("weighted_recall"),
        averaged(f1).alias("f1"),
    )


def throughput(model: Model, df: DataFrame) -> Throughput:
    """Rows scored per second, with every output column really computed.

    The rows are counted apart from the timed pass: counting the scored rows would let Spark leave
    out the model's columns and measure a scan.
    """
    rows = df.count()
    started = time.perf_counter()
    model.transform(df).write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - started
    return Throughput(rows, seconds, rows / seconds)
