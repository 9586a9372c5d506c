"""Runs and models as tables: what was tried, how good it was, and which model serves a stage."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from typing import NamedTuple
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.sources.files import append_entry, claim, read_entries

RUNS_SCHEMA = (
    "run_id string, parent_id string, run_name string, kind string, name string, value string, logged_at timestamp"
)
REGISTRY_SCHEMA = (
    "model string, alias string, path string, input_schema string, output_schema string, "
    "sample_rows string, registered_at timestamp, version bigint"
)
#: The tag of a run that names its saved model.
MODEL_PATH = "model_path"
#: The tag of a trial that holds the number of its draw.
TRIAL = "trial"
# The quality and speed figures of a run.
QUALITY_METRICS = ["accuracy", "auc_roc", "precision", "recall", "f1_score"]
SPEED_METRICS = ["train_time_sec", "inference_time_sec", "throughput_rows_sec"]


def new_run_id() -> str:
    return uuid.uuid4().hex


def run_rows(
    run_id: str,
    run_name: str,
    params: Mapping[str, object] | None = None,
    metrics: Mapping[str, float] | None = None,
    tags: Mapping[str, str] | None = None,
    parent_id: str | None = None,
) -> list[tuple]:
    """The log entries of one run, one per parameter, metric and tag."""
    logged_at = datetime.now(timezone.utc)
    entries = (("param", params), ("metric", metrics), ("tag", tags))
    return [
        (run_id, parent_id, run_name, kind, name, None if value is None else str(value), logged_at)
        for kind, values in entries
        for name, value in (values or {}).items()
    ]


def runs_frame(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), RUNS_SCHEMA)


def log_runs(spark: SparkSession, path: str, rows: Sequence[tuple], fmt: str = "parquet") -> None:
    """Append log entries to the run table; several writers may do so at a time."""
    append_entry(runs_frame(spark, rows), path, fmt)


def read_runs(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The run table; none if nothing was logged yet."""
    try:
        return read_entries(spark, path, fmt)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in str(missing) or "UNABLE_TO_INFER_SCHEMA" in str(missing):
            return None
        raise


class LoggedTrial(NamedTuple):
    value: float
    seconds: float


def finished_trials(runs: DataFrame, run_id: str) -> dict[int, LoggedTrial]:
    """The trials of a search that have a value, by the number of their draw: a row per trial comes to the driver."""
    entries = runs.filter(F.col("parent_id") == run_id)

    def logged(name: str) -> Column:
        return F.max(F.when(F.col("name") == name, F.col("value")))

    names = (TRIAL, "status", "auc_val", "trial_duration")
    trials = entries.groupBy("run_id").agg(*(logged(name).alias(name) for name in names))
    done = trials.filter(F.col(TRIAL).isNotNull() & (F.col("status") == "finished")).collect()
    return {int(row[TRIAL]): LoggedTrial(float(row["auc_val"]), float(row["trial_duration"])) for row in done}


def leaderboard(
    runs: DataFrame, metrics: Sequence[str] = tuple(QUALITY_METRICS + SPEED_METRICS), by: str = "auc_roc"
) -> DataFrame:
    """One row per run with its metrics side by side, best first by ``by``. Nothing is promoted."""
    wide = (
        runs.filter((F.col("kind") == "metric") & F.col("name").isin(list(metrics)))
        .groupBy("run_id", "run_name")
        .pivot("name", list(metrics))
        .agg(F.max(F.col("value").cast("double")))
    )
    return wide.orderBy(F.col(by).desc_nulls_last(), "run_id")


def best_run(runs: DataFrame, metric: str = "auc_val", largest: bool = True) -> DataFrame:
    """The run with the best value of ``metric``; runs that failed logged none and cannot win."""
    found = runs.filter((F.col("kind") == "metric") & (F.col("name") == metric)).select(
        "run_id", "run_name", F.col("value").cast("double").alias(metric)
    )
    order = F.col(metric).desc() if largest else F.col(metric).asc()
    return found.filter(F.col(metric).isNotNull() & ~F.isnan(metric)).orderBy(order, "run_id").limit(1)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def register_model(
    registry_path: str,
    name: str,
    alias: str,
    model: PipelineModel,
    model_path: str,
    sample: DataFrame,
    feature_cols: Sequence[str],
    fmt: str = "parquet",
    expected: int | None = None,
) -> int:
    """Save ``model`` and point ``name@alias`` at it, with its signature and five input rows; returns the alias's version.

    Versions count up, and of several writers each gets one of its own, so the last one wins whatever their clocks say.
    With ``expected`` (0: none yet) the alias moves only if that is still its version; otherwise ``AliasMoved`` is raised
    and it stays as it is."""
    spark = sample.sparkSession
    version = _next_version(spark, registry_path, name, alias, fmt, expected)
    save_model(model, model_path)
    inputs = sample.select(*feature_cols)
    # Five rows of the feature columns: the size is fixed, whatever the table's.
    rows = [json.loads(text) for text in inputs.limit(5).toJSON().collect()]
    entry = (
        name,
        alias,
        model_path,
        inputs.schema.json(),
        model.transform(sample).schema.json(),
        json.dumps(rows),
        datetime.now(timezone.utc),
        version,
    )
    append_entry(spark.createDataFrame([entry], REGISTRY_SCHEMA), registry_path, fmt)
    return version


class AliasMoved(RuntimeError):
    """Another writer has moved the alias meanwhile."""


def alias_version(spark: SparkSession, registry_path: str, name: str, alias: str, fmt: str = "parquet") -> int:
    """The version that ``name@alias`` is at; 0 if nothing is registered."""
    entries = read_runs(spark, registry_path, fmt)
    if entries is None:
        return 0
    mine = entries.filter((F.col("model") == name) & (F.col("alias") == alias))
    return mine.agg(F.max("version")).first()[0] or 0


def _next_version(spark: SparkSession, path: str, name: str, alias: str, fmt: str, expected: int | None) -> int:
    """A version that no other writer has: the first one after the alias's whose file can be created."""
    now = alias_version(spark, path, name, alias, fmt)
    if expected is not None and now != expected:
        raise AliasMoved(f"{name}@{alias} is at version {now}, not {expected}")
    folder = f"{path.rstrip('/')}/_versions/{quote(name, safe='')}@{quote(alias, safe='')}"
    version = now + 1
    while not claim(spark, f"{folder}/{version}"):
        if expected is not None:
            raise AliasMoved(f"{name}@{alias} is being moved from version {now} by another writer")
        version += 1
    return version


def saved_run(
    spark: SparkSession, models_path: str, run_id: str, run_name: str, model: PipelineModel, sample: DataFrame, feature_cols: Sequence[str]
) -> list[tuple]:
    """Save a run's model with its signature and sample below ``models_path``; gives the log entry that names its place."""
    place = f"{models_path.rstrip('/')}/{run_id}"
    register_model(f"{models_path.rstrip('/')}/registry", run_name, run_id, model, place, sample, feature_cols)
    return run_rows(run_id, run_name, tags={MODEL_PATH: place})


def run_model(runs: DataFrame, run_id: str) -> PipelineModel:
    """The model of a logged run, by the place that its log names."""
    named = (F.col("run_id") == run_id) & (F.col("kind") == "tag") & (F.col("name") == MODEL_PATH)
    entry = runs.filter(named).first()
    if entry is None:
        raise LookupError(f"run {run_id} logged no model")
    return PipelineModel.load(entry["value"])


def registered_models(spark: SparkSession, registry_path: str, fmt: str = "parquet") -> DataFrame:
    """The newest entry per model and alias."""
    newest = Window.partitionBy("model", "alias").orderBy(F.desc_nulls_last("version"), F.desc("registered_at"), F.desc("path"))
    entries = read_entries(spark, registry_path, fmt)
    return entries.withColumn("age", F.row_number().over(newest)).filter(F.col("age") == 1).drop("age")


def load_model(
    spark: SparkSession, registry_path: str, name: str, alias: str = "production", fmt: str = "parquet"
) -> PipelineModel:
    """The model that ``name@alias`` points at."""
    entry = (
        registered_models(spark, registry_path, fmt)
        .filter((F.col("model") == name) & (F.col("alias") == alias))
        .first()
    )
    if entry is None:
        raise LookupError(f"no model is registered as {name}@{alias}")
    return PipelineModel.load(entry["path"])
