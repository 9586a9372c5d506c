"""Hyperparameter search: seeded draws from a space, each fitted and measured as Spark jobs."""

from __future__ import annotations

import hashlib
import json
import math
import random
import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame

from ebbtide.operators import balance, registry
from ebbtide.operators.customers import LABEL, PERSON
from ebbtide.operators.training import DEFAULT_FEATURES, assembler, kept, pipeline, weighted


@dataclass(frozen=True)
class Uniform:
    """A number between ``low`` and ``high``, rounded to a multiple of ``step`` if one is given."""

    low: float
    high: float
    step: float | None = None

    def draw(self, source: random.Random) -> float:
        value = source.uniform(self.low, self.high)
        return round(value / self.step) * self.step if self.step else value


@dataclass(frozen=True)
class Choice:
    """One of ``options``."""

    options: tuple

    def draw(self, source: random.Random):
        return source.choice(self.options)


Space = Mapping[str, object]

# The three search spaces and the number of draws from each.
SPACES: dict[str, tuple[type[Estimator], Space, int]] = {
    "Tuning_GBT": (
        GBTClassifier,
        {"maxDepth": Uniform(3, 8, 1), "maxIter": Uniform(20, 60, 10), "stepSize": Uniform(0.01, 0.1)},
        30,
    ),
    "Tuning_RF": (
        RandomForestClassifier,
        {"maxDepth": Uniform(3, 10, 1), "maxBins": Uniform(16, 64, 1), "numTrees": Uniform(10, 40, 1)},
        60,
    ),
    "Tuning_LR": (
        LogisticRegression,
        {
            "maxIter": Uniform(60, 250, 1),
            "regParam": Uniform(0, 1, 0.01),
            "elasticNetParam": Uniform(0, 1, 0.01),
            "tol": Uniform(1e-7, 1e-5),
            "fitIntercept": Choice((True, False)),
        },
        120,
    ),
}


@dataclass(frozen=True)
class Trial:
    params: dict[str, object]
    value: float | None
    seconds: float
    error: str | None = None


@dataclass(frozen=True)
class SearchResult:
    run_id: str
    best: Trial
    trials: list[Trial]
    model: PipelineModel
    rows: list[tuple]


def draws(space: Space, count: int, seed: int = 42) -> list[dict[str, object]]:
    """``count`` points of the space; plain values in it are constants."""
    source = random.Random(seed)
    return [
        {name: entry.draw(source) if hasattr(entry, "draw") else entry for name, entry in space.items()}
        for _ in range(count)
    ]


def best_trial(trials: Sequence[Trial]) -> Trial:
    """The trial with the highest value; the first one on a tie. A trial without a number for a value has failed."""
    finished = [trial for trial in trials if trial.value is not None and not math.isnan(trial.value)]
    if not finished:
        reasons = "; ".join(sorted({trial.error or "no value" for trial in trials}))
        raise RuntimeError(f"no successful trial: {reasons}")
    return max(finished, key=lambda trial: trial.value)


def _estimator(estimator_cls: type[Estimator], params: Mapping[str, object]) -> Estimator:
    """Spark's own parameter converters turn 5.0 into 5 where an integer is declared."""
    return estimator_cls(labelCol=LABEL, featuresCol="features", **params)


#: What the passes of a fit grow with.
SIZES = ("maxIter", "numTrees", "maxDepth")


def longest_first(points: Sequence[tuple[int, dict[str, object]]]) -> list[tuple[int, dict[str, object]]]:
    """Numbered draws, those with the most and deepest trees or the most iterations first, equal ones as they were drawn."""

    def work(point: tuple[int, dict[str, object]]) -> float:
        sizes = [point[1].get(name) for name in SIZES]
        return math.prod(size for size in sizes if isinstance(size, (int, float)))

    return sorted(points, key=work, reverse=True)


def search_id(*what: object) -> str:
    """The same id for the same search, so that a restart finds its trials in the run table."""
    return hashlib.sha256(json.dumps(what, default=repr, sort_keys=True).encode()).hexdigest()[:32]


def tune(
    df: DataFrame,
    estimator_cls: type[Estimator],
    space: Space,
    feature_cols: Sequence[str] | None = None,
    max_evals: int = 10,
    metric: str = "areaUnderROC",
    run_name: str | None = None,
    seed: int = 42,
    split: str = "hash",
    parallelism: int | None = None,
    log: Callable[[list[tuple]], None] | None = None,
    resume: DataFrame | None = None,
    data_id: str | None = None,
) -> SearchResult:
    """Draw ``max_evals`` points, fit each on 80 % of the people, keep the best on the others.

    The feature vectors are assembled once and kept for all trials; up to ``parallelism`` trials (by default as many as
    there are cores) run at a time, and each is itself distributed. Each has a scheduler pool of its own: under fair
    scheduling the small jobs of one fit do not wait for those of another. The longest are started first, so that none of
    them is left to run alone at the end. A failing trial is recorded and cannot win.
    The winner is fitted again on all rows, so its value is a selection score, not a test score.
    ``log`` gets each trial's entries when it ends, and the search's own at the end.

    ``resume`` is the run table that ``log`` writes to. Draws are numbered by the seed, so a search that was stopped and is
    called again in the same way on the same data (``data_id``) takes the values of finished trials from it and fits the others only;
    so does one with more draws. Failed trials are tried again.
    """
    spark = df.sparkSession
    space = {"weightCol": balance.WEIGHT, **space}
    wanted = list(dict.fromkeys([PERSON, *(feature_cols or DEFAULT_FEATURES), LABEL]))
    wanted += [balance.WEIGHT] if balance.WEIGHT in df.columns else []
    df = df.select(*wanted)
    halves = balance.hash_split if split == "hash" else balance.random_split
    train_part, check_part = halves(df, 0.8)
    vectors = assembler(feature_cols)
    slim = [LABEL, balance.WEIGHT, "features"]
    train_rows = vectors.transform(weighted(train_part)).select(*slim)
    check_rows = vectors.transform(check_part).select(LABEL, "features")
    measure = BinaryClassificationEvaluator(labelCol=LABEL, rawPredictionCol="rawPrediction", metricName=metric, numBins=0)

    algorithm = estimator_cls.__name__
    run_name = run_name or f"Search_{algorithm}"
    run_id, before = registry.new_run_id(), {}
    if resume is not None:
        run_id = search_id(run_name, algorithm, {k: repr(v) for k, v in space.items()}, wanted, metric, seed, split, data_id)
        before = registry.finished_trials(resume, run_id)

    def logged(rows: list[tuple]) -> list[tuple]:
        if log:
            log(rows)
        return rows

    def trial_rows(number: int, trial: Trial) -> list[tuple]:
        figures = {"trial_duration": trial.seconds} | ({} if trial.value is None else {"auc_val": trial.value})
        tags = {"stage": "tuning_trial", "status": "failed" if trial.error else "finished", registry.TRIAL: str(number)}
        tags |= {"error": trial.error} if trial.error else {}
        return registry.run_rows(registry.new_run_id(), f"{run_name}_{number}", trial.params, figures, tags, parent_id=run_id)

    def attempt(drawn: tuple[int, dict[str, object]]) -> tuple[Trial, list[tuple]]:
        number, params = drawn
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"{run_name}-{number}")
        started = time.perf_counter()
        try:
            model = _estimator(estimator_cls, params).fit(train_rows)
            value, error = measure.evaluate(model.transform(check_rows)), None
        except Exception as failure:  # noqa: BLE001 - any failure of one trial must not end the search
            value, error = None, f"{type(failure).__name__}: {failure}".splitlines()[0]
        trial = Trial(params, value, time.perf_counter() - started, error)
        return trial, logged(trial_rows(number, trial))

    points = list(enumerate(draws(space, max_evals, seed)))
    missing = longest_first([(number, params) for number, params in points if number not in before])
    workers = max(1, min(parallelism or spark.sparkContext.defaultParallelism, len(missing)))
    with kept(train_rows, check_rows):
        pool = ThreadPoolExecutor(max_workers=workers)
        try:
            run = inheritable_thread_target(spark)(attempt)
            done = dict(zip((number for number, _ in missing), pool.map(run, missing), strict=True))
        finally:
            pool.shutdown(cancel_futures=True)  # a search that is stopped starts no more trials
    for number, params in points:
        if number in before:
            done[number] = Trial(params, before[number].value, before[number].seconds), []
    trials = [done[number][0] for number, _ in points]
    best = best_trial(trials)
    model = pipeline(_estimator(estimator_cls, best.params), feature_cols).fit(weighted(df))

    rows = registry.run_rows(
        run_id,
        run_name,
        {f"best_{name}": value for name, value in best.params.items()},
        {"best_auc_val": best.value},
        {"type": "hyperparameter_tuning", "algorithm": algorithm},
    )
    if missing or resume is None:  # otherwise they are in the run table already
        logged(rows)
    rows = rows + [row for number, _ in points for row in done[number][1]]
    return SearchResult(run_id, best, trials, model, rows)
