
from __future__ import annotations

import importlib
import os
import sys
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta
from functools import reduce
from types import ModuleType

from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle_queries  # noqa: E402
from ebbtide.operators import balance, customers, evaluate, explore, orders  # noqa: E402
from ebbtide.operators import registry, scoring, search, training  # noqa: E402
from ebbtide.plans import jobs  # noqa: E402
from ebbtide.session import working_folder  # noqa: E402
from ebbtide.sources import files, schemas  # noqa: E402
from ebbtide.sources.shop import ShopTables  # noqa: E402
from ebbtide.sources.star_schema import shop_tables  # noqa: E402

DAY_COLUMN = "order_purchase_day"
DAY = orders.StoredPeriod(DAY_COLUMN, "day")


def _rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Money as double and averages rounded, so that two engines can agree to the last digit."""
    columns = []
    for field in df.schema:
        kind, column = field.dataType.typeName(), F.col(field.name)
        if kind == "decimal":
            column = column.cast("double")
        elif kind == "double" and field.name not in ("monetary", "weight"):
            column = F.round(column, special.get(field.name, digits))
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _master(tables: ShopTables) -> DataFrame:
    return jobs.order_master(tables, orders.clean_orders(tables.orders)).drop(DAY_COLUMN)


def _study(tables: ShopTables) -> tuple[DataFrame, orders.StudyBounds]:
    return jobs.study(tables, stored=DAY)


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.gold(shop_tables(spark, sf_dir), stored=DAY).drop("snapshot_date")


_stored: dict[tuple[str, str], str] = {}


def _feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table as exploration and models read it: stored once per session, from all rows."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        path = working_folder(spark, "features")
        files.write_table(_gold(spark, sf_dir), path)
        _stored[key] = path
    return files.read_table(spark, _stored[key])


def _silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored orders with their details, once per session and data."""
    key = (spark.sparkContext.applicationId, f"silver {sf_dir}")
    if key not in _stored:
        path = working_folder(spark, "silver")
        jobs.silver(shop_tables(spark, sf_dir), path)
        _stored[key] = f"{path}/orders"
    return files.read_table(spark, _stored[key])


def entry(spark: SparkSession) -> DataFrame:
    """The churn feature table with its label, from the smallest test set."""
    return _gold(spark, "/root/testdata/sf0.001")


def _label_churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    master, bounds = _study(shop_tables(spark, sf_dir))
    features = customers.rfm_features(master, bounds.split)
    active = customers.active_customers(master, bounds.split)
    return customers.label_churn(features, active).select(customers.PERSON, customers.LABEL)


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored orders with their details, without the partition column."""
    return _silver_orders(spark, sf_dir).drop(DAY_COLUMN, jobs.SILVER_PERIOD.column)


def _changed_source(tables: ShopTables) -> ShopTables:
    """An earlier state of the shop: some orders were not there yet, others lay in other months, some of which have none
    today, and some details were different."""
    key, purchased = F.col(orders.ORDER), F.col(orders.PURCHASED)
    placed = tables.orders.filter(~((key % 7 == 0) & (F.month(purchased) < 4)) & (F.trunc(purchased, "month") != F.lit("1999-08-01")))
    moved = F.when((key % 11 == 0) & (F.month(purchased) == 5), purchased + F.make_dt_interval(days=F.lit(40))).otherwise(purchased)
    old = tables.orders.filter(F.month(purchased) == 2).withColumn(orders.PURCHASED, purchased - F.make_dt_interval(days=F.lit(20_000)))
    placed = placed.filter(F.month(purchased) != 2).withColumn(orders.PURCHASED, moved).unionByName(old)
    payments = tables.payments.filter(~((F.col(orders.ORDER) % 13 == 0) & (F.col("payment_sequential") == 1)))
    return replace(tables, orders=placed, payments=payments)


def _silver_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stored from an earlier state of the shop and brought up to date: as if stored from today's."""
    tables, path = shop_tables(spark, sf_dir), working_folder(spark, "silver")
    jobs.refresh_silver(_changed_source(tables), path)
    return jobs.refresh_silver(tables, path).drop(DAY_COLUMN, jobs.SILVER_PERIOD.column)


def _gold_from_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table by way of stored orders."""
    tables = shop_tables(spark, sf_dir)
    return jobs.gold(tables, detailed=_silver_orders(spark, sf_dir)).drop("snapshot_date")


def _feature_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four snapshots, stored by snapshot and read back: the usual one, one a month and one a year earlier, and one whose
    response window is still open."""
    tables = shop_tables(spark, sf_dir)
    detailed = _silver_orders(spark, sf_dir)
    newest = orders.study_bounds(detailed).split
    snapshots = [datetime.fromisoformat(newest) + timedelta(days=days) for days in (0, -30, -365, 60)]
    features = jobs.gold(tables, snapshots=snapshots, detailed=detailed)
    stored = jobs.store_gold(features, working_folder(spark, "gold"))
    return stored.withColumn("snapshot_date", F.col("snapshot_date").cast("string"))


def _daily_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thirty snapshots, one a day, from stored months of partial results."""
    tables = shop_tables(spark, sf_dir)
    detailed = _silver_orders(spark, sf_dir)
    newest = datetime.fromisoformat(orders.study_bounds(detailed).split)
    path = jobs.store_states(tables, detailed, working_folder(spark, "states"))
    features = jobs.gold_from_states(tables, detailed, path, [newest - timedelta(days=days) for days in range(30)])
    return features.withColumn("snapshot_date", F.col("snapshot_date").cast("string"))


def _hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = balance.hash_split(_feature_table(spark, sf_dir), 0.7)
    return train.select(customers.PERSON, F.lit("train").alias("part")).unionByName(
        test.select(customers.PERSON, F.lit("test").alias("part"))
    )


def _random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both parts of Spark's own split together: everyone, once."""
    first, second = balance.random_split(_feature_table(spark, sf_dir), 0.7)
    return first.select(customers.PERSON).unionByName(second.select(customers.PERSON))


def _stored_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report as a managed table, read back."""
    report = scoring.churn_report(_scored_by_rule(_feature_table(spark, sf_dir)))
    folder = working_folder(spark, "mart")
    database = folder.rsplit("/", 1)[1].replace("-", "_")
    files.ensure_database(spark, database, folder)
    files.save_as_table(report, f"{database}.churn_daily_report")
    return spark.table(f"{database}.churn_daily_report").drop("probability")


def _weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = _feature_table(spark, sf_dir)
    return balance.with_class_weight(gold, balance.fitted_class_weights(gold))


# Three hand-made rules. Their scores are plain arithmetic, so SQL can grade them as well.
MIXED = "recency - 20D * frequency - monetary / 10000D"
RULES = {
    "rule_recency": ("CAST(recency AS DOUBLE)", "recency > 60"),
    "rule_frequency": ("-CAST(frequency AS DOUBLE)", "frequency <= 3"),
    "rule_mixed": (MIXED, f"{MIXED} > 0"),
}


def _graded(gold: DataFrame, rule: str) -> DataFrame:
    score, claim = RULES[rule]
    prediction = F.expr(claim).cast("int").cast("double")
    return gold.select(customers.LABEL, F.expr(score).alias("score"), prediction.alias("prediction"))


def _rule_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run log of the rules: the metrics of each on the whole feature table, in long form."""
    gold = _feature_table(spark, sf_dir)
    runs = None
    for rule in RULES:
        graded = _graded(gold, rule)
        metrics = evaluate.classification_metrics(graded).withColumnsRenamed(
            {"weighted_precision": "precision", "weighted_recall": "recall", "f1": "f1_score"}
        )
        metrics = metrics.select(
            F.inline(F.array(*(F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in metrics.columns)))
        ).unionByName(evaluate.auc_roc(graded).select(F.lit("auc_roc").alias("name"), F.col("auc_roc").alias("value")))
        rows = metrics.select(
            F.lit(rule).alias("run_id"),
            F.lit(rule).alias("run_name"),
            F.lit("metric").alias("kind"),
            "name",
            F.col("value").cast("string").alias("value"),
        )
        runs = rows if runs is None else runs.unionByName(rows)
    return runs


def _scored_by_rule(gold: DataFrame) -> DataFrame:
    """The columns a model would add, from the mixed rule squeezed into (0, 1)."""
    chance = 1.0 / (1.0 + F.exp(-F.expr(MIXED) / 100.0))
    return (
        gold.withColumn("churn_probability", chance)
        .withColumn("probability", array_to_vector(F.array(1.0 - chance, chance)))
        .withColumn("prediction", (chance > 0.5).cast("int").cast("double"))
        .withColumn("churn_probability", scoring.churn_probability())
        .withColumn("risk_status", scoring.risk_status())
    )


def _facts(spark: SparkSession, facts: dict[str, int]) -> DataFrame:
    return spark.createDataFrame([(name, int(value)) for name, value in facts.items()], "fact string, value bigint")


def _probability_facts(scored: DataFrame) -> DataFrame:
    """Per scored row: whether probability, prediction and risk label belong together."""
    chance = vector_to_array("probability")
    return scored.select(
        "*",
        ((chance[1] >= 0) & (chance[1] <= 1) & (F.abs(chance[0] + chance[1] - 1) < 1e-9)).alias("is_probability"),
        (F.col("prediction") == (chance[1] > 0.5).cast("double")).alias("prediction_fits"),
    )


def _train(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """A baseline's fit, checked on the held-out people: how many, of which class, and whether what it says is consistent
    and its logged metrics are those of MLlib's evaluators."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        gold = _feature_table(spark, sf_dir)
        trained = training.train(gold, training.baselines()[name], name, customers.FEATURES)
        _, held_out = balance.hash_split(gold, 0.7)
        scored = trained.model.transform(held_out).cache()
        counts = _probability_facts(scored).agg(
            F.count("*").alias("held_out"),
            F.sum(customers.LABEL).alias("churned"),
            F.sum(F.col("is_probability").cast("int")).alias("probabilities"),
            F.sum(F.col("prediction_fits").cast("int")).alias("fitting_predictions"),
        )
        facts = counts.first().asDict()
        judge = MulticlassClassificationEvaluator(labelCol=customers.LABEL)
        theirs = [judge.setMetricName(m).evaluate(scored) for m in ("accuracy", "weightedPrecision", "weightedRecall", "f1")]
        theirs.append(BinaryClassificationEvaluator(labelCol=customers.LABEL, numBins=0).evaluate(scored))
        scored.unpersist()
        mine = [trained.metrics[m] for m in ("accuracy", "precision", "recall", "f1_score", "auc_roc")]
        facts["equal_metrics"] = sum(abs(a - b) < 1e-9 for a, b in zip(mine, theirs, strict=True))
        facts["speed_metrics"] = sum(trained.metrics[m] > 0 for m in registry.SPEED_METRICS)
        logged = registry.runs_frame(spark, trained.rows).filter("kind = 'metric'")
        facts["logged_metrics"] = logged.count()
        return _facts(spark, facts)

    return run


def _on_step(entry, value) -> bool:
    if isinstance(entry, search.Choice):
        return value in entry.options
    inside = entry.low - 1e-9 <= value <= entry.high + 1e-9
    return inside and (not entry.step or abs(value / entry.step - round(value / entry.step)) < 1e-6)


def _tune(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """A whole search with all its draws, read back from the run table that it wrote trial by trial."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _, space, _ = search.SPACES[name]
        gold, path = _feature_table(spark, sf_dir), working_folder(spark, "runs")
        found = jobs.tune(gold, path, names=[name])[name]
        runs = registry.read_runs(spark, path)
        trials = runs.filter(F.col("parent_id") == found.run_id)
        values = trials.filter("kind = 'metric' AND name = 'auc_val'").select(F.col("value").cast("double").alias("v"))
        measured = values.agg(F.count("*").alias("n"), F.max("v").alias("best"), F.sum((F.col("v").between(0, 1)).cast("int")).alias("areas")).first()
        best = registry.best_run(runs, "best_auc_val").first()
        return _facts(
            spark,
            {
                "trials": trials.select("run_id").distinct().count(),
                "finished": trials.filter("name = 'status' AND value = 'finished'").count(),
                "areas": measured["areas"],
                "draws_in_space": sum(
                    all(_on_step(entry, t.params[key]) for key, entry in space.items()) for t in found.trials
                ),
                "best_is_largest": best["best_auc_val"] == measured["best"] == found.best.value,
                "scored_people": found.model.transform(gold).select(customers.PERSON, "prediction").count(),
            },
        )

    return run


def _saved_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training job logs and saves; the best logged run's model, loaded by its logged path, scores as in memory."""
    gold, folder = _feature_table(spark, sf_dir), working_folder(spark, "training")
    done = jobs.train(gold, f"{folder}/runs", f"{folder}/models")
    runs = registry.read_runs(spark, f"{folder}/runs")
    best = registry.best_run(runs, "auc_roc").first()
    loaded = registry.run_model(runs, best["run_id"])
    before, after = (m.transform(gold).select(customers.PERSON, "probability") for m in (done[best["run_name"]].model, loaded))
    joined = before.withColumnRenamed("probability", "trained").join(after, customers.PERSON)
    return joined.select(customers.PERSON, (F.col("trained") == F.col("probability")).alias("same"))


def _failing_trial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A search whose third draw cannot be fitted: it is logged as failed and the others go on."""
    gold = _feature_table(spark, sf_dir)
    space = {"maxIter": search.Choice((2,)), "maxDepth": search.Choice((2, 99))}
    drawn = search.draws({"weightCol": balance.WEIGHT, **space}, 4, seed=3)
    found = search.tune(gold, training.GBTClassifier, space, customers.FEATURES, max_evals=4, seed=3)
    statuses = registry.runs_frame(spark, found.rows).filter("name = 'status'")
    too_deep = sum(d["maxDepth"] == 99 for d in drawn)
    counted = statuses.agg(
        F.count("*").alias("trials"), (F.sum((F.col("value") == "failed").cast("int")) == too_deep).alias("failed_as_drawn")
    )
    return counted.select("trials", "failed_as_drawn", F.lit(found.best.params["maxDepth"] == 2).alias("best_could_be_fitted"))


def _run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules' metrics, appended to a run table rule by rule and read back."""
    path = working_folder(spark, "runs")
    for rule in RULES:
        graded = _graded(_feature_table(spark, sf_dir), rule)
        metrics = evaluate.classification_metrics(graded).first().asDict()
        registry.log_runs(spark, path, registry.run_rows(rule, rule, {"rule": rule}, metrics))
    logged = registry.read_runs(spark, path).filter("kind = 'metric'")
    return logged.select("run_id", "name", F.col("value").cast("double").alias("value"))


def _throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = _feature_table(spark, sf_dir)
    speed = evaluate.throughput(_fitted(gold), gold)
    consistent = speed.seconds > 0 and abs(speed.rows_per_second * speed.seconds - speed.rows) < 1e-6 * speed.rows
    return _facts(spark, {"rows": speed.rows, "consistent": consistent})


def _preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five rows, each found again in the table."""
    gold = _feature_table(spark, sf_dir)
    seen = files.preview(gold, 5).select(customers.PERSON).alias("seen")
    known = gold.select(customers.PERSON).distinct()
    return seen.join(known, customers.PERSON, "left_semi").agg(F.count("*").alias("rows"))


def _default_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors of the default features, sum by sum."""
    vectors = training.assembler().transform(_feature_table(spark, sf_dir)).select(vector_to_array("features").alias("f"))
    parts = vectors.select(F.posexplode("f").alias("place", "value"))
    return parts.groupBy("place").agg(F.count("*").alias("rows"), F.round(F.sum("value"), 2).alias("total"))


def _exploration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exploration job's tables in long form, from one scan's value counts (and the correlation's own)."""
    tables = jobs.eda(_feature_table(spark, sf_dir))
    long = {
        "describe": (F.col("column_name"), F.round("stddev", 6)),
        "class_share": (F.col(customers.LABEL).cast("string"), F.round("percent", 6)),
        "histogram": (F.concat_ws(" ", "column_name", "bin"), F.col("rows").cast("double")),
        "density": (F.concat_ws(" ", "column_name", "point"), F.round("density", 7)),
        "top_categories": (F.concat_ws(" ", "column_name", "place", "value"), F.col("rows").cast("double")),
        "correlation": (F.concat_ws(" ", "column_a", "column_b"), F.round("correlation", 6)),
    }
    parts = [
        tables[name].select(F.lit(name).alias("table_name"), key.alias("key"), value.alias("value"))
        for name, (key, value) in long.items()
    ]
    return reduce(DataFrame.unionByName, parts)


#: Days before the newest order: three closed snapshots, and one whose response window is still open.
SNAPSHOT_DAYS = (270, 180, 90, 30)


def _score_later(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model fitted on closed snapshots and measured on the last of them scores the open one: who took which part."""
    tables, detailed = shop_tables(spark, sf_dir), _silver_orders(spark, sf_dir)
    newest = datetime.fromisoformat(orders.study_bounds(detailed).end)
    folder = working_folder(spark, "later")
    snapshots = [newest - timedelta(days=days) for days in SNAPSHOT_DAYS]
    features = jobs.store_gold(jobs.gold(tables, snapshots=snapshots, detailed=detailed), f"{folder}/gold")
    done = jobs.score_later(features, training.baselines()["LogisticReg_Baseline"], "later", f"{folder}/runs", f"{folder}/models")
    loaded = registry.run_model(registry.read_runs(spark, f"{folder}/runs"), done.run_id)
    today = features.filter(F.col("snapshot_date") == F.lit(snapshots[-1].date()))
    predicted = loaded.transform(today).filter("prediction = 1").select(customers.PERSON)
    reported = done.report.select(customers.PERSON)
    fits = predicted.exceptAll(reported).isEmpty() and reported.exceptAll(predicted).isEmpty()
    people = features.groupBy(F.col("snapshot_date").cast("string").alias("snapshot_date")).agg(
        F.count("*").alias("people"), F.count(customers.LABEL).alias("labelled"), F.sum(customers.LABEL).alias("churned")
    )
    measured = 0 <= done.metrics["auc_roc"] <= 1
    return people.select("*", F.lit(fits).alias("report_fits"), F.lit(measured).alias("measured"))


def _scored_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scoring job with a fitted model, stored and read back: each person at risk, once, and the label that goes with it."""
    gold, folder = _feature_table(spark, sf_dir), working_folder(spark, "mart")
    model = _fitted(gold)
    database = folder.rsplit("/", 1)[1].replace("-", "_")
    files.ensure_database(spark, database, folder)
    report = jobs.score(model, gold, f"{database}.churn_daily_report")
    predicted = model.transform(gold).filter("prediction = 1").select(customers.PERSON)
    return _facts(
        spark,
        {
            "predicted_but_not_reported": predicted.exceptAll(report.select(customers.PERSON)).count(),
            "reported_but_not_predicted": report.select(customers.PERSON).exceptAll(predicted).count(),
            "wrong_labels": report.filter(F.col("risk_status") != scoring.HIGH_RISK).count(),
            "unlikely": report.filter("churn_probability <= 0.5").count(),
        },
    )


def _window_30(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(jobs.gold(shop_tables(spark, sf_dir), churn_days=30, stored=DAY).drop("snapshot_date"))


def _split_80(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, check = balance.hash_split(_feature_table(spark, sf_dir), 0.8)
    sides = train.select(F.lit("train").alias("part"), customers.LABEL).unionByName(check.select(F.lit("check").alias("part"), customers.LABEL))
    return sides.groupBy("part").agg(F.count("*").alias("rows"), F.sum(customers.LABEL).alias("churned"))


def _fitted(gold: DataFrame):
    model = training.baselines()["LogisticReg_Baseline"]
    return training.pipeline(model, customers.FEATURES).fit(training.weighted(gold))


def _score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everyone scored by a fitted model, and whether probability, prediction and risk label belong together."""
    gold = _feature_table(spark, sf_dir)
    scored = _probability_facts(scoring.score(_fitted(gold), gold))
    fits = F.col("risk_status") == F.when(F.col("churn_probability") > 0.5, scoring.HIGH_RISK).otherwise(scoring.LOW_RISK)
    return scored.select(customers.PERSON, "is_probability", "prediction_fits", fits.alias("risk_fits"))


def _model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the model read back from the registry scores each person like the one stored."""
    gold = _feature_table(spark, sf_dir)
    model = _fitted(gold)
    folder = working_folder(spark, "models")
    registry.register_model(
        f"{folder}/registry", "churn", "production", model, f"{folder}/model", gold, customers.FEATURES
    )
    loaded = registry.load_model(spark, f"{folder}/registry", "churn")
    before, after = (m.transform(gold).select(customers.PERSON, "probability") for m in (model, loaded))
    joined = before.withColumnRenamed("probability", "stored").join(after, customers.PERSON)
    return joined.select(customers.PERSON, (F.col("stored") == F.col("probability")).alias("same"))


def _csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long texts with quotes and line breaks, written as CSV and read back."""
    folder = working_folder(spark, "csv")
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    texts.write.options(
        header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(folder)
    return files.read_csv(spark, folder, {"doc_id": "bigint", "lang": "string", "text": "string"})


def _register_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source tables as CSV, registered as tables and counted there."""
    folder = working_folder(spark, "bronze")
    database = folder.rsplit("/", 1)[1].replace("-", "_")
    tables = shop_tables(spark, sf_dir)
    for name in ("customers", "orders", "payments", "items", "reviews"):
        getattr(tables, name).write.options(header=True, quote='"', escape='"').csv(f"{folder}/csv/{name}.csv")
    files.ensure_database(spark, database, f"{folder}/tables")
    names = files.register_directory(spark, f"{folder}/csv", database, schemas.COLUMN_TYPES)
    counted = None
    for name in names:
        table = spark.table(name)
        key = "customer_id" if name.endswith("customers") else "order_id"
        one = table.agg(
            F.lit(name.split(".")[1]).alias("table_name"),
            F.count("*").alias("rows"),
            F.count_distinct(key).alias("keys"),
        )
        counted = one if counted is None else counted.unionByName(one)
    return counted


def _optional(module: str) -> ModuleType | None:
    """A module that this copy, or this machine, may lack: also where something that it imports is missing."""
    try:
        return importlib.import_module(module)
    except ImportError:
        return None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All registered queries: the library's own, and those on training data if that package is there."""
    found = core_queries()
    if training_data := _optional("ebbtide.llm.queries"):
        found |= training_data.QUERIES
        if pipeline := _optional("corpus_pipeline"):
            found["pipeline"] = pipeline.run
    return found


def core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def on_study(operator: Callable[..., DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            master, bounds = _study(shop_tables(spark, sf_dir))
            return _rounded(operator(master, bounds).drop(DAY_COLUMN))

        return run

    def on_tables(operator: Callable[[ShopTables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: _rounded(operator(shop_tables(spark, sf_dir)))

    def on_features(operator: Callable[[DataFrame], DataFrame], **digits: int):
        return lambda spark, sf_dir: _rounded(operator(_feature_table(spark, sf_dir)), **digits)

    return {
        "clean_orders": on_tables(lambda t: orders.clean_orders(t.orders).drop(DAY_COLUMN)),
        "payments_by_order": on_tables(lambda t: orders.payments_by_order(t.payments)),
        "items_by_order": on_tables(lambda t: orders.items_by_order(t.items)),
        "reviews_by_order": on_tables(lambda t: orders.reviews_by_order(t.reviews)),
        "order_facts": on_tables(lambda t: orders.order_facts(t.payments, t.items, t.reviews)),
        "order_master": on_tables(_master),
        "study_bounds": on_tables(lambda t: orders.bounds(orders.clean_orders(t.orders))),
        "study_period": on_study(lambda master, bounds: master),
        "observation": on_study(lambda master, bounds: customers.observation(master, bounds.split)),
        "response": on_study(lambda master, bounds: customers.response(master, bounds.split)),
        "active_customers": on_study(lambda master, bounds: customers.active_customers(master, bounds.split)),
        "rfm_features": on_study(lambda master, bounds: customers.rfm_features(master, bounds.split)),
        "label_churn": _label_churn,
        "churn_gold": lambda spark, sf_dir: _rounded(_gold(spark, sf_dir)),
        "silver_orders": lambda spark, sf_dir: _rounded(_silver(spark, sf_dir)),
        "silver_refresh": lambda spark, sf_dir: _rounded(_silver_refresh(spark, sf_dir)),
        "gold_from_silver": lambda spark, sf_dir: _rounded(_gold_from_silver(spark, sf_dir)),
        "feature_store": lambda spark, sf_dir: _rounded(_feature_store(spark, sf_dir)),
        "daily_snapshots": lambda spark, sf_dir: _rounded(_daily_snapshots(spark, sf_dir)),
        "exploration": _exploration,
        "score_later": _score_later,
        "reviewed": lambda spark, sf_dir: customers.with_reviewed(_feature_table(spark, sf_dir)).select(customers.PERSON, "reviewed"),
        "describe": on_features(explore.describe),
        "value_share": on_features(lambda gold: explore.value_share(gold, customers.LABEL)),
        "correlation": on_features(explore.correlation),
        "histogram": on_features(lambda gold: explore.histogram(gold).drop("total", "spread")),
        "density": on_features(explore.density, density=7),
        "top_categories": on_features(explore.top_categories),
        "class_weights": lambda spark, sf_dir: balance.class_weights(_feature_table(spark, sf_dir)),
        "weighted_gold": lambda spark, sf_dir: _rounded(_weighted(spark, sf_dir)),
        "hash_split": _hash_split,
        "random_split": _random_split,
        "auc_roc": on_features(lambda gold: evaluate.auc_roc(_graded(gold, "rule_mixed")), auc_roc=9),
        "classification_metrics": on_features(
            lambda gold: evaluate.classification_metrics(_graded(gold, "rule_mixed"))
        ),
        "risk_status": on_features(
            lambda gold: _scored_by_rule(gold).select(customers.PERSON, "prediction", "risk_status")
        ),
        "churn_report": on_features(
            lambda gold: scoring.churn_report(_scored_by_rule(gold)).drop("probability"), churn_probability=9
        ),
        "stored_report": lambda spark, sf_dir: _rounded(_stored_report(spark, sf_dir), churn_probability=9),
        "leaderboard": lambda spark, sf_dir: _rounded(
            registry.leaderboard(_rule_runs(spark, sf_dir), registry.QUALITY_METRICS)
        ),
        "best_run": lambda spark, sf_dir: _rounded(registry.best_run(_rule_runs(spark, sf_dir), "auc_roc")),
        "csv_roundtrip": _csv_roundtrip,
        "register_directory": _register_directory,
        "model_roundtrip": _model_roundtrip,
        "score_batch": _score_batch,
        "saved_run": _saved_run,
        "failing_trial": _failing_trial,
        "run_log": lambda spark, sf_dir: _rounded(_run_log(spark, sf_dir)),
        "throughput": _throughput,
        "preview": _preview,
        "default_features": _default_features,
        "scored_report": _scored_report,
        "churn_window_30": _window_30,
        "hash_split_80": _split_80,
        "train_rf": _train("RF_Baseline"),
        "train_gbt": _train("GBT_Baseline"),
        "train_lr": _train("LogisticReg_Baseline"),
        "tune_gbt": _tune("Tuning_GBT"),
        "tune_rf": _tune("Tuning_RF"),
        "tune_lr": _tune("Tuning_LR"),
    }


def oracle_sql() -> dict[str, str]:
    found = oracle_queries.oracle_sql()
    if training_data := _optional("ebbtide.llm.queries"):
        found |= training_data.SQL
        pipeline = _optional("corpus_pipeline")
        if pipeline and pipeline.ORACLE_SQL:
            found["pipeline"] = pipeline.ORACLE_SQL
    return found
