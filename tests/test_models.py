"""Weights, splits, metrics, training, search, registry and scoring."""

import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ebbtide.operators import balance, customers, evaluate, registry, scoring, search, training
from ebbtide.plans import jobs


def _labels(spark, churned, stayed):
    return spark.range(churned + stayed).select((F.col("id") < churned).cast("int").alias("churn"))


def test_rare_class_weighs_more_and_weights_sum_to_the_rows(spark):
    df = _labels(spark, 98, 2)
    weights = balance.fitted_class_weights(df)
    assert weights == (pytest.approx(100 / 196), 25.0)
    assert balance.with_class_weight(df, weights).agg(F.sum("weight")).first()[0] == pytest.approx(100)


def test_one_class_has_a_null_weight_and_cannot_be_weighed(spark):
    row = balance.class_weights(_labels(spark, 5, 0)).first()
    assert (row.churned_weight, row.stayed_weight) == (0.5, None)
    with pytest.raises(ValueError, match="both classes"):
        balance.fitted_class_weights(_labels(spark, 5, 0))
    with pytest.raises(ValueError, match="both classes"):
        balance.fitted_class_weights(_labels(spark, 0, 0))


def test_hash_split_is_whole_disjoint_and_independent_of_partitioning(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias(customers.PERSON))
    first, second = balance.hash_split(df, 0.7)
    ids = [{r[0] for r in part.collect()} for part in (first, second)]
    assert not ids[0] & ids[1] and len(ids[0] | ids[1]) == 2000 and 1300 < len(ids[0]) < 1500
    again, _ = balance.hash_split(df.repartition(13), 0.7)
    assert {r[0] for r in again.collect()} == ids[0]
    first, second = balance.random_split(df, 0.7)
    assert first.count() + second.count() == 2000


def test_hash_split_takes_any_share(spark):
    for share in (0.999, 0.0005):
        first, second = balance.hash_split(spark.range(100_000).withColumnRenamed("id", "customer_unique_id"), share)
        assert first.count() == pytest.approx(share * 100_000, abs=30) and first.count() + second.count() == 100_000


def test_hash_split_keeps_rows_without_a_key(spark):
    df = spark.createDataFrame([(None,), ("a",)], f"{customers.PERSON} string")
    assert sum(part.count() for part in balance.hash_split(df, 0.7)) == 2


def _brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("distinct", [3, 50, 100000])
def test_area_equals_brute_force_and_the_evaluator(spark, distinct):
    source = random.Random(distinct)
    pairs = [(float(source.randrange(distinct)) / distinct - 0.5, source.randrange(2)) for _ in range(600)]
    df = spark.createDataFrame(pairs, "score double, churn int")
    row = evaluate.auc_roc(df, ranges=7).first()
    assert row.auc_roc == pytest.approx(_brute_auc(pairs), abs=1e-12)
    assert (row.positives, row.negatives) == (sum(y for _, y in pairs), sum(1 - y for _, y in pairs))
    judge = BinaryClassificationEvaluator(labelCol="churn", rawPredictionCol="score", numBins=0)
    assert judge.evaluate(df) == pytest.approx(row.auc_roc, abs=1e-9)


def test_area_with_most_rows_on_one_score_and_with_counts(spark):
    pairs = [(0.5, 1)] * 200 + [(0.5, 0)] * 100 + [(0.1, 0), (0.9, 1), (0.2, 1)]
    df = spark.createDataFrame(pairs, "score double, churn int")
    expected = _brute_auc(pairs)
    assert evaluate.auc_roc(df).first().auc_roc == pytest.approx(expected)
    counted = df.groupBy("score", "churn").agg(F.count("*").alias("n"))
    assert evaluate.auc_roc(counted, rows="n").first().auc_roc == pytest.approx(expected)


def test_area_of_one_class_is_null(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "score double, churn int")
    row = evaluate.auc_roc(df).first()
    assert (row.auc_roc, row.positives, row.negatives) == (None, 2, 0)
    assert evaluate.auc_roc(df.limit(0)).first().auc_roc is None


def test_decision_metrics_of_a_known_matrix_and_of_the_evaluator(spark):
    cells = [(1, 1.0)] * 5 + [(1, 0.0)] * 2 + [(0, 0.0)] * 3 + [(0, 1.0)]
    df = spark.createDataFrame(cells, "churn int, prediction double")
    row = evaluate.classification_metrics(df).first()
    assert [round(v, 6) for v in row] == [0.727273, 0.748485, 0.727273, 0.731935]
    for cells in (cells, [(1, 1.0)] * 3 + [(0, 1.0)], [(1, 0.0), (0, 2.0), (2, 2.0)]):
        df = spark.createDataFrame(cells, "churn int, prediction double")
        row = evaluate.classification_metrics(df).first()
        names = ("accuracy", "weightedPrecision", "weightedRecall", "f1")
        judge = MulticlassClassificationEvaluator(labelCol="churn", predictionCol="prediction")
        assert list(row) == pytest.approx([judge.setMetricName(name).evaluate(df) for name in names])


def test_baselines_have_their_parameters(spark):
    models = training.baselines()
    forest, boosted, linear = models.values()
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed()) == (50, 5, 42)
    assert (boosted.getMaxIter(), boosted.getMaxDepth(), boosted.getSeed()) == (20, 5, 42)
    assert (linear.getRegParam(), linear.getElasticNetParam()) == (0.01, 1.0)
    assert {m.getWeightCol() for m in models.values()} == {"weight"}


def test_train_measures_held_out_people_like_the_evaluators(spark, gold):
    kept_before = set(spark.sparkContext._jsc.getPersistentRDDs())
    run = training.train(gold, training.baselines()["LogisticReg_Baseline"], feature_cols=customers.FEATURES)
    _, test_part = balance.hash_split(gold, 0.7)
    scored = run.model.transform(test_part)
    area = BinaryClassificationEvaluator(labelCol="churn", numBins=0).evaluate(scored)
    judge = MulticlassClassificationEvaluator(labelCol="churn")
    assert run.metrics["auc_roc"] == pytest.approx(area)
    for mine, name in (
        ("accuracy", "accuracy"),
        ("precision", "weightedPrecision"),
        ("recall", "weightedRecall"),
        ("f1_score", "f1"),
    ):
        assert run.metrics[mine] == pytest.approx(judge.setMetricName(name).evaluate(scored))
    assert run.metrics["throughput_rows_sec"] > 0
    logged = registry.runs_frame(spark, run.rows)
    assert {r.name for r in logged.filter("kind = 'metric'").collect()} == set(run.metrics)
    params = {r.name: r.value for r in logged.filter("kind = 'param'").collect()}
    assert params["regParam"] == "0.01" and {r.value for r in logged.filter("kind = 'tag'").collect()} == {
        "LogisticRegression"
    }
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= kept_before


def test_train_defaults_given_weights_and_the_random_split(gold):
    weighed = balance.with_class_weight(gold, balance.fitted_class_weights(gold))
    estimator = LogisticRegression(labelCol="churn", featuresCol="features", weightCol="weight")
    run = training.train(weighed, estimator, split="random")
    assert run.model.stages[0].getInputCols() == training.DEFAULT_FEATURES
    assert run.rows[0][2] == "LogisticRegression" and 0 <= run.metrics["auc_roc"] <= 1


def test_draws_repeat_by_seed_and_stay_in_the_space():
    space = {"a": search.Uniform(3, 8, 1), "b": search.Uniform(20, 60, 10), "c": search.Choice((True, False)), "d": "w"}
    points = search.draws(space, 50, seed=7)
    assert points == search.draws(space, 50, seed=7) != search.draws(space, 50, seed=8)
    assert {p["a"] for p in points} <= set(range(3, 9)) and {p["b"] for p in points} <= {20, 30, 40, 50, 60}
    assert {p["c"] for p in points} == {True, False} and {p["d"] for p in points} == {"w"}
    assert all(0.01 <= p["x"] <= 0.1 for p in search.draws({"x": search.Uniform(0.01, 0.1)}, 20))


def test_search_keeps_the_best_and_refits_it(spark, gold):
    kept_before = set(spark.sparkContext._jsc.getPersistentRDDs())
    space = {"regParam": search.Uniform(0, 1, 0.01), "maxIter": search.Uniform(5, 9, 1), "elasticNetParam": 0.0}
    found = search.tune(gold, LogisticRegression, space, customers.FEATURES, max_evals=4, run_name="LR")
    assert len(found.trials) == 4 and found.best.value == max(t.value for t in found.trials)
    again = search.tune(gold, LogisticRegression, space, customers.FEATURES, max_evals=4, parallelism=1)
    assert again.best.params == found.best.params and again.best.value == pytest.approx(found.best.value)
    assert "probability" in found.model.transform(gold).columns
    logged = registry.runs_frame(spark, found.rows)
    parent = logged.filter("parent_id IS NULL")
    assert {r.name for r in parent.collect()} >= {"best_regParam", "best_auc_val", "type", "algorithm"}
    assert logged.filter("parent_id IS NOT NULL").select("run_id").distinct().count() == 4
    best = registry.best_run(logged).first()
    assert best.auc_val == found.best.value
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= kept_before


def test_a_failing_trial_is_recorded_and_cannot_win(spark, gold):
    space = {"maxDepth": search.Choice((2, 99)), "maxIter": 2.0}
    found = search.tune(gold, GBTClassifier, space, max_evals=4, seed=3)
    failed = [t for t in found.trials if t.error]
    assert failed and len(failed) < 4 and all(t.value is None and t.params["maxDepth"] == 99 for t in failed)
    assert found.best.params["maxDepth"] == 2
    statuses = registry.runs_frame(spark, found.rows).filter("name = 'status'").groupBy("value").count().collect()
    assert {r["value"]: r["count"] for r in statuses} == {"failed": len(failed), "finished": 4 - len(failed)}


def test_no_successful_trial_is_an_error(gold):
    with pytest.raises(RuntimeError, match="no successful trial"):
        search.tune(gold, GBTClassifier, {"maxDepth": 99}, max_evals=2)


def test_spaces_and_draw_counts():
    counts = {name: evals for name, (_, _, evals) in search.SPACES.items()}
    assert counts == {"Tuning_GBT": 30, "Tuning_RF": 60, "Tuning_LR": 120}


def test_run_table_and_leaderboard(spark, tmp_path):
    path = str(tmp_path / "runs")
    registry.log_runs(spark, path, registry.run_rows("r1", "one", {"p": 1}, {"auc_roc": 0.6, "accuracy": 0.9}))
    registry.log_runs(spark, path, registry.run_rows("r2", "two", None, {"auc_roc": 0.7}, {"algorithm": "x"}))
    board = registry.leaderboard(spark.read.parquet(path)).collect()
    assert [(r.run_name, r.auc_roc, r.accuracy) for r in board] == [("two", 0.7, None), ("one", 0.6, 0.9)]
    assert registry.best_run(spark.read.parquet(path), "accuracy").first().run_id == "r1"


def test_models_are_found_by_alias_and_score_the_same(spark, gold, tmp_path):
    estimator = training.baselines()["LogisticReg_Baseline"]
    model = training.pipeline(estimator, customers.FEATURES).fit(training.weighted(gold))
    table = str(tmp_path / "registry")
    for version in ("m1", "m2"):
        registry.register_model(
            table, "churn", "production", model, str(tmp_path / version), gold, customers.FEATURES
        )
    entry = registry.registered_models(spark, table).collect()
    assert len(entry) == 1 and entry[0].path.endswith("m2")
    assert "recency" in entry[0].input_schema and "probability" in entry[0].output_schema
    loaded = registry.load_model(spark, table, "churn")
    columns = ["customer_unique_id", "rawPrediction", "probability", "prediction"]
    assert loaded.transform(gold).select(columns).collect() == model.transform(gold).select(columns).collect()
    with pytest.raises(LookupError, match="churn@staging"):
        registry.load_model(spark, table, "churn", "staging")


def _scored(spark):
    rows = [("a", 0.6, 1.0), ("b", 0.9, 1.0), ("c", 0.7, 1.0), ("d", 0.4, 0.0)]
    df = spark.createDataFrame(rows, "customer_unique_id string, p double, prediction double")
    for name in customers.FEATURES:
        df = df.withColumn(name, F.lit(1))
    return (
        df.withColumn("probability", array_to_vector(F.array(1 - F.col("p"), F.col("p"))))
        .withColumn("churn_probability", scoring.churn_probability())
        .withColumn("risk_status", scoring.risk_status())
    )


def test_report_orders_by_the_probability_of_churning(spark):
    rows = scoring.churn_report(_scored(spark)).collect()
    assert [r.customer_unique_id for r in rows] == ["b", "c", "a"]
    assert {r.risk_status for r in rows} == {"🔴 HIGH RISK"}
    assert len(rows[0]) == 13 and rows[0].churn_probability == pytest.approx(0.9)
    assert {r.risk_status for r in _scored(spark).filter("prediction = 0").collect()} == {"🟢 LOW RISK"}


def test_score_job_stores_the_report(spark, gold, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS mart LOCATION '{tmp_path / 'mart'}'")
    estimator = training.baselines()["LogisticReg_Baseline"]
    model = training.pipeline(estimator, customers.FEATURES).fit(training.weighted(gold))
    stored = jobs.score(model, gold, "mart.churn_daily_report")
    assert stored.count() == jobs.score(model, gold).count() == model.transform(gold).filter("prediction = 1").count()
    assert spark.table("mart.churn_daily_report").schema["probability"].dataType.typeName() == "vectorudt"


def test_train_and_tune_jobs_log_all_runs(spark, gold, tmp_path):
    path = str(tmp_path / "runs")
    models = str(tmp_path / "models")
    done = jobs.train(gold, path, models)
    assert list(done) == ["RF_Baseline", "GBT_Baseline", "LogisticReg_Baseline"]
    found = jobs.tune(gold, path, max_evals=1, models_path=models)
    assert list(found) == list(search.SPACES)
    runs = spark.read.parquet(path)
    assert {r.run_name for r in registry.leaderboard(runs).collect()} == set(done)
    assert runs.filter("name = 'stage' AND value = 'tuning_trial'").count() == 3
    for run in [*done.values(), *found.values()]:
        loaded = registry.run_model(runs, run.run_id)
        assert loaded.transform(gold).select("probability").collect() == run.model.transform(gold).select("probability").collect()
    assert registry.registered_models(spark, f"{models}/registry").count() == 6
    with pytest.raises(LookupError, match="no model"):
        registry.run_model(runs, "nothing")


def test_trials_are_logged_when_they_end(gold):
    seen = []
    space = {"maxDepth": search.Choice((2, 99)), "maxIter": 2.0}
    found = search.tune(gold, GBTClassifier, space, max_evals=4, seed=3, log=seen.append)
    assert len(seen) == 5 and {r[0] for rows in seen for r in rows} == {r[0] for r in found.rows}
    assert [r[3] for r in seen[-1]].count("metric") == 1


def test_a_trial_without_a_number_cannot_win():
    trials = [search.Trial({"p": 1}, float("nan"), 1.0), search.Trial({"p": 2}, 0.4, 1.0), search.Trial({"p": 3}, None, 1.0, "x")]
    assert search.best_trial(trials).params == {"p": 2}
    with pytest.raises(RuntimeError, match="no successful trial"):
        search.best_trial(trials[:1])


def test_area_with_infinite_scores(spark):
    pairs = [(float("inf"), 1), (float("-inf"), 0), (float("inf"), 0), (0.5, 1), (0.2, 0), (float("-inf"), 1)]
    df = spark.createDataFrame(pairs, "score double, churn int")
    assert evaluate.auc_roc(df, ranges=4).first().auc_roc == pytest.approx(_brute_auc(pairs))


def test_selection_scores_are_exact_beyond_the_evaluators_bins(spark):
    drawn = spark.range(6000).select(F.rand(1).alias("score"), (F.rand(2) < 0.5).cast("int").alias("churn"))
    judge = BinaryClassificationEvaluator(labelCol="churn", rawPredictionCol="score", numBins=0)
    assert judge.evaluate(drawn) == pytest.approx(evaluate.auc_roc(drawn).first().auc_roc, abs=1e-12)


SMALL_SPACE = {"regParam": search.Uniform(0, 1, 0.01), "maxIter": search.Uniform(3, 5, 1), "elasticNetParam": 0.0}


def test_the_longest_trials_start_first(gold, monkeypatch):
    """None of them is left to run alone at the end; trials are numbered and listed as they were drawn all the same."""
    space, started = {"maxIter": search.Uniform(2, 9, 1), "elasticNetParam": 0.0}, []
    make = search._estimator
    monkeypatch.setattr(search, "_estimator", lambda cls, params: started.append(params["maxIter"]) or make(cls, params))
    found = search.tune(gold, LogisticRegression, space, customers.FEATURES, max_evals=5, parallelism=1)
    drawn = [t.params["maxIter"] for t in found.trials]
    assert drawn == [p["maxIter"] for p in search.draws(space, 5)] != sorted(drawn, reverse=True)
    assert started[:5] == sorted(drawn, reverse=True)
    points = [{"numTrees": 2, "maxDepth": 3}, {"numTrees": 3, "maxDepth": 3}, {"maxDepth": "deep"}, {"numTrees": 3, "maxDepth": 3.0, "tol": 9}]
    assert [number for number, _ in search.longest_first(list(enumerate(points)))] == [1, 3, 0, 2]


def test_a_stopped_search_goes_on_where_it_was(spark, gold, tmp_path, monkeypatch):
    """Stopped after 4 of 12 trials: the rest is fitted, the winner is that of a search in one go."""
    path, fitted = str(tmp_path / "runs"), []
    whole = search.tune(gold, LogisticRegression, SMALL_SPACE, max_evals=12, run_name="LR", parallelism=4)
    make = search._estimator
    monkeypatch.setattr(search, "_estimator", lambda cls, params: fitted.append(params) or make(cls, params))

    def stopping(rows):
        if len(fitted) > 4:
            raise KeyboardInterrupt
        registry.log_runs(spark, path, rows)

    def tune(log, evals=12, data_id="d", **options):
        runs = registry.read_runs(spark, path)
        resume = registry.runs_frame(spark, []) if runs is None else runs
        return search.tune(gold, LogisticRegression, SMALL_SPACE, max_evals=evals, run_name="LR", log=log, resume=resume, data_id=data_id, **options)

    with pytest.raises(KeyboardInterrupt):
        tune(stopping, parallelism=1)
    assert 5 <= len(fitted) < 12
    fitted.clear()
    append = lambda rows: registry.log_runs(spark, path, rows)
    found = tune(append, parallelism=4)
    assert len(fitted) == 8 + 1  # eight trials and the winner on all rows
    assert found.best.params == whole.best.params and found.best.value == pytest.approx(whole.best.value)
    assert [t.params for t in found.trials] == [t.params for t in whole.trials]
    runs = registry.read_runs(spark, path)
    assert runs.filter(F.col("parent_id") == found.run_id).select("run_id").distinct().count() == 12
    assert runs.filter("name = 'best_auc_val'").count() == 1
    fitted.clear()
    again = tune(append)
    assert len(fitted) == 1 and again.best.value == found.best.value and registry.read_runs(spark, path).count() == runs.count()
    fitted.clear()
    assert len(tune(append, evals=14).trials) == 14 and len(fitted) == 3  # more draws
    fitted.clear()
    tune(append, evals=2, data_id="other")  # other data: nothing is taken over
    assert len(fitted) == 3


def test_several_writers_lose_nothing(spark, tmp_path):
    path, n = str(tmp_path / "runs"), 24
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: registry.log_runs(spark, path, registry.run_rows(f"r{i}", f"n{i}", {"p": i}, {"auc_roc": i / n})), range(n)))
    runs = registry.read_runs(spark, path)
    assert {r.run_id for r in runs.collect()} == {f"r{i}" for i in range(n)} and runs.count() == 2 * n
    assert registry.read_runs(spark, str(tmp_path / "none")) is None


def test_an_alias_is_moved_by_one_writer_at_a_time(spark, gold, tmp_path):
    model = training.pipeline(training.baselines()["LogisticReg_Baseline"], customers.FEATURES).fit(training.weighted(gold))
    table = str(tmp_path / "registry")

    def register(i, expected=None, name="churn"):
        return registry.register_model(table, name, "production", model, str(tmp_path / f"{name}{i}"), gold, customers.FEATURES, expected=expected)

    with ThreadPoolExecutor(4) as pool:
        versions = list(pool.map(register, range(8)))
    assert sorted(versions) == list(range(1, 9))
    newest = registry.registered_models(spark, table).collect()
    assert len(newest) == 1 and newest[0].path.endswith(f"churn{versions.index(8)}") and newest[0].version == 8
    assert registry.alias_version(spark, table, "churn", "production") == 8
    assert register("next", expected=8) == 9
    with pytest.raises(registry.AliasMoved):
        register("late", expected=8)

    def only_one(i):
        try:
            return register(i, expected=0, name="other/model")
        except registry.AliasMoved:
            return None

    with ThreadPoolExecutor(4) as pool:
        assert sorted(filter(None, pool.map(only_one, range(4)))) == [1]
    assert registry.load_model(spark, table, "other/model") is not None


def test_the_past_is_fitted_and_the_present_scored(spark, gold, tmp_path):
    """Three closed snapshots and an open one, the same people in all; only rows of the past are seen by a fit."""
    days = ["2001-01-01", "2001-04-01", "2001-07-01", "2001-09-01"]
    parts = [gold.withColumn("snapshot_date", F.lit(day).cast("date")) for day in days]
    parts[3] = parts[3].withColumn("churn", F.lit(None).cast("int"))
    features = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    path, models = str(tmp_path / "runs"), str(tmp_path / "models")
    estimator = training.baselines()["LogisticReg_Baseline"]
    done = jobs.score_later(features, estimator, "later", path, models)
    direct = training.train_on(parts[0].unionByName(parts[1]), parts[2], estimator, "later", customers.FEATURES)
    assert done.metrics["auc_roc"] == pytest.approx(direct.metrics["auc_roc"])
    loaded = registry.run_model(registry.read_runs(spark, path), done.run_id)
    predicted = {r[0] for r in loaded.transform(parts[3]).filter("prediction = 1").select("customer_unique_id").collect()}
    assert {r.customer_unique_id for r in done.report.collect()} == predicted
    for wrong in (parts[0].unionByName(parts[3]), parts[0].unionByName(parts[1]), parts[3]):
        with pytest.raises(ValueError, match="two closed snapshots"):
            jobs.score_later(wrong, estimator)


def test_people_without_reviews_can_be_told_apart(spark):
    df = spark.createDataFrame([(1, 0, 0.0), (2, 3, 0.0), (3, None, None)], "customer_unique_id int, total_reviews_given int, avg_satisfaction double")
    assert [r.reviewed for r in customers.with_reviewed(df).orderBy("customer_unique_id").collect()] == [0, 1, 0]
