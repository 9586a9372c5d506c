"""The jobs, each a plan over the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime
from functools import partial, reduce
from typing import NamedTuple

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.operators import customers, explore, manifest, orders, registry, scoring, search, training
from ebbtide.session import working_folder
from ebbtide.sources import files
from ebbtide.sources.schemas import COLUMN_TYPES
from ebbtide.sources.shop import ShopTables

# How stored orders are partitioned.
SILVER_PERIOD = orders.StoredPeriod("order_purchase_month", "month")


def bronze(
    spark: SparkSession,
    directory: str,
    database: str = "bronze",
    types: Mapping[str, str] | None = COLUMN_TYPES,
) -> list[str]:
    """Register every CSV of a directory as a table of ``database``; returns the table names."""
    files.ensure_database(spark, database)
    return files.register_directory(spark, directory, database, types)


def silver(tables: ShopTables, path: str, months: Sequence[str | date] | None = None) -> DataFrame:
    """Store the clean orders with all their details, by month of purchase, and return them.

    With ``months`` (any day of each) only the orders of those months are read, joined and replaced, and a month that has
    none any more is removed; the other months' files stay. The details of other orders are left out before they are
    aggregated. Orders that are stored in a month that is not named, and have left it, would be lost or
    doubled: that is refused. ``refresh_silver`` finds out itself which months it must name.

    Feature jobs then read the months they need and join nothing but customers. The details of each kind are aggregated and
    joined where their one exchange has put them. Should an order id be repeated very often, its orders are dealt to several tasks.
    """
    if months is None:
        return _store_silver(tables, path, None)
    first_days = sorted({str(day)[:7] + "-01" for day in months})
    moved = _moved_orders(tables, path, first_days)
    if moved:
        raise ValueError(f"orders have left months that are not named: {', '.join(moved)}")
    return _store_silver(tables, path, first_days)


def _in_months(months: Sequence[str]) -> Column:
    return F.col(SILVER_PERIOD.column).isin([F.lit(day).cast("date") for day in months])


def _moved_orders(tables: ShopTables, path: str, months: Sequence[str]) -> list[str]:
    """Other months that still hold orders which now lie in one of ``months``."""
    key = [orders.ORDER, orders.PURCHASED]
    month = SILVER_PERIOD.of(F.col(orders.PURCHASED)).alias(SILVER_PERIOD.column)
    placed = orders.clean_orders(tables.orders).select(*key, month)
    elsewhere = files.read_table(tables.orders.sparkSession, f"{path}/orders").where(~_in_months(months))
    elsewhere = elsewhere.select(*key, SILVER_PERIOD.column).join(placed.where(_in_months(months)), orders.ORDER, "left_semi")
    gone = elsewhere.join(placed, key, "left_anti").select(F.col(SILVER_PERIOD.column).cast("string")).distinct()
    return sorted(row[0] for row in gone.collect())


def _store_silver(tables: ShopTables, path: str, months: Sequence[str] | None) -> DataFrame:
    """Stores the orders of ``months`` (first days), or all, in place of those that are there."""
    spark = tables.orders.sparkSession
    month = SILVER_PERIOD.of(F.col(orders.PURCHASED)).alias(SILVER_PERIOD.column)
    placed = orders.clean_orders(tables.orders).select("*", month)
    details = (tables.payments, tables.items, tables.reviews)
    if months is not None:
        placed = placed.filter(_in_months(months))
        words = orders.order_filter(placed)
        details = tuple(orders.of_orders(rows, words) for rows in details)
    hot = orders.hot_ids(placed)
    if hot.isEmpty():
        parts = orders.payments_by_order(details[0]), orders.items_by_order(details[1]), orders.reviews_by_order(details[2])
        detailed = reduce(lambda rows, part: rows.join(part, orders.ORDER, "left"), parts, placed)
    else:
        detailed = orders.with_facts(placed, orders.order_facts(*details), hot, ["customer_id", orders.PURCHASED])
    # Rebalancing gives each month few files and still splits a month that is very large.
    files.write_table(
        detailed.hint("rebalance", SILVER_PERIOD.column),
        f"{path}/orders",
        partition_by=[SILVER_PERIOD.column],
        by_partition=months is not None,
    )
    if months is not None:
        there = {str(row[0]) for row in placed.select(SILVER_PERIOD.column).distinct().collect()}  # of the months named
        files.drop_partitions(spark, f"{path}/orders", SILVER_PERIOD.column, sorted(set(months) - there))
    return files.read_table(spark, f"{path}/orders")


def refresh_silver(tables: ShopTables, path: str) -> DataFrame:
    """Bring stored orders up to date with their sources, and return them.

    Each month's rows are counted and digested and compared with the manifest of the last run. Months that are new or whose
    orders or details differ are computed again, months without orders are removed, all others stay as they are. An
    order that has moved changes both its months. The new manifest is written last."""
    spark = tables.orders.sparkSession
    now_path = working_folder(spark, "manifest")
    files.write_table(manifest.of_orders(tables, SILVER_PERIOD).coalesce(1), now_path)
    now, before = files.read_table(spark, now_path), manifest.newest(spark, f"{path}/manifest")
    if before is None:
        _store_silver(tables, path, None)
    else:
        found = manifest.changes(now, before).all()
        if found:
            _store_silver(tables, path, found)
    manifest.append(now, f"{path}/manifest")
    return files.read_table(spark, f"{path}/orders")


def order_master(tables: ShopTables, placed: DataFrame, part: bool = False) -> DataFrame:
    """The orders ``placed`` with their customer and details, from the source tables.

    If they are ``part`` of all orders, details of the others are left out by a filter of the ids inside the scans, before they
    are aggregated and sent. Ids that are on very many orders are dealt to several tasks."""
    details = (tables.payments, tables.items, tables.reviews)
    if part:
        words = orders.order_filter(placed)
        details = tuple(orders.of_orders(rows, words) for rows in details)
        hot = orders.hot_words(words)
        if not hot.isEmpty():
            with_customers = orders.order_master(tables.customers, placed)
            dealt_by = [customers.PERSON, orders.PURCHASED]
            return orders.with_facts(with_customers, orders.order_facts(*details), hot, dealt_by)
    payments, items, reviews = details
    return orders.order_master(
        tables.customers,
        placed,
        orders.payments_by_order(payments),
        orders.items_by_order(items),
        orders.reviews_by_order(reviews),
    )


def study(
    tables: ShopTables,
    churn_days: int = 90,
    history_days: int = 365,
    stored: orders.StoredPeriod | None = None,
    detailed: DataFrame | None = None,
) -> tuple[DataFrame, orders.StudyBounds]:
    """The orders of the study period, which ends with the newest order, and its bounds.

    ``detailed`` are orders stored by ``silver``; without them the details come from the source
    tables, whose orders may have a ``stored`` day or month.
    """
    placed = orders.clean_orders(tables.orders) if detailed is None else detailed
    bounds = orders.study_bounds(placed, churn_days, history_days)
    period = stored if detailed is None else SILVER_PERIOD
    placed = orders.study_period(placed, bounds.start, bounds.end, period)
    if detailed is None:
        return order_master(tables, placed, part=True), bounds
    return orders.order_master(tables.customers, placed), bounds


def gold(
    tables: ShopTables,
    churn_days: int = 90,
    history_days: int = 365,
    snapshots: Sequence[str | datetime] | None = None,
    stored: orders.StoredPeriod | None = None,
    detailed: DataFrame | None = None,
) -> DataFrame:
    """The feature table with its label, one row per person and snapshot.

    Without ``snapshots`` there is one, ``churn_days`` before the newest order. Each given snapshot has its own
    history and response window; all of them are one pass. A label is null while its response window is open.
    """
    if snapshots is None:
        master, bounds = study(tables, churn_days, history_days, stored, detailed)
        features = customers.churn_gold(master, bounds.split, churn_days)
        return features.withColumn("snapshot_date", F.lit(bounds.split).cast("date"))
    windows = orders.snapshot_windows(snapshots, churn_days, history_days)
    if not windows:
        raise ValueError("there is no snapshot")
    placed = orders.clean_orders(tables.orders) if detailed is None else detailed
    newest = orders.study_bounds(placed, churn_days, history_days).end
    placed = orders.study_periods(placed, windows, stored if detailed is None else SILVER_PERIOD)
    master = order_master(tables, placed, part=True) if detailed is None else orders.order_master(tables.customers, placed)
    return customers.churn_gold_at(master, windows, newest, churn_days)


def store_states(tables: ShopTables, detailed: DataFrame, path: str) -> str:
    """Store partial results per month and person of all ``detailed`` orders, for many snapshots; returns ``path``."""
    master = orders.order_master(tables.customers, detailed)
    states, spread = customers.month_states(master)
    files.write_table(states.hint("rebalance", customers.STATE_MONTH), f"{path}/states", partition_by=[customers.STATE_MONTH])
    files.write_table(spread, f"{path}/spread")
    files.write_table(orders.bounds(detailed).select(F.col("end").cast("string")), f"{path}/newest")
    return path


def gold_from_states(
    tables: ShopTables,
    detailed: DataFrame,
    path: str,
    snapshots: Sequence[str | datetime],
    churn_days: int = 90,
    history_days: int = 365,
) -> DataFrame:
    """The feature table of many snapshots, such as one a day: equal to ``gold`` with these, but whole months
    come from the partial results at ``path``, and orders are read from the months alone in which a window begins or ends."""
    spark = detailed.sparkSession
    windows = orders.snapshot_windows(snapshots, churn_days, history_days)
    if not windows:
        raise ValueError("there is no snapshot")
    newest = files.read_table(spark, f"{path}/newest").first()["end"]
    cells = customers.window_cells(windows, churn_days)
    edges = sorted({cell.month for cell in cells if cell.part == "border"})
    whole = sorted({cell.month for cell in cells if cell.part != "border"})
    border = orders.order_master(tables.customers, detailed.filter(_in_months(edges)))
    states = files.read_table(spark, f"{path}/states")
    states = states.filter(F.col(customers.STATE_MONTH).isin([F.lit(day).cast("date") for day in whole]))
    spread = files.read_table(spark, f"{path}/spread").select(*border.columns)
    return customers.churn_gold_from_states(states, spread, border, windows, newest, churn_days)


def store_gold(features: DataFrame, path: str) -> DataFrame:
    """Store the feature table by snapshot; a rerun replaces only the snapshots it has."""
    files.write_table(features, path, partition_by=["snapshot_date"], by_partition=True)
    return files.read_table(features.sparkSession, path)


def _class_share(counts: DataFrame) -> DataFrame:
    return explore.value_share_counts(counts, customers.LABEL).select(
        F.col("number").cast("int").alias(customers.LABEL), "rows", "percent"
    )


#: What follows from the stored counts of every column's values.
EXPLORATIONS = {
    "describe": explore.describe_counts,
    "class_share": _class_share,
    "histogram": explore.histogram_counts,
    "density": explore.density_counts,
    "top_categories": explore.top_categories_counts,
}


def eda(features: DataFrame) -> dict[str, DataFrame]:
    """The exploration tables of a feature table, by name.

    One scan counts every column's values, and the tables are made from the stored counts; only the correlation, which
    is of pairs, scans the table itself."""
    path = working_folder(features.sparkSession, "value-counts")
    files.write_table(explore.value_counts(features), path)
    counts = files.read_table(features.sparkSession, path)
    tables = {name: operator(counts) for name, operator in EXPLORATIONS.items()}
    return tables | {"correlation": explore.correlation(features)}


def _logged(spark: SparkSession, runs_path: str | None, rows: list[tuple]) -> None:
    if runs_path:
        registry.log_runs(spark, runs_path, rows)


def train(
    features: DataFrame, runs_path: str | None = None, models_path: str | None = None
) -> dict[str, training.TrainedRun]:
    """The three baselines, fitted and measured. Each is logged, and saved with its signature, as soon as it is done."""
    spark, done = features.sparkSession, {}
    for name, estimator in training.baselines().items():
        run = done[name] = training.train(features, estimator, name, customers.FEATURES)
        rows = list(run.rows)
        if models_path:
            rows += registry.saved_run(spark, models_path, run.run_id, name, run.model, features, customers.FEATURES)
        _logged(spark, runs_path, rows)
    return done


def tune(
    features: DataFrame,
    runs_path: str | None = None,
    max_evals: int | None = None,
    parallelism: int | None = None,
    seed: int = 42,
    models_path: str | None = None,
    names: Sequence[str] | None = None,
) -> dict[str, search.SearchResult]:
    """The three searches, or those named; ``max_evals`` replaces the number of draws of every space.

    Every trial is logged when it ends, so that a lost driver loses only what was running: the same call goes on with the
    draws that are not in the run table. The refitted winner is saved."""
    spark, done = features.sparkSession, {}
    data_id = None
    if runs_path:
        totals = features.agg(F.count("*"), F.sum(manifest.row_digest(features))).first()
        data_id = "-".join(map(str, totals))
    for name in search.SPACES if names is None else names:
        estimator_cls, space, evals = search.SPACES[name]
        done[name] = search.tune(
            features,
            estimator_cls,
            space,
            customers.FEATURES,
            max_evals or evals,
            run_name=name,
            seed=seed,
            parallelism=parallelism,
            log=partial(_logged, spark, runs_path),
            resume=None if runs_path is None else registry.read_runs(spark, runs_path) or registry.runs_frame(spark, []),
            data_id=data_id,
        )
        if models_path:
            found = done[name]
            rows = registry.saved_run(spark, models_path, found.run_id, name, found.model, features, customers.FEATURES)
            _logged(spark, runs_path, rows)
    return done


class LaterScores(NamedTuple):
    """What ``score_later`` gives: the run measured on the newest closed snapshot, the model fitted on all closed ones, and the
    report on the open one."""

    run_id: str
    metrics: dict[str, float]
    model: PipelineModel
    report: DataFrame


def score_later(
    features: DataFrame,
    estimator: Estimator,
    run_name: str | None = None,
    runs_path: str | None = None,
    models_path: str | None = None,
    report_table: str | None = None,
) -> LaterScores:
    """Fit on the past, score the present: ``features`` of several snapshots, as ``gold`` or ``gold_from_states`` give them.

    Snapshots whose label is known are closed. The model is fitted on all of them but the newest and measured on that
    one, which lies later than all it was fitted on; then it is fitted on all closed snapshots, and the newest open
    snapshot is scored. No row is used to fit a model that scores or measures it."""
    known = F.col(customers.LABEL).isNotNull()
    dates = features.groupBy("snapshot_date").agg(F.min(known.cast("int")).alias("closed")).collect()  # a row per snapshot
    closed = sorted(row["snapshot_date"] for row in dates if row["closed"])
    still_open = sorted(row["snapshot_date"] for row in dates if not row["closed"])
    if len(closed) < 2 or not still_open or still_open[-1] < closed[-1]:
        raise ValueError("two closed snapshots and a later open one are needed")
    day = F.col("snapshot_date")
    past, newest = features.filter(day.isin(closed[:-1])), features.filter(day == F.lit(closed[-1]))
    run = training.train_on(past, newest, estimator, run_name, customers.FEATURES)
    model = training.pipeline(estimator, customers.FEATURES).fit(training.weighted(features.filter(day.isin(closed))))
    spark, rows = features.sparkSession, list(run.rows)
    if models_path:
        rows += registry.saved_run(spark, models_path, run.run_id, run_name or type(estimator).__name__, model, newest, customers.FEATURES)
    _logged(spark, runs_path, rows)
    report = score(model, features.filter(day == F.lit(still_open[-1])), report_table)
    return LaterScores(run.run_id, run.metrics, model, report)


def score(model: PipelineModel, features: DataFrame, report_table: str | None = None) -> DataFrame:
    """The report of predicted churners, stored as ``report_table`` if a name is given."""
    report = scoring.churn_report(scoring.score(model, features))
    if report_table is None:
        return report
    files.save_as_table(report, report_table)
    return features.sparkSession.table(report_table)
