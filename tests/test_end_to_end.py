"""From CSV files to the stored report."""

from ebbtide.operators import customers, registry
from ebbtide.plans import jobs
from ebbtide.sources.shop import open_database
from ebbtide.sources.star_schema import shop_tables
from tests.conftest import DATA


def test_csv_to_report(spark, tmp_path):
    given = shop_tables(spark, DATA)
    for name in ("customers", "orders", "payments", "items", "reviews"):
        table = getattr(given, name).drop("order_purchase_day")
        table.coalesce(1).write.options(header=True, quote='"', escape='"').csv(str(tmp_path / "csv" / f"{name}.csv"))
    jobs.bronze(spark, str(tmp_path / "csv"), "shop")
    tables = open_database(spark, "shop")
    assert dict(tables.payments.dtypes)["payment_value"] == "decimal(12,2)"

    detailed = jobs.silver(tables, str(tmp_path / "silver"))
    features = jobs.store_gold(jobs.gold(tables, detailed=detailed), str(tmp_path / "gold"))
    exact = [c for c in [*customers.FEATURES, "city", "state", "churn"] if c != "avg_satisfaction"]
    direct = jobs.gold(given).select(*exact)
    assert features.select(*exact).exceptAll(direct).count() == 0
    assert features.count() == direct.count() > 50

    runs, models = str(tmp_path / "runs"), str(tmp_path / "models")
    trained = jobs.train(features, runs)
    board = registry.leaderboard(spark.read.parquet(runs)).collect()
    assert len(board) == 3 and all(0 <= row.auc_roc <= 1 for row in board)
    best = trained[board[0].run_name].model
    registry.register_model(
        f"{models}/registry", "churn", "production", best, f"{models}/best", features, customers.FEATURES
    )
    model = registry.load_model(spark, f"{models}/registry", "churn")
    report = jobs.score(model, features, "shop.churn_daily_report")
    chances = [row.churn_probability for row in report.collect()]
    assert 0 < len(chances) <= features.count() and all(0 <= chance <= 1 for chance in chances)
    assert all(len(row) > 0 for row in jobs.eda(features)["describe"].collect())


def test_gold_reruns_replace_their_snapshot_only(spark, tmp_path):
    tables = shop_tables(spark, DATA)
    path = str(tmp_path / "gold")
    jobs.store_gold(jobs.gold(tables, snapshots=["2000-12-01 00:00:00", "2001-02-01 00:00:00"]), path)
    first = spark.read.parquet(path).groupBy("snapshot_date").count().collect()
    stored = jobs.store_gold(jobs.gold(tables, snapshots=["2001-02-01 00:00:00"]), path)
    assert sorted(stored.groupBy("snapshot_date").count().collect()) == sorted(first) and len(first) == 2
