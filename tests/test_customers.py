"""Feature table: window borders, first known values, population, fills."""

from datetime import datetime
from decimal import Decimal

from ebbtide.operators import customers, orders
from ebbtide.plans import jobs
from ebbtide.sources.star_schema import shop_tables

SCHEMA = (
    "order_id string, customer_unique_id string, order_purchase_timestamp timestamp, "
    "customer_zip_code_prefix string, customer_city string, customer_state string, "
    "total_order_payment decimal(22,2), max_installments int, payment_method_count bigint, "
    "primary_payment_type string, total_items bigint, Avg_review_score double, Min_review_score int, "
    "Total_Review_Number bigint"
)
SNAPSHOT = "2018-07-19 17:30:18"


def _master(spark, rows):
    """Rows of (order, person, time) with further columns by name; the others are null."""
    names = [part.split()[0] for part in SCHEMA.replace("decimal(22,2)", "decimal").split(", ")]
    full = []
    for order, person, time, *rest in rows:
        given = {
            "order_id": order,
            "customer_unique_id": person,
            "order_purchase_timestamp": datetime.fromisoformat(time),
            **(rest[0] if rest else {}),
        }
        full.append(tuple(given.get(name) for name in names))
    return spark.createDataFrame(full, SCHEMA)


def test_response_window_closes_at_midnight_of_its_last_day(spark):
    seen = [("old-" + p, p, "2018-07-01 00:00:00") for p in "abcd"]
    later = [
        ("1", "a", "2018-10-16 23:00:00"),
        ("2", "b", "2018-10-17 00:00:00"),
        ("3", "c", "2018-10-17 00:00:01"),
        ("4", "d", "2018-10-17 17:30:18"),
    ]
    master = _master(spark, seen + later)
    assert {r[0] for r in customers.active_customers(master, SNAPSHOT, 90).collect()} == {"a", "b"}
    labels = {r.customer_unique_id: r.churn for r in customers.churn_gold(master, SNAPSHOT, 90).collect()}
    assert labels == {"a": 0, "b": 0, "c": 1, "d": 1}


def test_purchase_at_the_snapshot_is_observed_not_a_response(spark):
    master = _master(spark, [("1", "a", SNAPSHOT)])
    assert customers.observation(master, SNAPSHOT).count() == 1
    assert customers.response(master, SNAPSHOT).count() == 0
    row = customers.churn_gold(master, SNAPSHOT).first()
    assert (row.recency, row.frequency, row.churn) == (0, 1, 1)


def test_snapshot_may_be_text_or_datetime(spark):
    master = _master(spark, [("1", "a", "2018-07-01 00:00:00"), ("2", "a", "2018-08-01 00:00:00")])
    assert (
        customers.churn_gold(master, SNAPSHOT).collect()
        == customers.churn_gold(master, datetime.fromisoformat(SNAPSHOT)).collect()
    )


def test_first_known_city_skips_nulls(spark):
    master = _master(
        spark,
        [
            ("3", "a", "2018-03-01 00:00:00", {"customer_city": "y"}),
            ("1", "a", "2018-01-01 00:00:00", {"customer_city": None, "primary_payment_type": "boleto"}),
            ("2", "a", "2018-02-01 00:00:00", {"customer_city": "x", "primary_payment_type": "voucher"}),
        ],
    )
    row = customers.rfm_features(master.repartition(3), SNAPSHOT).first()
    assert (row.city, row.state, row.primary_payment_type) == ("x", None, "boleto")


def test_features_add_up_over_orders_and_copies_count_once(spark):
    master = _master(
        spark,
        [
            ("1", "a", "2018-07-10 23:59:59", {"total_order_payment": Decimal("10.10"), "max_installments": 2,
             "payment_method_count": 3, "total_items": 2, "Avg_review_score": 5.0, "Min_review_score": 5,
             "Total_Review_Number": 1}),
            ("2", "a", "2018-07-01 00:00:00", {"total_order_payment": Decimal("0.20"), "max_installments": 8,
             "payment_method_count": 1, "total_items": 1, "Avg_review_score": 2.0, "Min_review_score": 1,
             "Total_Review_Number": 4}),
            ("2", "a", "2018-07-01 00:00:00", {"total_order_payment": Decimal("0.20")}),
        ],
    )
    row = customers.rfm_features(master, SNAPSHOT).first()
    assert (row.recency, row.frequency, row.monetary) == (9, 2, 10.5)
    assert (row.total_items_volume, row.payment_method_count, row.max_installments) == (3, 3, 8)
    assert (row.avg_satisfaction, row.min_review_score, row.total_reviews_given) == (3.5, 1, 5)


def test_numbers_are_filled_and_text_is_not(spark):
    row = customers.churn_gold(_master(spark, [("1", "a", "2018-07-01 00:00:00")]), SNAPSHOT).first()
    assert (row.monetary, row.total_items_volume, row.max_installments) == (0.0, 0, 0)
    assert (row.avg_satisfaction, row.min_review_score, row.total_reviews_given) == (0.0, 0, 0)
    assert row.city is None and row.primary_payment_type is None


def test_buyers_seen_only_after_the_snapshot_are_not_rows(spark):
    master = _master(spark, [("1", "a", "2018-07-01 00:00:00"), ("2", "new", "2018-08-01 00:00:00")])
    assert [r[0] for r in customers.churn_gold(master, SNAPSHOT).select("customer_unique_id").collect()] == ["a"]


def test_one_pass_equals_features_joined_with_active_customers(spark):
    tables = shop_tables(spark, "/root/testdata/sf0.001")
    master, bounds = jobs.study(tables)
    once = customers.churn_gold(master, bounds.split)
    features = customers.rfm_features(master, bounds.split)
    active = customers.active_customers(master, bounds.split)
    joined = customers.label_churn(features, active).na.fill(0).select(*once.columns)
    assert once.exceptAll(joined).count() == 0 and joined.exceptAll(once).count() == 0
    assert once.count() == once.select("customer_unique_id").distinct().count() > 0
    repeated = customers.label_churn(features, customers.response(master, bounds.split)).na.fill(0)
    assert repeated.select(*once.columns).exceptAll(once).count() == 0 and repeated.count() == once.count()
    assert "ExistenceJoin" in _plan(repeated)
    lost = features.join(active, "customer_unique_id", "left_anti").count()
    kept = features.join(active, "customer_unique_id", "left_semi").count()
    assert once.filter("churn = 1").count() == lost and once.filter("churn = 0").count() == kept
    assert once.filter("frequency < 1 OR recency < 0").count() == 0


def test_several_snapshots(spark):
    tables = shop_tables(spark, "/root/testdata/sf0.001")
    snapshots = ["2000-10-01 00:00:00", "2001-01-01 12:00:00"]
    both = jobs.gold(tables, snapshots=snapshots)
    assert both.groupBy("snapshot_date", "customer_unique_id").count().filter("count > 1").count() == 0
    for moment in snapshots:
        one = jobs.gold(tables, snapshots=[moment])
        assert both.filter(both.snapshot_date == moment[:10]).exceptAll(one).count() == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_counts_orders_without_another_exchange(spark):
    """Rows come joined on the order id; (person, order) must not be shuffled again."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(jobs.gold(shop_tables(spark, "/root/testdata/sf0.001")))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(customer_unique_id" in line]
    assert len(exchanges) == 1 and "order_id" not in exchanges[0].split("ENSURE")[0]
    assert plan.count("Exchange hashpartitioning(order_id") == 4
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_filters_reach_the_scan_of_stored_orders(spark, tmp_path):
    tables = shop_tables(spark, "/root/testdata/sf0.001")
    path = str(tmp_path / "orders")
    tables.orders.write.parquet(path)
    placed = spark.read.parquet(path)
    found = orders.study_bounds(placed)
    plan = _plan(orders.study_period(orders.clean_orders(placed), found.start, found.end).select("order_id"))
    assert "GreaterThanOrEqual(order_purchase_timestamp" in plan and "LessThan(order_purchase_timestamp" in plan
