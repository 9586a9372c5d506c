"""A third of the rows on one key: the results stay whole and adaptive execution splits the joins."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from ebbtide.operators import evaluate, orders
from ebbtide.plans import jobs
from ebbtide.sources import files
from ebbtide.sources.star_schema import shop_tables

SMALL = {
    "spark.sql.shuffle.partitions": "32",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture()
def small_thresholds(spark):
    before = {key: spark.conf.get(key) for key in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture(scope="module")
def tables(spark):
    return shop_tables(spark, "/root/testdata/sf0.1")


def _third_on(column, key, by="order_id"):
    return F.when(F.pmod(F.xxhash64(by), F.lit(3)) == 0, F.lit(key)).otherwise(F.col(column))


def _rows(features):
    return {row.customer_unique_id: row.asDict() for row in features.collect()}


def _final_plan(collected):
    return collected._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def _without_adaptive(spark, features_of):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return _rows(features_of())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_customer_with_a_third_of_the_orders(spark, tables, small_thresholds):
    placed = tables.orders.repartition(8).withColumn("customer_id", _third_on("customer_id", 6))
    skewed = replace(tables, orders=placed)
    features = jobs.gold(skewed)
    rows = _rows(features)
    assert "skew=true" in _final_plan(features)
    assert max(row["frequency"] for row in rows.values()) > 5000
    assert rows == _without_adaptive(spark, lambda: jobs.gold(skewed))


def test_an_order_id_on_a_third_of_the_orders(spark, tables, small_thresholds, tmp_path):
    """Stored orders: the join with the details is split, and the features come out the same."""
    placed = tables.orders.repartition(8).withColumn("order_id", _third_on("order_id", 11))
    skewed = replace(tables, orders=placed)
    detailed = jobs.silver(skewed, f"{tmp_path}/silver")
    orders.order_facts(skewed.payments, skewed.items, skewed.reviews).write.parquet(f"{tmp_path}/facts")
    facts = spark.read.parquet(f"{tmp_path}/facts")
    joined = orders.clean_orders(placed).join(facts, "order_id", "left")
    assert len(joined.collect()) == detailed.count() == placed.count()
    assert "skew=true" in _final_plan(joined)
    assert _rows(jobs.gold(skewed, detailed=detailed)) == _without_adaptive(spark, lambda: jobs.gold(skewed))


def test_an_order_id_on_a_third_of_the_orders_directly(spark, tables, small_thresholds, monkeypatch):
    """From the source tables: the id's orders are dealt to several tasks, and the features are those without any of it."""
    placed = tables.orders.repartition(8).withColumn("order_id", _third_on("order_id", 11))
    skewed = replace(tables, orders=placed)
    plain = _rows(jobs.gold(skewed))
    monkeypatch.setattr(orders, "HOT_ORDERS", 100)
    words = orders.order_filter(placed)
    hot = orders.hot_words(words).collect()
    assert len(hot) == 1 and hot[0]["_salts"] >= 50_000 // 100
    master, _ = jobs.study(skewed)
    assert "_salt" in _final_plan(master)
    # One task would hold all of the id's rows; dealt, none holds a tenth of them.
    most = master.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert most < master.filter("order_id = 11").count() / 5
    assert _rows(jobs.gold(skewed)) == plain


def test_an_order_id_on_a_third_of_the_stored_orders(spark, tables, small_thresholds, tmp_path, monkeypatch):
    """The id's orders are dealt to several tasks; stored orders are those of plain joins, and nothing else is written before."""
    placed = tables.orders.repartition(8).withColumn("order_id", _third_on("order_id", 11))
    skewed = replace(tables, orders=placed)
    written = []
    write = files.write_table
    monkeypatch.setattr(files, "write_table", lambda df, path, *args, **more: (written.append((path, df)), write(df, path, *args, **more)))
    plain = jobs.silver(skewed, f"{tmp_path}/plain")
    assert [path for path, _ in written] == [f"{tmp_path}/plain/orders"]
    assert orders.hot_ids(placed).isEmpty()
    monkeypatch.setattr(orders, "HOT_ORDERS", 1000)
    hot = orders.hot_ids(placed).collect()
    assert hot == orders.hot_words(orders.order_filter(placed)).collect() and len(hot) == 1 and hot[0]["_salts"] >= 50
    dealt = jobs.silver(skewed, f"{tmp_path}/dealt")
    assert [path for path, _ in written[1:]] == [f"{tmp_path}/dealt/orders"] and "_salt" in _final_plan(written[-1][1])
    assert dealt.columns == plain.columns and dealt.dtypes == plain.dtypes
    assert dealt.exceptAll(plain).count() == 0 and dealt.count() == plain.count() == placed.count()


def test_details_of_other_orders_do_not_leave_the_scan(spark, tables):
    placed = tables.orders.filter("order_purchase_timestamp >= '2000-06-01'")
    other = tables.orders.filter("order_purchase_timestamp < '2000-06-01'")
    words = orders.order_filter(placed)
    for details in (tables.payments, tables.items, tables.reviews):
        passed = orders.of_orders(details, words)
        assert passed.columns == details.columns
        wanted = details.join(placed, "order_id", "left_semi")
        assert wanted.select(*details.columns).exceptAll(passed).count() == 0
        assert passed.join(other, "order_id", "left_semi").count() <= 0.02 * details.count()
    plan = jobs.gold(tables)._jdf.queryExecution().executedPlan().toString()
    for aggregate in ("partial_sum(payment_value", "partial_count(product_id", "partial_min(review_score"):
        below = plan[plan.index(aggregate) :]
        assert "_bits" in below[: below.index("Scan parquet")]
    # Hash collisions and null ids lose and double nothing.
    odd = spark.createDataFrame([(None, 1), (1, 2), (1, 2), (2, 3)], "order_id bigint, v int")
    few = orders.order_filter(spark.createDataFrame([(1,), (1,), (None,)], "order_id bigint"))
    assert sorted(r.v for r in orders.of_orders(odd, few).collect() if r.order_id is not None) == [2, 2]


def test_an_order_with_a_third_of_the_payments_is_combined_before_the_shuffle(spark, tables):
    hot = tables.payments.withColumn("order_id", _third_on("order_id", 5, "payment_value"))
    df = orders.payments_by_order(hot)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_sum") > plan.index("Exchange hashpartitioning(order_id")
    row = df.filter("order_id = 5").first()
    direct = hot.filter("order_id = 5").agg(F.sum("payment_value"), F.count("*")).first()
    assert (row.total_order_payment, row.payment_method_count) == tuple(direct)


def test_stored_orders_give_the_same_features(spark, tmp_path):
    tables = shop_tables(spark, "/root/testdata/sf0.001")
    direct, stored = jobs.gold(tables), jobs.gold(tables, detailed=jobs.silver(tables, str(tmp_path)))
    assert direct.exceptAll(stored).count() == 0 and stored.exceptAll(direct).count() == 0


def test_order_facts_equal_the_full_outer_join(spark):
    tables = shop_tables(spark, "/root/testdata/sf0.001")
    parts = (
        orders.payments_by_order(tables.payments.filter("order_id % 3 > 0")),
        orders.items_by_order(tables.items.filter("order_id % 5 > 0")),
        orders.reviews_by_order(tables.reviews),
    )
    joined = parts[0].join(parts[1], "order_id", "full").join(parts[2], "order_id", "full")
    facts = orders.order_facts(
        tables.payments.filter("order_id % 3 > 0"), tables.items.filter("order_id % 5 > 0"), tables.reviews
    ).select(joined.columns)
    assert facts.exceptAll(joined).count() == 0 and joined.exceptAll(facts).count() == 0
    plan = facts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(order_id") == 3 == plan.count("Exchange ")
    assert facts.filter("total_items IS NULL").count() > 0 and facts.filter("Total_Review_Number IS NULL").count() > 0


def test_area_does_not_depend_on_the_number_of_ranges(spark, tables):
    scored = tables.payments.select(
        F.when(F.pmod(F.xxhash64("order_id"), F.lit(3)) == 0, 0.5).otherwise(F.col("payment_value")).alias("score"),
        (F.col("payment_type") == "R").cast("int").alias("churn"),
    )
    found = [evaluate.auc_roc(scored, ranges=n).first().auc_roc for n in (1, 5, 1000)]
    assert found[0] == pytest.approx(found[1], abs=1e-12) == pytest.approx(found[2], abs=1e-12)
