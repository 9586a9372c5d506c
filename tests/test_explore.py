"""Exploration against pandas, numpy and hand counts."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.operators import customers, explore
from ebbtide.plans import jobs


def _numbers(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def test_summary_matches_pandas(gold):
    frame = gold.toPandas()
    found = {r.column_name: r for r in explore.describe(gold).collect()}
    assert set(found) == set(gold.columns)
    for name in customers.FEATURES:
        row, column = found[name], frame[name]
        assert row["count"] == column.count()
        assert row.mean == pytest.approx(column.mean()) and row.stddev == pytest.approx(column.std())
        assert (row.min, row.max) == (column.min(), column.max()) and row.min_text is None
    assert (found["city"].min_text, found["city"].max_text) == (frame.city.min(), frame.city.max())
    assert found["city"].mean is None and found["zip_code"].mean == pytest.approx(frame.zip_code.astype(int).mean())


def test_summary_counts_present_values_only(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "n int, t string")
    found = {r.column_name: r for r in explore.describe(df).collect()}
    assert (found["n"]["count"], found["n"].mean, found["t"]["count"]) == (2, 2.0, 2)


def test_summary_averages_text_that_reads_as_numbers(spark):
    words = ["7", " -1.5 ", "+.5", "1e2", "nan x", "b12", "", "-"]
    row = explore.describe(spark.createDataFrame([(w,) for w in words], "t string")).first()
    assert (row["count"], row.mean, row.max_text) == (8, pytest.approx((7 - 1.5 + 0.5 + 100) / 4), "nan x")
    with pytest.raises(ValueError, match="no numeric or string column"):
        explore.describe(spark.createDataFrame([(True,)], "flag boolean"))


def test_shares_add_up_and_skip_nulls(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (0,), (None,)], "churn int")
    assert {(r.churn, r.rows, r.percent) for r in explore.value_share(df, "churn").collect()} == {
        (1, 3, 75.0),
        (0, 1, 25.0),
    }


def test_correlation_matches_pandas_pairwise_with_nulls(spark):
    rows = [(1.0, 2.0, None), (2.0, 1.0, 5.0), (3.0, None, 7.0), (4.0, 8.0, 1.0), (5.0, 9.0, 2.5)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    expected = df.toPandas().corr()
    found = explore.correlation(df, ["a", "b", "c"]).collect()
    assert len(found) == 9
    for row in found:
        assert row.correlation == pytest.approx(expected.loc[row.column_a, row.column_b])


def test_histogram_matches_numpy(gold):
    frame = gold.toPandas()
    rows = explore.histogram(gold, bins=15).orderBy("column_name", "bin").collect()
    for name in explore.HISTOGRAM_COLUMNS:
        counts, edges = np.histogram(frame[name], bins=15)
        mine = [r for r in rows if r.column_name == name]
        assert sum(r.rows for r in mine) == len(frame)
        assert [r.lower for r in mine] == pytest.approx(list(edges[:-1]))
        # A value on an inner edge may fall on either side of it by the last digit of the width.
        assert sum(abs(r.rows - c) for r, c in zip(mine, counts)) <= 0.1 * len(frame)


def test_histogram_keeps_empty_bins_closes_the_last_and_skips_nulls(spark):
    rows = explore.histogram(_numbers(spark, [0.0, 1.0, 10.0, 10.0, None]), ["x"], bins=5).orderBy("bin").collect()
    assert [r.rows for r in rows] == [2, 0, 0, 0, 2]


def test_histogram_of_one_value(spark):
    rows = explore.histogram(_numbers(spark, [3, 3, 3], "int"), ["x"], bins=4).orderBy("bin").collect()
    assert [r.rows for r in rows] == [3, 0, 0, 0]
    assert explore.density(_numbers(spark, [3, 3], "int"), ["x"]).collect() == []


def test_density_is_the_gaussian_sum_over_all_values(spark):
    values = [0.0, 1.0, 1.5, 2.0, 2.0, 7.0, 8.0]
    width = np.std(values, ddof=1) * len(values) ** -0.2
    rows = explore.density(_numbers(spark, values), ["x"]).collect()
    for row in rows:
        kernel = sum(math.exp(-0.5 * ((row.x - v) / width) ** 2) for v in values)
        assert row.x == pytest.approx(row.point * width / 2)
        assert row.density == pytest.approx(kernel / (len(values) * width * math.sqrt(2 * math.pi)), abs=1e-7)
    assert {r.point for r in rows} >= set(range(math.ceil(min(values) / width * 2), math.floor(max(values) / width * 2)))


@pytest.mark.parametrize("count", [1_000, 100_000, 1_000_000])
def test_area_below_the_density_is_one(spark, count):
    drawn = spark.range(count).select(F.randn(3).alias("normal"), F.exp(F.randn(5)).alias("lognormal"))
    areas = explore.density(drawn, ["normal", "lognormal"]).groupBy("column_name").agg(F.sum(F.col("density") * F.col("step")).alias("area"))
    assert {r.column_name: r.area for r in areas.collect()} == {"normal": pytest.approx(1, abs=1e-3), "lognormal": pytest.approx(1, abs=1e-3)}


def test_top_categories_rank_by_count_then_value(spark):
    df = spark.createDataFrame([("b",), ("b",), ("a",), ("c",), ("c",), (None,), (None,), (None,)], "state string")
    rows = explore.top_categories(df, ["state"], k=2).orderBy("place").collect()
    assert [(r.value, r.rows, r.place) for r in rows] == [("b", 2, 1), ("c", 2, 2)]


def test_top_categories_are_cut_before_the_ranking_shuffle(gold):
    plan = explore.top_categories(gold)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_all_exploration_tables(gold):
    tables = jobs.eda(gold)
    assert set(tables) == {"describe", "class_share", "histogram", "density", "top_categories", "correlation"}
    assert all(table.count() > 0 for table in tables.values())


def _close(one, other):
    """The same rows; doubles up to the last digits."""
    def plain(df):
        columns = sorted(df.columns)
        return sorted((tuple(f"{r[c] if abs(r[c]) > 1e-12 else 0:.7g}" if isinstance(r[c], float) else r[c] for c in columns) for r in df.collect()), key=repr)

    return plain(one) == plain(other)


def test_value_counts_give_the_same_tables(spark, gold):
    """Also with nulls, columns of one value or none, and numbers in text."""
    odd = spark.range(200).selectExpr(
        "IF(id % 7 = 0, NULL, id % 5) AS n", "CAST(IF(id % 3 = 0, NULL, id / 9) AS DOUBLE) AS x", "3.5D AS same", "CAST(NULL AS DOUBLE) AS none",
        "CASE id % 4 WHEN 0 THEN '12' WHEN 1 THEN 'a' WHEN 2 THEN NULL ELSE '-0.5' END AS t", "CAST(id % 3 AS DECIMAL(9, 2)) AS money",
        "CAST(id % 2 AS INT) AS churn", "current_date() AS day",
    )
    numbers, texts = ["n", "x", "same", "none", "money"], ["t"]
    for df, plots, categories in ((gold, explore.HISTOGRAM_COLUMNS, explore.CATEGORY_COLUMNS), (odd, numbers, texts)):
        counts = explore.value_counts(df)
        whole = explore.describe(df)
        known = [r.column_name for r in whole.filter("count > 0").collect()]
        # A column without any value has no value counts, and so no row.
        assert _close(explore.describe_counts(counts), whole.filter(F.col("column_name").isin(known)))
        filled = [c for c in plots if c in known]
        assert _close(explore.histogram_counts(counts, plots), explore.histogram(df, filled))
        assert _close(explore.density_counts(counts, plots), explore.density(df, filled))
        assert _close(explore.top_categories_counts(counts, categories), explore.top_categories(df, categories))
        share = explore.value_share_counts(counts, "churn").select(F.col("number").cast("int").alias("churn"), "rows", "percent")
        assert _close(share, explore.value_share(df, "churn"))
    with pytest.raises(ValueError):
        explore.value_counts(odd.select("day"))


def test_exploration_scans_the_table_once(spark, gold):
    tables = jobs.eda(gold)
    files_read = {name: {f.rsplit("/", 1)[0] for f in df.inputFiles()} for name, df in tables.items()}
    counts = {name for name, read in files_read.items() if all("value-counts" in f for f in read)}
    assert counts == set(jobs.EXPLORATIONS)
    plan = explore.value_counts(gold)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
