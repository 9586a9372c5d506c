"""What a stored table was made from, period by period: enough to tell which periods have changed since.

A manifest has one row per period: the number of its rows and a digest that does not depend on their order. It is
kept beside the table as versions; the newest one counts. A version is appended after the table is in place, so a job that
is lost before that leaves the old version, and the next run does the same periods again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.operators import orders
from ebbtide.sources import files
from ebbtide.sources.shop import ShopTables

COLUMNS = ["period", "rows", "digest"]


def row_digest(df: DataFrame, *more: Column) -> Column:
    """A number for a whole row, wide enough to be added up; nulls count by their column."""
    columns = [df[f"`{name}`"] for name in df.columns]
    number = F.xxhash64(*more, *columns, *(column.isNull() for column in columns))
    return number.cast("decimal(20,0)")


def of_orders(tables: ShopTables, period: orders.StoredPeriod) -> DataFrame:
    """The manifest of the clean orders with all their details, by period of purchase.

    Details are added up by order before anything is joined: an order with very many is a row per task."""
    details = [
        rows.select(orders.ORDER, row_digest(rows, F.lit(i)).alias("digest"))
        for i, rows in enumerate((tables.payments, tables.items, tables.reviews))
    ]
    by_order = reduce(DataFrame.unionByName, details).groupBy(orders.ORDER).agg(F.sum("digest").alias("details"))
    placed = orders.clean_orders(tables.orders)
    own = placed.select(
        orders.ORDER, period.of(F.col(orders.PURCHASED)).cast("string").alias("period"), row_digest(placed).alias("digest")
    )
    total = F.sum(F.col("digest") + F.coalesce("details", F.lit(0)))
    counted = own.join(by_order, orders.ORDER, "left").groupBy("period").agg(F.count("*").alias("rows"), total.alias("digest"))
    return counted.withColumn("digest", F.col("digest").cast("string"))


def newest(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest version at ``path``; none if there is no manifest yet."""
    try:
        versions = files.read_table(spark, path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in str(missing):
            return None
        raise
    return versions.where(F.col("version") == versions.agg(F.max("version")).scalar()).select(*COLUMNS)


def append(manifest: DataFrame, path: str) -> None:
    """Add ``manifest`` as the newest version: one file, which appears as a whole."""
    spark = manifest.sparkSession
    try:
        last = files.read_table(spark, path).agg(F.max("version")).first()[0] or 0
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        last = 0
    files.write_table(manifest.withColumn("version", F.lit(last + 1)).coalesce(1), path, mode="append")


class Changes(NamedTuple):
    """First days of the periods that are new or differ, and of those that are gone."""

    changed: list[str]
    emptied: list[str]

    def all(self) -> Sequence[str]:
        return sorted([*self.changed, *self.emptied])


def changes(now: DataFrame, before: DataFrame) -> Changes:
    """Which periods differ: a row per period comes to the driver, none per order."""
    old = before.select("period", F.col("rows").alias("old_rows"), F.col("digest").alias("old_digest"))
    both = now.join(old, "period", "full").where(
        ~(F.col("rows").eqNullSafe(F.col("old_rows")) & F.col("digest").eqNullSafe(F.col("old_digest")))
    )
    found = both.select("period", F.col("rows").isNull().alias("gone")).collect()
    return Changes(sorted(r["period"] for r in found if not r["gone"]), sorted(r["period"] for r in found if r["gone"]))
