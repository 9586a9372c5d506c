"""The five source tables together."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class ShopTables:
    """What every job starts from."""

    customers: DataFrame
    orders: DataFrame
    payments: DataFrame
    items: DataFrame
    reviews: DataFrame


def open_database(spark: SparkSession, database: str, names: Mapping[str, str] | None = None) -> ShopTables:
    """The tables of a bronze database; ``names`` maps a role to its table where they differ."""
    names = names or {}
    return ShopTables(
        **{field.name: spark.table(f"{database}.{names.get(field.name, field.name)}") for field in fields(ShopTables)}
    )
