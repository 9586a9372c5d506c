"""Column expressions that Spark has no single function for.

Everything here returns a ``Column`` built from JVM-side functions, so it stays inside
whole-stage code generation and map-side aggregation.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def moment(df: DataFrame, column: str, value: str | datetime) -> Column:
    """``value`` as a literal of the type that ``df[column]`` has.

    Going through the text form avoids the Python/JVM time-zone conversion, and a literal of the
    column's own type (timestamp or timestamp_ntz) is what the parquet reader can push down.
    """
    return F.lit(str(value)).cast(df.schema[column].dataType)


def day_limit(df: DataFrame, column: str, value: str | datetime, days: int) -> Column:
    """Midnight at the start of the day ``days`` after ``value``, typed like ``df[column]``."""
    day = F.date_add(F.lit(str(value)).cast("timestamp_ntz").cast("date"), days)
    return day.cast(df.schema[column].dataType)


def earliest(value: str, *order: str, where: Column | None = None) -> Column:
    """Aggregate: the struct ``(*order, value)`` with the smallest ``order`` and a non-null value.

    A minimum over structs merges like any other minimum, so it combines map-side, can be
    minimised again over partial results, and does not depend on row order the way ``first`` does.
    """
    known = F.col(value).isNotNull()
    return F.min(F.when(known if where is None else known & where, F.struct(*order, value)))


def hash_number(key: str | Column) -> Column:
    """A stable number in ``[0, 2^32)`` from the key's text, independent of partitioning."""
    key = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")
