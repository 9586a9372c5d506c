"""Exploration: summaries, shares, correlations, distributions and top categories.

Each operator reads its input once (twice where a range must be known first) for all columns, and
only the summary leaves the executors.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from ebbtide.operators.customers import FEATURES

# The columns looked at by default.
HISTOGRAM_COLUMNS = [
    "recency",
    "frequency",
    "monetary",
    "total_items_volume",
    "max_installments",
    "avg_satisfaction",
]
CATEGORY_COLUMNS = ["state", "primary_payment_type"]


def _rows_of(wide: DataFrame, structs: Sequence[Column]) -> DataFrame:
    """One output row per struct of each input row."""
    return wide.select(F.inline(F.array(*structs)))


def _as_number(text: Column) -> Column:
    """Text as double, null where it is none. Looking first spares a failed parse per word."""
    numeric = text.rlike(r"^[\x00-\x20]*[-+]?(\d|\.\d|(?i:inf|nan))")
    return F.when(numeric, text.try_cast("double"))


def _summary(df: DataFrame, columns: Sequence[str], text: bool) -> DataFrame:
    """The rows of ``describe`` for columns that are all numeric or all text."""
    measures, structs = [], []
    nothing = F.lit(None)
    for i, name in enumerate(columns):
        column = F.col(name)
        number = _as_number(column) if text else column.cast("double")
        measures += [
            F.count(column).alias(f"count_{i}"),
            F.avg(number).alias(f"mean_{i}"),
            F.stddev(number).alias(f"stddev_{i}"),
            F.min(column).alias(f"min_{i}"),
            F.max(column).alias(f"max_{i}"),
        ]
        extremes = {"min": F.col(f"min_{i}"), "max": F.col(f"max_{i}")}
        structs.append(
            F.struct(
                F.lit(name).alias("column_name"),
                *(F.col(f"{part}_{i}").alias(part) for part in ("count", "mean", "stddev")),
                *((nothing if text else value).cast("double").alias(part) for part, value in extremes.items()),
                *((value if text else nothing).cast("string").alias(f"{part}_text") for part, value in extremes.items()),
            )
        )
    return _rows_of(df.agg(*measures), structs)


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum of numeric and string columns.

    One row per column. Text is averaged where it reads as a number; its extremes are text, so
    they have columns of their own. Numbers and text are aggregated apart: the extremes of text
    cannot be kept in a hash aggregation's buffer and would slow down the numbers with them.
    """
    kinds = {field.name: field.dataType for field in df.schema}
    numbers = [name for name, kind in kinds.items() if isinstance(kind, NumericType)]
    texts = [name for name, kind in kinds.items() if isinstance(kind, StringType)]
    parts = []
    for chosen, text in ((numbers, False), (texts, True)):
        chosen = [name for name in chosen if columns is None or name in columns]
        if chosen:
            parts.append(_summary(df, chosen, text))
    if not parts:
        raise ValueError("there is no numeric or string column to describe")
    return reduce(DataFrame.unionByName, parts)


def value_share(df: DataFrame, column: str) -> DataFrame:
    """Percentage of rows per value of ``column``; nulls are left out."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    total = counts.agg(F.sum("rows")).scalar()
    return counts.withColumn("percent", F.col("rows") * 100.0 / total)


def correlation(df: DataFrame, columns: Sequence[str] = tuple(FEATURES)) -> DataFrame:
    """Pearson correlation of every pair of columns, over the rows where both are present.

    The result is the full matrix in long form. The pairs become rows that are combined map-side
    by pair number: one aggregation of two columns, where one aggregation of all pairs side by
    side would be too large to be compiled.
    """
    pairs = list(combinations_with_replacement(columns, 2))
    number = {name: F.col(name).cast("double") for name in columns}
    values = [
        F.struct(F.lit(i).alias("pair"), number[a].alias("a"), number[b].alias("b")) for i, (a, b) in enumerate(pairs)
    ]
    measured = _rows_of(df, values).groupBy("pair").agg(F.corr("a", "b").alias("correlation"))

    def name_of(side: int) -> Column:
        return F.array(*(F.lit(pair[side]) for pair in pairs))[F.col("pair")]

    def entry(a: Column, b: Column) -> Column:
        return F.struct(a.alias("column_a"), b.alias("column_b"), "correlation")

    first, second = name_of(0), name_of(1)
    one, both = F.array(entry(first, second)), F.array(entry(first, second), entry(second, first))
    return measured.select(F.inline(F.when(first == second, one).otherwise(both)))


def _long(df: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    """(column_name, value) rows of the non-null values of ``columns``."""
    structs = [F.struct(F.lit(name).alias("column_name"), F.col(name).cast(kind).alias("value")) for name in columns]
    return _rows_of(df, structs).filter(F.col("value").isNotNull())


def _ranges(df: DataFrame, columns: Sequence[str], bins: int) -> DataFrame:
    """One row per column: number of values, smallest value, bin width, standard deviation."""
    numbers = {name: F.col(name).cast("double") for name in columns}
    measures = [
        F.struct(
            F.count(column).alias("total"),
            F.min(column).alias("low"),
            ((F.max(column) - F.min(column)) / bins).alias("width"),
            F.stddev(column).alias("spread"),
        ).alias(f"m{i}")
        for i, column in enumerate(numbers.values())
    ]
    structs = [
        F.struct(F.lit(name).alias("column_name"), *(f"m{i}.{part}" for part in ("total", "low", "width", "spread")))
        for i, name in enumerate(columns)
    ]
    return _rows_of(df.agg(*measures), structs)


def _binned(values: DataFrame, ranges: DataFrame, bins: int) -> DataFrame:
    """The histogram of (column_name, value, rows) within ``ranges``."""
    position = F.floor((F.col("value") - F.col("low")) / F.nullif(F.col("width"), F.lit(0.0)))
    bin_of = F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1)).cast("int")
    counts = (
        values.join(F.broadcast(ranges), "column_name")  # one row per column, whatever the table's size
        .groupBy("column_name", bin_of.alias("bin"))
        .agg(F.sum("rows").alias("rows"))
    )
    grid = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return grid.join(counts, ["column_name", "bin"], "left").select(
        "column_name",
        "bin",
        (F.col("low") + F.col("bin") * F.col("width")).alias("lower"),
        (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("upper"),
        F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"),
        "total",
        "spread",
    )


def histogram(df: DataFrame, columns: Sequence[str] = tuple(HISTOGRAM_COLUMNS), bins: int = 20) -> DataFrame:
    """Rows per equal-width bin between each column's extremes; the last bin is closed.

    Empty bins are rows too. A column with a single value falls into bin 0.
    """
    one_each = _long(df, columns, "double").withColumn("rows", F.lit(1))
    return _binned(one_each, _ranges(df, columns, bins), bins)


#: The density's points lie half a bandwidth apart; a value adds to those within so many bandwidths.
REACH = 6


def _kernels(values: DataFrame, ranges: DataFrame) -> DataFrame:
    """The density of distinct (column_name, value, rows)."""
    bandwidth = F.col("spread") * F.pow(F.col("total"), F.lit(-0.2))
    # The spread of equal values need not come out as exactly 0.
    steps = ranges.filter((F.col("width") > 0) & (bandwidth > 0)).select("column_name", "total", (bandwidth / 2).alias("step"))
    nearest = F.col("value") / F.col("step")
    around = F.sequence(F.ceil(nearest - 2 * REACH), F.floor(nearest + 2 * REACH))
    kernel = F.exp(-0.5 * F.pow((F.col("point") - nearest) / 2, F.lit(2)))
    points = (
        values.join(F.broadcast(steps), "column_name")  # one row per column, whatever the table's size
        .withColumn("point", F.explode(around))
        .groupBy("column_name", "step", "total", "point")
        .agg(F.sum(F.col("rows") * kernel).alias("mass"))
    )
    return points.select(
        "column_name",
        "point",
        (F.col("point") * F.col("step")).alias("x"),
        "step",
        (F.col("mass") / (F.col("total") * 2 * F.col("step") * F.sqrt(2 * F.pi()))).alias("density"),
    )


def density(df: DataFrame, columns: Sequence[str] = tuple(HISTOGRAM_COLUMNS)) -> DataFrame:
    """Gaussian kernel density over all values of each column, wherever it is not practically zero.

    The bandwidth is ``stddev * n^(-1/5)``. Points are the multiples of half of it (``step``), so that their
    densities times the step add up to 1 whatever the number of rows, and outliers cost no empty points.
    Equal values are counted together first; each then adds to the 25 points around it, and points are summed
    map-side. A column with one distinct value, or none, has no density and no rows.
    """
    values = _long(df, columns, "double").groupBy("column_name", "value").agg(F.count("*").alias("rows"))
    return _kernels(values, _ranges(df, columns, 1))


def _ranked(counts: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("column_name").orderBy(F.desc("rows"), "value")
    return counts.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def top_categories(df: DataFrame, columns: Sequence[str] = tuple(CATEGORY_COLUMNS), k: int = 10) -> DataFrame:
    """The ``k`` most frequent values of each column, ties in value order; nulls are left out.

    Spark keeps at most ``k`` rows per column in each task before the ranking shuffle.
    """
    return _ranked(_long(df, columns, "string").groupBy("column_name", "value").agg(F.count("*").alias("rows")), k)


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """How often each value of each numeric and string column occurs: (column_name, number, text, rows), nulls left out.

    One scan from which the summary, shares, histogram, density and top categories follow; store it, and
    they read it instead of the data. Equal values are combined before they are sent."""
    structs = []
    for field in df.schema:
        if columns is not None and field.name not in columns:
            continue
        column, text = F.col(field.name), isinstance(field.dataType, StringType)
        if text or isinstance(field.dataType, NumericType):
            number = F.lit(None).cast("double") if text else column.cast("double")
            structs.append(F.struct(F.lit(field.name).alias("column_name"), number.alias("number"), (column if text else F.lit(None)).cast("string").alias("text")))
    if not structs:
        raise ValueError("there is no numeric or string column to count")
    known = F.col("number").isNotNull() | F.col("text").isNotNull()
    return _rows_of(df, structs).filter(known).groupBy("column_name", "number", "text").agg(F.count("*").alias("rows"))


def _spreads(values: DataFrame, *keys: str) -> DataFrame:
    """Per ``keys``: weighted mean and standard deviation of ``value``; rows without one are left out."""
    known = values.filter(F.col("value").isNotNull())
    means = known.groupBy(*keys).agg(F.sum("rows").alias("numbers"), (F.sum(F.col("value") * F.col("rows")) / F.sum("rows")).alias("mean"))
    apart = known.join(F.broadcast(means), list(keys))  # one row per column
    squares = F.sum(F.col("rows") * F.pow(F.col("value") - F.col("mean"), F.lit(2)))
    spread = F.when(F.first("numbers") > 1, F.sqrt(squares / (F.first("numbers") - 1)))
    return apart.groupBy(*keys).agg(F.first("mean").alias("mean"), spread.alias("spread"))


def describe_counts(counts: DataFrame) -> DataFrame:
    """``describe`` from value counts."""
    values = counts.withColumn("value", F.coalesce("number", _as_number(F.col("text"))))
    totals = counts.groupBy("column_name").agg(
        F.sum("rows").alias("count"),
        F.min("number").alias("min"),
        F.max("number").alias("max"),
        F.min("text").alias("min_text"),
        F.max("text").alias("max_text"),
    )
    both = totals.join(_spreads(values, "column_name").withColumnRenamed("spread", "stddev"), "column_name", "left")
    return both.select("column_name", "count", "mean", "stddev", "min", "max", "min_text", "max_text")


def value_share_counts(counts: DataFrame, column: str) -> DataFrame:
    """``value_share`` of a column from value counts; its values are numbers, or text."""
    mine = counts.filter(F.col("column_name") == column)
    total = mine.agg(F.sum("rows")).scalar()
    return mine.select("number", "text", "rows", (F.col("rows") * 100.0 / total).alias("percent"))


def _numbers(counts: DataFrame, columns: Sequence[str]) -> DataFrame:
    wanted = F.col("column_name").isin(list(columns)) & F.col("number").isNotNull()
    return counts.filter(wanted).select("column_name", F.col("number").alias("value"), "rows")


def _counted_ranges(values: DataFrame, bins: int) -> DataFrame:
    extremes = values.groupBy("column_name").agg(
        F.sum("rows").alias("total"), F.min("value").alias("low"), ((F.max("value") - F.min("value")) / bins).alias("width")
    )
    return extremes.join(_spreads(values, "column_name").drop("mean"), "column_name")


def histogram_counts(counts: DataFrame, columns: Sequence[str] = tuple(HISTOGRAM_COLUMNS), bins: int = 20) -> DataFrame:
    """``histogram`` from value counts; a column without values has no bins."""
    values = _numbers(counts, columns)
    return _binned(values, _counted_ranges(values, bins), bins)


def density_counts(counts: DataFrame, columns: Sequence[str] = tuple(HISTOGRAM_COLUMNS)) -> DataFrame:
    """``density`` from value counts."""
    values = _numbers(counts, columns)
    return _kernels(values, _counted_ranges(values, 1))


def top_categories_counts(counts: DataFrame, columns: Sequence[str] = tuple(CATEGORY_COLUMNS), k: int = 10) -> DataFrame:
    """``top_categories`` of text columns from value counts."""
    texts = counts.filter(F.col("column_name").isin(list(columns)) & F.col("text").isNotNull())
    return _ranked(texts.select("column_name", F.col("text").alias("value"), "rows"), k)
