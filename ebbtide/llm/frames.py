"""Small helpers that the operators share."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.session import working_folder

DOCUMENTS = "documents"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Small rows (a few numbers each) that are worth a task and a file of their own.
FILE_ROWS = 50_000


def stored(df: DataFrame, purpose: str, rows: int | None = None) -> DataFrame:
    """The same rows, written to the shared folder and read from there.

    This cuts the lineage: a lost executor costs the tasks it ran and not the steps before.

    ``rows`` is a bound on the small rows that the last step reads, where it is known: then no more tasks run that step, and write
    a file each, than these are worth. A file costs its task buffers and several calls of the file system, however short it is.
    """
    path = working_folder(df.sparkSession, purpose)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // FILE_ROWS)))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()

#: Bytes that Spark gathers for one Arrow batch, unless the session says otherwise. A batch is held several times over on its way
#: (its buffers as they grow, the worker's copy, what is made of it), and 10,000 texts, Spark's other bound, are much more.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20


def _released(function: Callable) -> Callable:
    """``function``, which hands memory back at a task's end: workers are used again, and keep what they have."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return run


def mapped(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow`` in batches of bounded size, after Spark has been given this package for its Python workers."""
    conf, context = df.sparkSession.conf, df.sparkSession.sparkContext
    if conf.get(BATCH, None) is None:
        conf.set(BATCH, str(BATCH_BYTES))
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        context.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name))
        _shipped.add(context.applicationId)
    return df.mapInArrow(_released(function), schema)


def fresh(taken: Iterable[str], wanted: str) -> str:
    """``wanted``, or with underscores in front until no column has that name."""
    names = {name.lower() for name in taken}
    while wanted.lower() in names:
        wanted = f"_{wanted}"
    return wanted


def named(df: DataFrame, name: str) -> Column:
    """The column of exactly this name, also if it holds dots."""
    return df[f"`{name.replace('`', '``')}`"]


def place_among(bounds: Column, key: Column, count: int) -> Column:
    """How many of the ``count`` ascending ``bounds`` are at most ``key``: a binary search."""
    steps = [1 << i for i in reversed(range(count.bit_length()))]
    if not steps:
        return F.lit(0)

    def step(place: Column, width: Column) -> Column:
        there = place + width
        fits = (there <= F.lit(count)) & (F.get(bounds, F.least(there, F.lit(count)) - 1) <= key)
        return F.when(fits, there).otherwise(place)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)


#: Keys up to this number may be broadcast (some 8 to 16 bytes each).
BROADCAST_KEYS = 1_000_000


def sized(keys: DataFrame, weight: int | None = None) -> DataFrame:
    """``keys`` (a stored table of a few numbers per row, or any of no more numbers than ``weight``), marked for a broadcast if it
    is small; otherwise the join shuffles."""
    size = keys.count() if weight is None else weight
    return F.broadcast(keys) if size <= BROADCAST_KEYS else keys


def task_keys(spark: SparkSession, tasks: int) -> list[int]:
    """A number for each of so many tasks, such that ``repartition(tasks, number)`` gives each number a task of its own."""
    drawn = spark.range(0, 60 * tasks, 1, 1).select("id", F.pmod(F.hash("id"), F.lit(tasks)).alias("task"))
    found = {r["task"]: r["id"] for r in drawn.groupBy("task").agg(F.min("id").alias("id")).collect()}
    return [found.get(task, task) for task in range(tasks)]


#: Words (64 bits each) of a sieve: a broadcast of at most so many rows.
SIEVE_WORDS = 1 << 20


def sieved(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """``rows`` whose 64-bit ``column`` may be among that of ``keys``: a Bloom filter of bounded size, looked up inside the
    rows' own tasks. It loses none; with very many keys it lets more others pass, and a join still decides."""
    def word(value: Column) -> Column:
        return F.pmod(value, F.lit(SIEVE_WORDS))

    def bits(value: Column) -> Column:
        spread = F.xxhash64(value)
        each = [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.shiftright(spread, by), F.lit(64)).cast("int")) for by in (0, 6, 12)]
        return each[0].bitwiseOR(each[1]).bitwiseOR(each[2])

    known = keys.groupBy(word(F.col(column)).alias("_word")).agg(F.bit_or(bits(F.col(column))).alias("_bits"))
    met = rows.join(F.broadcast(known), word(F.col(column)) == F.col("_word"))  # SIEVE_WORDS rows at most
    own = bits(F.col(column))
    return met.where(F.col("_bits").bitwiseAND(own) == own).select(*rows.columns)
