"""Shards of near-equal size by sampled splitters.

A sample of keys, drawn with a chance in proportion to each row's size, gives the boundaries of
many small key ranges of similar size. The ranges are measured; one that is overfull, because one
key or a few hold much of it, is divided further by the tie-breaking columns. Running sizes across
ranges (a small table) and within each range (a window over one range) give every row its place in
the whole, and the place gives the shard and the slot.

Defined results: a null size counts as ``0``; where all sizes are 0 each row counts as 1; null keys come first. Rows that are equal in key and
tie-breakers are interchangeable, so any order among them gives the same table. An empty table
gives an empty result. The input's columns stay, whatever their names; the new columns are
``shard`` and ``slot`` unless other names are given, and replace input columns of these names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.frames import fresh, place_among

#: A range holds about so many bytes, within the two limits per shard that follow.
RANGE_BYTES = 128 << 20
RANGES_PER_SHARD = (16, 512)
#: Sampled keys per range, 24 * 512 * 32 at most for 24 shards; the driver gets one boundary per range.
SAMPLES = 32
#: A range of more than so many times the mean is divided.
OVERFULL = 2


def splitters(keys: DataFrame, ranges: int, total: int) -> list[int]:
    """At most ``ranges - 1`` ascending keys that cut the rows (``key``, ``size``, ``tie``) into ranges of
    near-equal size, from a sample weighted by size. The draw is by hash, so that a lost task draws again the same."""
    chance = F.col("size") * F.lit(ranges * SAMPLES / total)
    draw = F.pmod(F.xxhash64("key", "tie", F.lit("splitter")), F.lit(1 << 52)) / F.lit(float(1 << 52))
    drawn = keys.where(draw < chance).select("key", F.greatest(chance, F.lit(1.0)).alias("weight"))
    # The sample has some SAMPLES rows per range, whatever the input's size: one task orders it.
    ordered = Window.orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sample = drawn.where(F.col("key").isNotNull()).withColumn("reached", F.sum("weight").over(ordered)).withColumn("all", F.sum("weight").over(whole))
    # A key is a boundary if a multiple of a range's share is reached with it.
    share = ranges / F.col("all")
    before, with_it = F.floor((F.col("reached") - F.col("weight")) * share), F.floor(F.col("reached") * share)
    bounds = sample.where((with_it > before) & (before < ranges - 1)).select("key").distinct()
    return sorted(row["key"] for row in bounds.collect())


def shard(
    df: DataFrame,
    shards: int,
    key: Column,
    size: Column,
    ties: list[Column],
    shard_name: str = "shard",
    slot_name: str = "slot",
) -> DataFrame:
    """``df`` range-partitioned by the 64-bit ``key`` into ``shards`` runs of near-equal total ``size``."""
    names = {n: fresh(df.columns, f"_{n}") for n in ("key", "size", "tie", "range", "part", "row", "before", "pieces")}
    own = [c for c in df.columns if c.lower() not in (shard_name.lower(), slot_name.lower())]
    tie = F.xxhash64(*ties)
    keyed = df.select(
        *[df[f"`{c}`"] for c in own],
        key.alias(names["key"]),
        F.coalesce(size, F.lit(0)).cast("long").alias(names["size"]),
        tie.alias(names["tie"]),
    )
    light = keyed.select(*[F.col(names[n]).alias(n) for n in ("key", "size", "tie")])
    total, rows = light.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    result = [*own]
    if not total:  # rows of no size are dealt out by their number
        keyed, light, total = keyed.withColumn(names["size"], F.lit(1).cast("long")), light.withColumn("size", F.lit(1).cast("long")), rows
    if not rows:
        return df.select(*own, F.lit(0).alias(shard_name), F.lit(0).cast("long").alias(slot_name))
    few, many = (n * shards for n in RANGES_PER_SHARD)
    ranges = min(max(few, math.ceil(total / RANGE_BYTES)), many)
    bounds = splitters(light, ranges, total)

    def ranged(rows: DataFrame, key: str, out: str) -> DataFrame:
        among = F.array(*map(F.lit, bounds)) if bounds else F.array().cast("array<bigint>")
        place = place_among(among, F.col(key), len(bounds))
        return rows.withColumn(out, F.when(F.col(key).isNull(), -1).otherwise(place))

    # Every table from here to `starts` has at most a few rows per range.
    measured = ranged(light, "key", "range").groupBy("range").agg(F.sum("size").alias("bytes"))
    pieces = measured.where(F.col("bytes") > OVERFULL * total / ranges).select(
        "range", F.ceil(F.col("bytes") * ranges / F.lit(total)).alias("pieces")
    )
    overfull = {r["range"]: int(r["pieces"]) for r in pieces.collect()}

    def parted(rows: DataFrame, range_: str, tie: str, out: str) -> DataFrame:
        if not overfull:
            return rows.withColumn(out, F.lit(0).cast("long"))
        many = F.create_map(*[F.lit(x) for pair in overfull.items() for x in pair])
        return rows.withColumn(out, F.pmod(F.col(tie), F.coalesce(many[F.col(range_)], F.lit(1))).cast("long"))

    placed = parted(ranged(light, "key", "range"), "range", "tie", "part")
    sums = placed.groupBy("range", "part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    in_order = Window.orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "range",
        "part",
        F.coalesce(F.sum("bytes").over(in_order), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(in_order), F.lit(0)).alias("rows_before"),
    ).collect()
    offsets = df.sparkSession.createDataFrame(offsets, "range int, part long, bytes_before long, rows_before long")

    def numbered(rows: DataFrame, n: dict[str, str]) -> DataFrame:
        """Shard and row number of each row in the whole order."""
        within = Window.partitionBy(n["range"], n["part"]).orderBy(n["key"], n["tie"], n["size"])
        there = F.broadcast(offsets.withColumnsRenamed({"range": n["range"], "part": n["part"], "bytes_before": n["before"], "rows_before": n["pieces"]}))
        running = F.sum(n["size"]).over(within.rowsBetween(Window.unboundedPreceding, 0))
        middle = F.col(n["before"]) + running - F.col(n["size"]) / 2
        return rows.join(there, [n["range"], n["part"]]).select(
            *rows.columns,
            F.least(F.floor(middle * shards / F.lit(total)), F.lit(shards - 1)).cast("int").alias(shard_name),
            (F.col(n["pieces"]) + F.row_number().over(within) - 1).alias(n["row"]),
        )

    plain = {n: n for n in names}
    starts = numbered(placed, plain).groupBy(shard_name).agg(F.min("row").alias("first"))
    starts = {r[shard_name]: r["first"] for r in starts.collect()}
    first = F.create_map(*[F.lit(x) for pair in starts.items() for x in pair])
    whole = parted(ranged(keyed, names["key"], names["range"]), names["range"], names["tie"], names["part"])
    return numbered(whole, names).select(
        *[F.col(f"`{c}`") for c in result],
        shard_name,
        (F.col(names["row"]) - first[F.col(shard_name)]).alias(slot_name),
    )
