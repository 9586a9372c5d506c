"""Approximate nearest neighbours by inner product: cross-polytope hashing with several probes.

Vectors are split into ranges of doubling norms. Within a range they are scaled by its largest norm and get one more
coordinate that makes them unit vectors; the query's extra coordinate is 0. That turns the largest inner product into the
smallest angle, and keeps the extra coordinate small whatever other norms there are. A query probes every range that can
still hold a better score. Ranges of few vectors are not hashed: every query is compared with all of theirs.

Each table applies its own pseudo-rotation (three rounds of random signs and a fast Hadamard transform) and puts a vector
into the bucket of its nearest signed axis. A query probes, in each table, the buckets of the axes
nearest to it, and what the buckets hold is ranked by the exact inner product of the original vectors.

Equal vectors are one entry, with the smallest ids that any answer could need, so that a vector that a
third of all rows hold is one candidate. Queries are answered once per distinct vector too.

A table's buckets are dealt to cells of bounded size: an overfull bucket is split by its vectors' digests,
and many queries on one cell are split into blocks. Within a cell the inner products are one matrix
product. A first round over the nearest buckets gives each query its provisional k-th score; the
second, over the other probes, passes on only what beats it. So what is passed on stays close to
k per query and table, whatever the buckets hold. Queries that still lack candidates get a third round: all
buckets of the first table, which hold every vector.

Defined results: vectors that are null, zero or of another length than most have, or hold null or
non-finite components, take no part, neither as queries nor as candidates. Rows with a null id take no part.
Ties in the score go to the smaller id. Repeated rows with the same id count once per distinct vector.
A query whose probes hold fewer candidates than asked for is compared with all vectors; there are fewer rows only if there
are fewer candidates. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.frames import mapped, named, stored

#: Tables, and the share of each table's buckets that a query probes in the first round and in all.
TABLES, FIRST, PROBED = 10, 0.02, 0.12
SEED = 20_240_601
#: Vectors in a cell, and queries in a block, on average.
CELL, QUERIES = 8192, 2048
#: A range of norms with so many vectors at most is compared as a whole. Such ranges share one bucket of the first table.
WHOLE = 1024
POOL, ALL = 1 << 20, -1
#: Pairs of vectors whose exact products are taken at once.
PAIRS = 1 << 16


def padded(dimension: int) -> int:
    """Dimensions after the extra one and the padding that the Hadamard transform asks for."""
    return 1 << dimension.bit_length()


def _hadamard(x: np.ndarray) -> np.ndarray:
    """The fast transform of each row, scaled to keep lengths."""
    n = x.shape[1]
    width = 1
    while width < n:
        x = x.reshape(len(x), -1, 2, width)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(len(x), n)
        width *= 2
    return x / np.sqrt(n)


def rotated(x: np.ndarray, table: int) -> np.ndarray:
    signs = np.random.default_rng([SEED, table]).choice([-1.0, 1.0], size=(3, x.shape[1]))
    for row in signs:
        x = _hadamard(x * row)
    return x


def axes(x: np.ndarray, table: int) -> np.ndarray:
    """Closeness of each row to the 2 * n signed axes of a table."""
    y = rotated(x, table)
    return np.concatenate([y, -y], axis=1)


def unit(x: np.ndarray, largest: float, query: bool) -> np.ndarray:
    """Rows as unit vectors of the padded space."""
    out = np.zeros((len(x), padded(x.shape[1])))
    if query:
        out[:, : x.shape[1]] = x / np.linalg.norm(x, axis=1, keepdims=True)
    else:
        out[:, : x.shape[1]] = x / largest
        out[:, x.shape[1]] = np.sqrt(np.maximum(0.0, 1.0 - (out * out).sum(axis=1)))
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)


def _packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids and usable vectors as bytes, with their norm."""
    for batch in batches:
        ids, blobs, norms = [], [], []
        for key, value in zip(batch.column("id").to_pylist(), batch.column("vector").to_pylist(), strict=True):
            if key is None or not value or None in value:
                continue
            x = np.asarray(value, np.float64)
            norm = float(np.sqrt((x * x).sum())) if np.isfinite(x).all() else 0.0
            if norm > 0 and np.isfinite(norm):
                ids.append(key)
                blobs.append((x + 0.0).tobytes())  # one zero
                norms.append(norm)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(blobs, pa.binary()), pa.array(norms, pa.float64())], ["id", "vector", "norm"]
        )


def _bucketed(tables: int, largest: dict[int, float]):
    """(table, range, bucket) of each vector; ``largest`` has the largest norms of the ranges that are hashed."""

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            norms = batch.column("range").to_numpy()
            for level in np.unique(norms).tolist():
                some = batch.take(pa.array(np.flatnonzero(norms == level)))
                level, within = (level, tables) if level in largest else (POOL, 1)
                x = unit(_matrix(some.column("vector")), largest[level], query=False) if level != POOL else None
                for table in range(within):
                    bucket = np.full(some.num_rows, ALL) if x is None else axes(x, table).argmax(axis=1)
                    place = [np.full(some.num_rows, table), np.full(some.num_rows, level), bucket]
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(p.astype(np.int32)) for p in place), some.column("entry"), some.column("least"), some.column("vector")],
                        ["table", "range", "bucket", "entry", "least", "vector"],
                    )

    return assign


def _probes(tables: int, begin: int, end: int):
    """(table, bucket, query) for the nearest axes from the ``begin``-th to the ``end``-th. What is
    compared as a whole comes with the first of them."""

    def probe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unit(_matrix(batch.column("vector")), 1.0, query=True)
            if begin == 0:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), n, np.int32)) for n in (0, ALL)] + [batch.column("query")], ["table", "bucket", "query"]
                )
            for table in range(tables):
                near = np.argsort(-axes(x, table), axis=1, kind="stable")[:, begin:end].astype(np.int32)
                rows = np.repeat(np.arange(len(x)), near.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), table, np.int32)), pa.array(near.ravel()), batch.column("query").take(pa.array(rows))],
                    ["table", "bucket", "query"],
                )

    return probe


def _ranked(k: int):
    def rank(_: tuple, entries: pa.Table, queries: pa.Table) -> pa.Table:
        """The best of a cell for each of its queries: ``k``, and only what reaches the query's bound. Ties go to the smaller id."""
        found = [[], [], [], []]
        if entries.num_rows and queries.num_rows:
            entry, least = entries.column("entry").to_numpy(), entries.column("least").to_numpy()
            x = _matrix(entries.column("vector").combine_chunks())
            bucket = entries.column("bucket").to_numpy()
            order = np.argsort(bucket, kind="stable")
            entry, least, x, bucket = entry[order], least[order], x[order], bucket[order]
            lists = queries.column("buckets").combine_chunks()
            asked = lists.flatten().to_numpy()
            whose = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            query, bound = queries.column("query").to_numpy(), queries.column("bound").to_numpy()
            vectors = _matrix(queries.column("vector").combine_chunks())
            for b in np.unique(asked):
                low, high = np.searchsorted(bucket, b, "left"), np.searchsorted(bucket, b, "right")
                mine = whose[asked == b]
                for some in np.array_split(mine, -(-len(mine) // 256)):
                    if low == high:
                        continue
                    q = vectors[some]
                    scores = q @ x[low:high].T
                    slack = 1e-9 * (1 + np.abs(scores).max())
                    if scores.shape[1] > k:
                        kth = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
                    else:
                        kth = np.full(len(q), -np.inf)
                    row, column = np.nonzero(scores >= np.maximum(kth, bound[some])[:, None] - slack)
                    exact = np.concatenate([
                        np.einsum("ij,ij->i", q[row[i : i + PAIRS]], x[low + column[i : i + PAIRS]]) for i in range(0, len(row) or 1, PAIRS)
                    ])
                    best = np.lexsort((entry[low + column], least[low + column], -exact, row))
                    row, column, exact = row[best], column[best], exact[best]
                    kept = np.arange(len(row)) - np.searchsorted(row, row) < k
                    found[0].append(query[some][row[kept]])
                    found[1].append(entry[low + column[kept]])
                    found[2].append(least[low + column[kept]])
                    found[3].append(exact[kept])
        columns = [np.concatenate(f) if f else np.zeros(0, t) for f, t in zip(found, (np.int64, np.int64, np.int64, float), strict=True)]
        return pa.table(dict(zip(("query", "entry", "least", "score"), columns, strict=True)))

    return rank


def _best(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` distinct entries of each query."""
    once = found.groupBy("query", "entry").agg(F.max("score").alias("score"), F.min("least").alias("least"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "least", "entry")
    return once.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def search(
    vectors: DataFrame,
    id_: str,
    vector: str,
    is_query,
    k: int,
    tables: int = TABLES,
    first: float = FIRST,
    probed: float = PROBED,
) -> DataFrame:
    """For every row whose id makes the column expression ``is_query(id)`` true, its ``k`` nearest of all other rows:
    ``query_id``, ``rank`` from 1, ``id``, ``score``."""
    rows = vectors.select(named(vectors, id_).cast("long").alias("id"), named(vectors, vector).alias("vector"))
    packed = mapped(rows, _packed, "id long, vector binary, norm double")
    packed = stored(packed, "vectors")
    # The length that most vectors have; others take no part.
    lengths = packed.groupBy(F.octet_length("vector").alias("bytes")).agg(F.count("*").alias("n"))
    usual = lengths.orderBy(F.desc("n"), "bytes").first()
    empty = vectors.sparkSession.createDataFrame([], "query_id long, rank int, id long, score double")
    if usual is None:
        return empty
    packed = packed.where(F.octet_length("vector") == usual["bytes"])
    buckets = 2 * padded(usual["bytes"] // 8)
    # Entries are distinct vectors, numbered by their smallest id. An answer needs k ids of one and another k for its query.
    own = Window.partitionBy("vector").orderBy("id")
    members = packed.dropDuplicates(["vector", "id"]).withColumn("nth", F.row_number().over(own)).where(F.col("nth") <= k + 1)
    # Norms around a power of two share a range, so that those of unit vectors do.
    level = F.floor(F.log2(F.max("norm")) + 0.5).cast("int")
    entries = packed.groupBy("vector").agg(F.min("id").alias("entry"), F.max("norm").alias("norm"), level.alias("range"))
    entries = stored(entries, "entries")
    # Several vectors may have the same smallest id if ids repeat.
    entries = entries.withColumn("least", F.col("entry")).withColumn("entry", F.xxhash64("entry", "vector"))
    members = stored(members.select(F.xxhash64(F.min("id").over(Window.partitionBy("vector")), "vector").alias("entry"), "id", "vector"), "members")
    asking = packed.where(is_query(F.col("id"))).select("id", "vector").distinct()
    asking = stored(asking.join(entries, "vector").select(F.col("id").alias("query_id"), F.col("entry").alias("query"), "vector", "norm"), "queries")
    queries = stored(asking.groupBy("query").agg(F.first("vector").alias("vector"), F.first("norm").alias("norm")), "query-vectors")

    # A double's norm is in one of about 2,100 ranges.
    ranges = entries.groupBy("range").agg(F.max("norm").alias("largest"), F.count("*").alias("n")).where(F.col("n") > WHOLE).collect()
    largest = {r["range"]: r["largest"] for r in ranges}
    placed = "table int, range int, bucket int, entry long, least long, vector binary"
    index = mapped(entries.select("range", "entry", "least", "vector"), _bucketed(tables, largest), placed)
    index = stored(index, "index")
    held = index.groupBy("table", "range", "bucket").agg(F.count("*").alias("held"))
    per_cell = max(1, CELL * buckets // max(1, entries.count()))  # buckets in a cell, if they are small
    parts = F.ceil(F.col("held") / CELL).cast("int")
    cell = F.floor(F.col("bucket") / per_cell).cast("int")

    def round_(queries: DataFrame, tables: int, begin: int, end: int, bound: DataFrame | None) -> DataFrame:
        """One round of probes: dealt to cells, ranked there."""
        asked = mapped(queries, _probes(tables, begin, end), "table int, bucket int, query long")
        asked = asked.join(held, ["table", "bucket"])
        if bound is not None and len(largest) > 1:
            # A score is at most the product of the norms.
            reach = F.col("norm") * F.pow(F.lit(2.0), F.col("range") + 0.5) * (1 + 1e-6)
            limits = queries.select("query", "norm").join(bound, "query")
            asked = asked.join(limits, "query", "left").where(F.col("bound").isNull() | (F.col("bound") <= reach))
        # The alias tells the column from the index's own in the join of cells.
        asked = asked.select("table", F.col("range").alias("range"), "bucket", "query", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
        dealt = asked.groupBy("table", "range", cell.alias("cell"), "part").agg(F.approx_count_distinct("query").alias("asking"))
        dealt = dealt.select("table", "range", "cell", "part", F.ceil(F.col("asking") / QUERIES).cast("int").alias("blocks"))
        asked = asked.withColumn("cell", cell).join(dealt, ["table", "range", "cell", "part"])
        asked = asked.withColumn("block", F.pmod(F.xxhash64("query"), F.col("blocks")).cast("int"))
        keys = ["table", "range", "cell", "part", "block"]
        asked = asked.groupBy(*keys, "query").agg(F.collect_list("bucket").alias("buckets"))
        asked = asked.join(queries.select("query", "vector"), "query")
        asked = asked.join(bound, "query", "left") if bound is not None else asked.withColumn("bound", F.lit(None).cast("double"))
        asked = asked.select(*keys, "buckets", "query", "vector", F.coalesce("bound", F.lit(float("-inf"))).alias("bound"))
        there = index.join(held, ["table", "range", "bucket"]).select(
            "table", "range", cell.alias("cell"), F.pmod(F.xxhash64("entry"), parts).cast("int").alias("part"), "bucket", "entry", "least", "vector"
        )
        there = there.join(dealt, ["table", "range", "cell", "part"]).select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        cells = there.groupBy(*keys).cogroup(asked.groupBy(*keys))
        return _best(cells.applyInArrow(_ranked(k + 1), "query long, entry long, least long, score double"), k + 1)

    near = max(1, round(first * buckets))
    far = min(buckets, max(near + 1, round(probed * buckets)))
    early = stored(round_(queries, tables, 0, near, None), "early")
    bound = early.groupBy("query").agg(F.min("score").alias("bound"), F.count("*").alias("n")).where(F.col("n") > k).select("query", "bound")
    late = round_(queries, tables, near, far, bound)
    best = _best(early.select("query", "entry", "least", "score").unionByName(late.select("query", "entry", "least", "score")), k + 1)
    best = stored(best, "best-entries")
    enough = best.groupBy("query").agg(F.count("*").alias("n")).where(F.col("n") > k).select("query")
    short = stored(queries.join(enough, "query", "left_anti"), "short-queries")
    if largest and not short.isEmpty():
        whole = round_(short, 1, 0, buckets, None)
        full = best.join(short.select("query"), "query", "left_anti").select("query", "entry", "least", "score")
        best = stored(full.unionByName(whole.select("query", "entry", "least", "score")), "filled-entries")
    # From entries to rows: at most k + 1 ids each, without the query's own.
    answers = (
        asking.select("query_id", "query").join(best, "query").join(members.select("entry", "id"), "entry")
        .where(F.col("id") != F.col("query_id"))
        .groupBy("query_id", "id").agg(F.max("score").alias("score"))
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    answers = answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return answers.select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")
