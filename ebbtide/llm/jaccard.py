"""Exact Jaccard similarity join of documents as sets of word shingles, as a metric-space join.

Jaccard distance is a metric. The first pivots are single shingles in one global order, rarest first:
a document lies in the Voronoi region of its first shingle (to a set that holds it, the distance of a
pivot {s} is 1 - 1/n, to others it is 1, and ties go to the earlier pivot). A partner within the distance
may have another first shingle, but the bound on the overlap leaves it only the next few pivots:
those windows of the document are the regions that it is replicated into. The smaller document of
a pair needs fewer of them than the larger.

Inside a region that several distinct sets share, one set becomes the pivot and the distance of every other to it is
computed exactly. Sets within reach of it are linked to it, and so to each other: their pairs need no test. Of the rest
only pairs inside the window that the triangle inequality leaves (distances to the pivot differ by no more than the
join's distance, and so do the sizes) are compared, and only if nothing has linked them so far.

Large regions recurse. They are cut into rings around their pivot, by the same inequality: a ring is twice the join's
distance wide and overlaps the next by half, so that the pairs that may be linked lie within one. A ring that holds several components
is divided like the whole corpus, in an order of its own: shingles that its pivot lacks come first, so what all of its
sets share comes last and divides nothing. Regions of one ring with the same pivot are one. Rings of few sets are compared
at once in a task; within one that no division makes cheaper the pairs that share a window and can reach the overlap are compared. Each comparison is the exact size of an intersection.

Order is a matter of speed alone, so it comes from a bounded table: the most frequent cells of shingle digests,
counted over all documents. Sets are compared by 64-bit digests of their shingles.

Defined results: null and empty texts, and texts without words, have the empty set, which is linked with
nothing. Equal sets are one class, whatever their number, and are linked. Repeated rows each get their row.
A document without an id takes its component's smallest id, null if there is none. An empty table
gives an empty result. Whole texts are read, nothing is capped.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm import hashing
from ebbtide.llm.frames import fresh, mapped, named, sized, stored

WORDS = 5
PERCENT = 75
#: Cells of this many bits are counted; those in so many documents or more are frequent, and the driver
#: keeps this many of them at most (8 bytes each).
CELL_BITS, FREQUENT, KEPT = 32, 24, 200_000
#: Shingles that a task gathers before it sends their cells on.
GATHERED = 2_000_000


def _sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The shingle set of every text of a column."""
    table = hashing.spaced_words()
    data, offsets = hashing.text_bytes(column)
    for _, words, marks in hashing.words_of(data, offsets, table):
        for a, b in zip(marks[:-1].tolist(), marks[1:].tolist(), strict=True):
            yield hashing.shingles(words[a:b], width)


def _class_of(found: np.ndarray) -> int:
    """A digest of the whole set."""
    with np.errstate(over="ignore"):
        total = np.add.reduce(hashing.mix(found ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)
        return int(hashing.mix(np.array([total ^ np.uint64(len(found))]))[0].astype(np.int64))


# -- how frequent shingles are ----------------------------------------------------------------------


def _cells(width: int, ranges: int):
    """Cells of the shingles of each distinct set of a task, ascending, as differences: one row per range."""
    low_bits = CELL_BITS - ranges.bit_length() + 1

    def rows(gathered: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        cells = np.concatenate([(found >> np.uint64(64 - CELL_BITS)).astype(np.uint32) for found in gathered])
        cells.sort()
        cuts = np.append(np.searchsorted(cells, np.arange(ranges, dtype=np.uint32) << np.uint32(low_bits)), len(cells))
        low = cells & np.uint32((1 << low_bits) - 1)
        blobs = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            steps = np.diff(low[a:b], prepend=np.uint32(0))
            wide = steps >= 0xFFFF
            blobs.append(np.where(wide, 0xFFFF, steps).astype("<u2").tobytes() + steps[wide].astype("<u4").tobytes())
        used = np.diff(cuts)
        kept = np.flatnonzero(used)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kept.astype(np.int32)), pa.array(used[kept].astype(np.int32)), pa.array([blobs[i] for i in kept], pa.binary())],
            ["range", "cells", "steps"],
        )

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, size, seen = [], 0, set()
        for batch in batches:
            for found in _sets(batch.column(0), width):
                if len(found) and (own := _class_of(found)) not in seen:
                    seen.add(own)
                    gathered.append(found)
                    size += len(found)
                    if size >= GATHERED:
                        yield from rows(gathered)
                        gathered, size, seen = [], 0, set()
        if gathered:
            yield from rows(gathered)

    return gather


def _frequent(ranges: int):
    low_bits = CELL_BITS - ranges.bit_length() + 1

    def count(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cells of one range in FREQUENT sets or more."""
        parts = []
        for batch in batches:
            for size, blob in zip(batch.column("cells").to_pylist(), batch.column("steps"), strict=True):
                buffer = blob.as_buffer()
                steps = np.frombuffer(buffer, "<u2", size).astype(np.uint32)
                steps[steps == 0xFFFF] = np.frombuffer(buffer, "<u4", offset=2 * size)
                parts.append(np.cumsum(steps, dtype=np.uint32))
        cells = np.sort(np.concatenate(parts))
        first = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
        many = np.diff(np.append(first, len(cells)))
        kept = many >= FREQUENT
        cell = (cells[first[kept]].astype(np.int64)) + (int(key[0].as_py()) << low_bits)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(many[kept].astype(np.int64))], ["cell", "sets"])

    return count


def frequent_cells(texts: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent cells, ascending, and in how many sets each occurs."""
    partitions = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = 1 << max(8, (16 * partitions - 1).bit_length())
    cells = mapped(texts, _cells(width, ranges), "range int, cells int, steps binary")
    counted = cells.groupBy("range").applyInArrow(_frequent(ranges), "cell long, sets long")
    top = counted.orderBy(F.desc("sets"), "cell").limit(KEPT).collect()
    cell, sets = (np.array([r[i] for r in top], dtype=np.int64) for i in (0, 1))
    order = np.argsort(cell)
    return cell[order].astype(np.uint64), sets[order]


# -- regions ----------------------------------------------------------------------------------------


def _ordered(found: np.ndarray, cells: np.ndarray, sets: np.ndarray) -> np.ndarray:
    """The set in the global order: shingles outside the table first, then rarest first."""
    if not len(cells):
        return found
    own = found >> np.uint64(64 - CELL_BITS)
    at = np.minimum(np.searchsorted(cells, own), len(cells) - 1)
    rank = np.where(cells[at] == own, sets[at], 0)
    return found[np.argsort(rank, kind="stable")]


def _windows(width: int, percent: int, cells: np.ndarray, sets: np.ndarray):
    """Rows (pivot shingle, class, set size, the shingle's place in the order), once per class and task."""

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            keys, own, sizes, places = [], [], [], []
            for found in _sets(batch.column(0), width):
                n = len(found)
                if not n or (cid := _class_of(found)) in seen:
                    continue
                seen.add(cid)
                windows = n - -(-percent * n // 100) + 1
                keys.append(_ordered(found, cells, sets)[:windows].view(np.int64).copy())  # not the whole set behind it
                own.append(cid)
                sizes.append(n)
                places.append(np.arange(windows, dtype=np.int32))
            if keys:
                times = [len(k) for k in keys]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(keys)),
                        pa.array(np.repeat(np.array(own, np.int64), times)),
                        pa.array(np.repeat(np.array(sizes, np.int32), times)),
                        pa.array(np.concatenate(places)),
                    ],
                    ["key", "cid", "n", "place"],
                )
            if len(seen) > 2_000_000:
                seen.clear()

    return emit


def _shared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows in the order (key, place, cid): those of keys with two distinct classes or more, with the region's
    pivot, its first class. That is the set with the fewest rarer shingles, so in a group of near copies the one with the
    fewest words of its own: it is close to most others, and the same one in most of the group's regions. A region's rows pass one by one; only its first is held."""
    names = ["key", "cid", "n", "place"]
    last = None  # key and class of the row before this batch
    pivot = None  # (key, cid, n, place, whether it was sent)
    for batch in batches:
        key, cid, n, place = (batch.column(c).to_numpy(zero_copy_only=False) for c in names)
        if not len(key):
            continue
        again = np.zeros(len(key), bool)
        again[1:] = (key[1:] == key[:-1]) & (cid[1:] == cid[:-1])
        if last is not None:
            again[0] = key[0] == last[0] and cid[0] == last[1]
        last = (key[-1], cid[-1])
        key, cid, n, place = (x[~again] for x in (key, cid, n, place))
        if not len(key):
            continue
        held = 0
        if pivot is not None and pivot[0] == key[0] and not pivot[4]:
            key, cid, n, place = (np.concatenate(([v], x)) for v, x in zip(pivot[:4], (key, cid, n, place), strict=True))
        elif pivot is not None and pivot[0] == key[0]:
            held = 1  # the pivot has gone out with an earlier batch
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        group = np.cumsum(np.concatenate(([0], (key[1:] != key[:-1]).astype(np.int64))))
        of = cid[first].copy()
        of_n = n[first].copy()
        of_place = place[first].copy()
        if held:
            of[0], of_n[0], of_place[0] = pivot[1:4]
        sizes = np.diff(np.append(first, len(key)))
        sent = sizes[group] > 1
        if held:
            sent |= group == 0
        tail = first[-1]
        if not (held and len(first) == 1):
            pivot = (key[tail], cid[tail], n[tail], place[tail], bool(sizes[-1] > 1))
        if sent.any():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key[sent].astype(np.int64)),
                    pa.array(cid[sent].astype(np.int64)),
                    pa.array(n[sent].astype(np.int32)),
                    pa.array(place[sent].astype(np.int32)),
                    pa.array(of[group][sent].astype(np.int64)),
                    pa.array(of_n[group][sent].astype(np.int32)),
                    pa.array(of_place[group][sent].astype(np.int32)),
                ],
                [*names, "pivot", "pivot_n", "pivot_place"],
            )


def _reachable(percent: int, n_a: Column, place_a: Column, n_b: Column, place_b: Column) -> Column:
    """Whether two sets that first meet in this region can be linked: they share this shingle and at most what follows
    it in both. A pair that is linked passes in the first region that both are in, so no other test is needed."""
    return F.least(n_a - place_a, n_b - place_b) * (100 + percent) >= (n_a + n_b) * percent


# -- exact comparison -------------------------------------------------------------------------------

#: Sets compared with one pivot in one group, on average.
COMPARED = 4096
#: A region of so many sets at most is not divided; a ring of so many sets and shingles at most is compared in one task.
UNDIVIDED, TOGETHER, SHINGLES = 64, 256, 1 << 20


def _sent(width: int):
    """From (text, cid, groups that need its set): rows (group's pivot, part, whether another set, class, set), once per task."""

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, seen = ["a", "part", "other", "b", "set"], set()
        for batch in batches:
            out, size = [[], [], [], [], []], 0
            cids, groups = batch.column("cid").to_pylist(), batch.column("groups").to_pylist()
            for cid, wanted, found in zip(cids, groups, _sets(batch.column("text"), width), strict=True):
                if cid in seen:
                    continue
                seen.add(cid)
                blob = found.tobytes()
                for group in wanted:
                    for column, value in zip(out, (group["a"], group["part"], cid != group["a"], cid, blob), strict=True):
                        column.append(value)
                    size += len(blob)
                    if size > 4 << 20:
                        yield _group_rows(out, names)
                        out, size = [[], [], [], [], []], 0
            yield _group_rows(out, names)

    return send


def _group_rows(out: list[list], names: list[str]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)


def _beside_pivots(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple[int, int, np.ndarray, np.ndarray]]]:
    """From rows in the order (a, part, other): the pivot's set first, then every set of its group. Lists of (pivot, class,
    set, pivot's set); one pivot is held."""
    own, pivot = None, None
    for batch in batches:
        rows = []
        for a, part, other, b, blob in zip(*(batch.column(c) for c in ("a", "part", "other", "b", "set")), strict=True):
            found = np.frombuffer(blob.as_buffer(), np.uint64)
            group = (a.as_py(), part.as_py())
            if not other.as_py():
                own, pivot = group, found.copy()
            elif group == own:
                rows.append((group[0], b.as_py(), found, pivot))
            else:
                raise ValueError("a pivot's set is missing")
        yield rows


def _within(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which of the ascending ``x`` are among the ascending ``y``."""
    return y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x


def _overlaps(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in _beside_pivots(batches):
        rows = []
        for a, b, found, pivot in group:
            x, y = (found, pivot) if len(found) <= len(pivot) else (pivot, found)
            rows.append((a, b, int(_within(x, y).sum()), len(x) + len(y)))
        columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "both", "sizes"])


def _beyond(percent: int, cells: np.ndarray, sets: np.ndarray):
    """The windows of a set within its pivot's ring: the first shingles in the order that puts those of the pivot last."""

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _beside_pivots(batches):
            keys, pivots, own, places = [], [], [], [np.zeros(0, np.int32)]
            for a, b, found, pivot in group:
                held = _within(found, pivot)
                windows = len(found) - -(-percent * len(found) // 100) + 1
                first = _ordered(found[~held], cells, sets)[:windows]
                if len(first) < windows:
                    first = np.concatenate((first, _ordered(found[held], cells, sets)[: windows - len(first)]))
                keys.append(first.view(np.int64))
                pivots.append(a)
                own.append(b)
                places.append(np.arange(len(first), dtype=np.int32))
            times = [len(k) for k in keys]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.array(pivots, np.int64), times)),
                    pa.array(np.repeat(np.array(own, np.int64), times)),
                    pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)),
                    pa.array(np.concatenate(places)),
                ],
                ["pivot", "cid", "key", "place"],
            )

    return emit


def _dealt(wanted: DataFrame, rows: int, texts: DataFrame, one_text: DataFrame, width: int) -> DataFrame:
    """From (``cid``, ``group``), no more than ``rows``: each class's set, made again from one of its texts, once per group that needs it."""
    needed = wanted.groupBy("cid").agg(F.collect_list("group").alias("groups"))
    needed = needed.join(one_text, "cid").select(F.col("best.digest").alias("digest"), F.col("best.id").alias("one"), "cid", "groups")
    read = texts.join(sized(needed, 2 * rows), (texts["digest"] == needed["digest"]) & texts["id"].eqNullSafe(needed["one"]))
    return mapped(read.select("text", "cid", "groups"), _sent(width), "a long, part int, other boolean, b long, set binary")


def _with_pivots(pairs: DataFrame, texts: DataFrame, one_text: DataFrame, width: int, function, schema: str) -> DataFrame:
    """``function`` over the sets of stored pairs (``a``, ``b``), dealt to their pivots ``a``. A pivot with very many partners has
    several groups."""
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / COMPARED).cast("int").alias("parts"))
    group = lambda part: F.struct("a", part.cast("int").alias("part"))
    partners = pairs.join(parts, "a").select(F.col("b").alias("cid"), group(F.pmod(F.xxhash64("b"), F.col("parts"))).alias("group"))
    pivots = parts.select(F.col("a").alias("cid"), "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("nth"))
    pivots = pivots.select("cid", group(F.col("nth")).alias("group"))
    sent = _dealt(partners.unionByName(pivots), 2 * pairs.count(), texts, one_text, width)
    dealt = sent.repartition("a", "part").sortWithinPartitions("a", "part", "other")
    return mapped(dealt, function, schema)


def _compared(pairs: DataFrame, texts: DataFrame, one_text: DataFrame, width: int, purpose: str, rows: int | None = None) -> DataFrame:
    """Distinct pairs (``a``, ``b``) with the sizes of their intersection and of both sets. ``rows`` bounds what the last step
    to the pairs reads, if that is known."""
    pairs = stored(pairs, f"{purpose}-pairs", rows)
    compared = _with_pivots(pairs, texts, one_text, width, _overlaps, "a long, b long, both long, sizes long")
    return stored(compared.distinct(), purpose, pairs.count())


def _linked(compared: DataFrame, percent: int) -> DataFrame:
    return compared.where((100 + percent) * F.col("both") >= percent * F.col("sizes")).select("a", "b")


def components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """(``cid``, ``root``) for every end of a link; the root is the component's smallest id.

    Each round every id takes the smallest label among its neighbours and then its label's label, which
    halves the remaining distance, and is written, so that no round depends on an earlier one's tasks. ``rows`` bounds the links,
    if a bound is known."""
    both = stored(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links", None if rows is None else 2 * rows)
    rows = both.count()
    labels = stored(
        both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("cid"), F.least("a", "least").alias("root")),
        "labels",
        rows,
    )
    while True:
        near = both.join(labels.withColumnRenamed("cid", "b"), "b").groupBy("a").agg(F.min("root").alias("least"))
        taken = labels.join(near.withColumnRenamed("a", "cid"), "cid").select(
            "cid", "root", F.least("root", "least").alias("next")
        )
        jump = labels.select(F.col("cid").alias("next"), F.col("root").alias("further"))
        moved = taken.join(jump, "next", "left").select(
            "cid", F.least("next", F.coalesce("further", "next")).alias("root"), F.col("root").alias("was")
        )
        moved = stored(moved, "labels", 2 * rows)
        labels = moved.select("cid", "root")
        if moved.where(F.col("root") != F.col("was")).isEmpty():
            return labels


# -- large regions ----------------------------------------------------------------------------------


def _together(percent: int):
    def link(ring: pa.Table) -> pa.Table:
        """All pairs of a ring of bounded size: each class with the first of those it is linked with, directly or not."""
        cids = ring.column("b").to_numpy()
        sets = [np.frombuffer(blob.as_buffer(), np.uint64) for chunk in ring.column("set").chunks for blob in chunk]
        sizes = np.array([len(x) for x in sets])
        _, shingle, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        number = np.cumsum(times > 1) - 1  # shingles of one set alone are in no intersection
        owner = np.repeat(np.arange(len(sets)), sizes)
        kept = times[shingle] > 1
        owner, shingle = owner[kept], number[shingle[kept]]
        order = np.argsort(shingle, kind="stable")
        owner, shingle = owner[order], shingle[order]
        both = np.zeros((len(sets), len(sets)), np.float64)
        for low in range(0, int(shingle[-1]) + 1 if len(shingle) else 0, 4096):
            some = slice(*np.searchsorted(shingle, (low, low + 4096)))
            holds = np.zeros((len(sets), 4096), np.float32)
            holds[owner[some], shingle[some] - low] = 1
            both += holds @ holds.T
        linked = (100 + percent) * both >= percent * (sizes[:, None] + sizes)
        np.fill_diagonal(linked, True)
        label = np.arange(len(sets))
        while True:
            least = np.where(linked, label, len(sets)).min(axis=1)
            if (least == label).all():
                break
            label = least
        moved = np.flatnonzero(label != np.arange(len(sets)))
        return pa.table({"a": cids[moved], "b": cids[label[moved]]})

    return link


def _rings(members: DataFrame, percent: int) -> DataFrame:
    """(``ring``, ``pivot``, ``cid``, ``n``, ``root``): the rings of a region around its pivot, each twice the join's distance
    wide, the next one half of that further out. A set whose distance is not known is in all of them."""
    reach = 1 - percent / 100
    last = max(0, math.ceil(1 / reach) - 2) if reach > 0 else 0

    def within(ring: Column) -> Column:
        inner = F.col("distance") >= ring * reach - 1e-9
        outer = (ring == last) | (F.col("distance") <= (ring + 2) * reach + 1e-9)
        return F.col("distance").isNull() | (inner & outer) | F.lit(last == 0)

    nth = F.explode(F.filter(F.sequence(F.lit(0), F.lit(last)), within)).alias("nth")
    return members.select("region", "pivot", "cid", "n", "root", nth).select(
        F.xxhash64("region", "nth").alias("ring"), "pivot", "cid", "n", "root"
    )


def _crossing(rows: DataFrame, *group: str) -> DataFrame:
    """How many ordered pairs of different components each group holds."""
    rooted = rows.groupBy(*group, "root").agg(F.count("*").alias("m"))
    return rooted.groupBy(*group).agg((F.pow(F.sum("m"), F.lit(2)) - F.sum(F.pow("m", F.lit(2)))).alias("crossing"))


def _meeting(windows: DataFrame, percent: int, *group: str) -> DataFrame:
    """The ``windows`` of groups that hold several components, without those whose set can reach none of its group: not
    even the smallest size with the longest rest. A pair that is linked stays in the first group that both are in."""
    rest = F.col("n") - F.col("place")
    groups = windows.groupBy(*group).agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.min("n").alias("least"), F.max(rest).alias("most")
    )
    reached = F.least(rest, F.col("most")) * (100 + percent) >= (F.col("n") + F.col("least")) * percent
    return windows.join(groups.where("low != high"), list(group)).where(reached).select(*windows.columns)


def _distance() -> Column:
    return (1 - F.col("both") / (F.col("sizes") - F.col("both"))).alias("distance")


def _rooted(members: DataFrame, roots: DataFrame) -> DataFrame:
    return members.join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))


def _merged(roots: DataFrame, more: DataFrame) -> DataFrame:
    """Components after more links."""
    more = stored(more, "more-links")
    found = more.count()
    if not found:
        return roots
    known = roots.where(F.col("cid") != F.col("root")).select(F.col("root").alias("a"), F.col("cid").alias("b"))
    return components(known.unionByName(more), roots.count() + found)


def _divided(members: DataFrame, rows: int, roots: DataFrame, texts: DataFrame, one_text: DataFrame, cells, sets, width: int, percent: int) -> DataFrame:
    """Components when every pair within a region has been settled. ``members`` has (``region``, ``pivot``, ``cid``, ``n``,
    ``distance`` from the pivot) of all sets but the pivot, which has been compared with them; ``rows`` bounds what its last step reads.

    Each level takes the pivots out of their regions, and a ring is divided only if that halves the pairs of
    different components, so the levels come to an end and never hold more work than comparing a region pair by pair."""
    while True:
        members = stored(members, "members", rows)
        rings = stored(_rings(_rooted(members, roots), percent), "rings", members.count() + roots.count())
        kinds = rings.groupBy("ring").agg(
            F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("members"), F.sum("n").alias("shingles")
        )
        small = (F.col("members") <= TOGETHER) & (F.col("shingles") <= SHINGLES)
        kinds = kinds.where(F.col("low") != F.col("high")).select("ring", small.alias("small"))
        rings = stored(rings.join(kinds, "ring"), "open-rings", 2 * rings.count())
        held = rings.count()
        if not held:
            return roots
        group = F.struct(F.col("ring").alias("a"), F.lit(0).alias("part")).alias("group")
        dealt = _dealt(rings.where("small").select("cid", group), held, texts, one_text, width)
        found = dealt.groupBy("a").applyInArrow(_together(percent), "a long, b long")

        large = rings.where(~F.col("small"))
        if large.isEmpty():
            return _merged(roots, found)
        own = stored(large.select("pivot", "cid", "n", "root").distinct(), "ring-sets", held)
        around = own.select(F.col("pivot").alias("a"), F.col("cid").alias("b"))
        windows = _with_pivots(around, texts, one_text, width, _beyond(percent, cells, sets), "pivot long, cid long, key long, place int")
        made = own.agg(F.sum(F.floor(F.col("n") * (100 - percent) / 100) + 2)).first()[0]  # a set's windows and its own row
        windows = stored(windows.distinct().join(own, ["pivot", "cid"]), "ring-windows", made)
        # Only windows that may hold a pair of different components go on, first of all sets around a pivot, then of a ring.
        met = stored(_meeting(windows, percent, "pivot", "key"), "met-windows", 2 * windows.count())
        windows = met.join(large.select("ring", "pivot", "cid"), ["pivot", "cid"])  # a set lies in three rings at most, if its distance is known
        windows = stored(_meeting(windows, percent, "ring", "key"), "windows-of-rings", 6 * met.count())
        first = F.min(F.struct(F.xxhash64("cid"), F.col("cid").alias("pivot"))).alias("first")
        shared = windows.groupBy("ring", "key").agg(F.count("*").alias("m"), first).where(F.col("m") > 1)
        children = windows.select("ring", "key", "cid", "n", "root").join(shared, ["ring", "key"]).select(
            "ring", F.xxhash64("ring", "first.pivot").alias("region"), F.col("first.pivot").alias("pivot"), "cid", "n", "root"
        )
        children = stored(children.distinct(), "regions-of-rings", windows.count())
        within = _crossing(children, "ring", "region").groupBy("ring").agg(F.sum("crossing").alias("left"))
        judged = _crossing(large, "ring").join(within, "ring", "left").select(
            "ring", (2 * F.coalesce("left", F.lit(0.0)) <= F.col("crossing")).alias("helps")
        )
        judged = stored(judged, "judged-rings", held + children.count())
        children = children.join(judged.where("helps"), "ring").where(F.col("cid") != F.col("pivot"))
        stuck = windows.join(judged.where(~F.col("helps")), "ring").select("ring", "key", "cid", "n", "place", "root")
        other = stuck.select("ring", "key", *[F.col(c).alias(f"{c}_b") for c in ("cid", "n", "place", "root")])
        reached = _reachable(percent, F.col("n"), F.col("place"), F.col("n_b"), F.col("place_b"))
        pairs = stuck.join(other, ["ring", "key"]).where((F.col("root") < F.col("root_b")) & reached)
        pairs = pairs.select(F.least("cid", "cid_b").alias("a"), F.greatest("cid", "cid_b").alias("b"))
        pairs = pairs.unionByName(children.select(F.col("pivot").alias("a"), F.col("cid").alias("b"))).distinct()
        near = _compared(pairs, texts, one_text, width, "ring-distances")
        roots = _merged(roots, found.unionByName(_linked(near, percent)))
        far = near.select(F.col("a").alias("pivot"), F.col("b").alias("cid"), _distance())
        rows = windows.count() + near.count()
        members = children.select("region", "pivot", "cid", "n").join(far, ["pivot", "cid"])


# -- the join ---------------------------------------------------------------------------------------


def _described(width: int, columns: int):
    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, sizes = [], []
            for found in _sets(batch.column(columns), width):
                own.append(_class_of(found) if len(found) else None)
                sizes.append(len(found))
            kept = batch.select(list(range(columns)))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(own, pa.int64()), pa.array(sizes, pa.int64())], [*kept.schema.names, "cid", "n_shingles"]
            )

    return describe


def classes(docs: DataFrame, id_: str, text: str, width: int = WORDS) -> DataFrame:
    """Every document's id, a digest of its text, its class (null for the empty set) and its set's size."""
    rows = docs.select(
        named(docs, id_).alias("id"), F.xxhash64(F.coalesce(named(docs, text), F.lit(""))).alias("digest"), named(docs, text).alias("text")
    )
    kind = rows.schema["id"].dataType.simpleString()
    return mapped(rows, _described(width, 2), f"id {kind}, digest long, cid long, n_shingles long")


def links(docs: DataFrame, id_: str, text: str, described: DataFrame, width: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Links between classes that span every component: (``cid``, ``root``) for all classes with a partner."""
    texts = docs.select(named(docs, text).alias("text"))
    cells, sets = frequent_cells(texts, width)
    windows = mapped(texts, _windows(width, percent, cells, sets), "key long, cid long, n int, place int")
    dealt = windows.repartition(F.col("key")).sortWithinPartitions("key", "place", "cid")
    schema = "key long, cid long, n int, place int, pivot long, pivot_n int, pivot_place int"
    regions = stored(mapped(dealt, _shared, schema), "regions")
    # Each class is compared by one of its texts.
    one_text = described.where(F.col("cid").isNotNull()).groupBy("cid").agg(F.min(F.struct("digest", "id")).alias("best"))
    texts = docs.select(
        named(docs, id_).alias("id"), named(docs, text).alias("text"), F.xxhash64(F.coalesce(named(docs, text), F.lit(""))).alias("digest")
    )
    # The pivot's distances: a star of comparisons in each region.
    reached = _reachable(percent, F.col("n"), F.col("place"), F.col("pivot_n"), F.col("pivot_place"))
    star = regions.where((F.col("cid") != F.col("pivot")) & reached)
    star = star.select(F.col("pivot").alias("a"), F.col("cid").alias("b")).distinct()
    near = _compared(star, texts, one_text, width, "pivot-distances", regions.count())
    roots = components(_linked(near, percent), near.count())
    # What is left of the regions: those that still hold several components.
    region = _rooted(regions, roots)
    mixed = region.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("members"))
    mixed = mixed.where((F.col("low") != F.col("high")) & (F.col("members") > 2)).select("key", (F.col("members") > UNDIVIDED).alias("large"))
    rest = region.join(mixed, "key").where(F.col("cid") != F.col("pivot")).join(
        near.select(F.col("a").alias("pivot"), F.col("b").alias("cid"), _distance()), ["pivot", "cid"], "left"
    )
    rest = rest.select("key", "pivot", "cid", "n", "place", "root", "distance", "large")
    rest = stored(rest, "windows", regions.count() + near.count())
    few = rest.where(~F.col("large"))
    other = few.select("key", *[F.col(c).alias(f"{c}_b") for c in ("cid", "n", "place", "root", "distance")])
    apart = F.coalesce(F.abs(F.col("distance") - F.col("distance_b")), F.lit(0.0))
    pairs = (
        few.join(other, "key")
        .where(
            (F.col("root") < F.col("root_b"))
            & _reachable(percent, F.col("n"), F.col("place"), F.col("n_b"), F.col("place_b"))
            & (apart <= 1 - percent / 100 + 1e-9)
        )
        .select(F.least("cid", "cid_b").alias("a"), F.greatest("cid", "cid_b").alias("b"))
        .distinct()
    )
    done = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    far = _compared(pairs.join(done, ["a", "b"], "left_anti"), texts, one_text, width, "window-distances")
    roots = _merged(roots, _linked(far, percent))
    many = rest.where("large").select(F.col("pivot").alias("region"), "pivot", "cid", "n", "distance").distinct()
    return _divided(many, rest.count(), roots, texts, one_text, cells, sets, width, percent)


def join(docs: DataFrame, id_: str, text: str, width: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: ``id``, ``digest`` of its text, ``n_shingles``, ``component_id`` (the smallest id that
    links reach) and ``root`` (one number for the component, null for the empty set)."""
    described = stored(classes(docs, id_, text, width), "shingle-classes")
    roots = links(docs, id_, text, described, width, percent)
    full = described.where(F.col("cid").isNotNull())
    rooted = stored(
        full.join(roots, "cid", "left").select("id", "digest", "n_shingles", F.coalesce("root", "cid").alias("root")), "rooted"
    )
    least = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    empty = described.where(F.col("cid").isNull())
    columns = ["id", "digest", "n_shingles", "component_id", "root"]
    return rooted.join(least, "root").select(*columns).unionByName(
        empty.select("id", "digest", "n_shingles", F.col("id").alias("component_id"), F.lit(None).cast("long").alias("root"))
    )


def distinct_documents(docs: DataFrame, id_: str, text: str, width: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest id, then the smallest text digest, and one
    of equal rows. Documents with the empty set all stay. Other columns stay as they are."""
    joined = stored(join(docs, id_, text, width, percent), "joined").where(F.col("n_shingles") > 0)
    order = F.struct(F.col("id").isNull(), "id", "digest")
    best = joined.groupBy("root").agg(F.min(order).alias("best"))
    keys = joined.groupBy("id", "digest", "root").agg(F.count("*").alias("copies"))
    judged = stored(
        keys.join(best.select("root", "best"), "root").select(
            "id", "digest", "copies", (F.struct(F.col("id").isNull(), "id", "digest") != F.col("best")).alias("goes")
        ),
        "judged",
    )
    id_name, digest = (fresh(docs.columns, n) for n in ("_id", "_digest"))
    keyed = docs.withColumns({id_name: named(docs, id_), digest: F.xxhash64(F.coalesce(named(docs, text), F.lit("")))})

    def among(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        keys = keys.select(F.col("id").alias("_k_id"), F.col("digest").alias("_k_digest"))
        keys = sized(keys)
        return rows.join(keys, rows[id_name].eqNullSafe(keys["_k_id"]) & (rows[digest] == keys["_k_digest"]), how)

    gone = judged.where("goes").select("id", "digest")
    repeated = judged.where(~F.col("goes") & (F.col("copies") > 1)).select("id", "digest")
    kept = among(keyed, gone, "left_anti")
    if not repeated.isEmpty():
        once = among(kept, repeated, "left_semi").dropDuplicates([id_name, digest])
        kept = among(kept, repeated, "left_anti").unionByName(once)
    return kept.drop(id_name, digest)
