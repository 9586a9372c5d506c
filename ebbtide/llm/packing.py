"""Packing of token sequences by patterns fitted to the histogram of their lengths.

The histogram has one number per length, at most as many as a sequence holds tokens, so it fits the
driver at any size of the input. Patterns are the ways to fill a sequence exactly with up to three
pieces of lengths that occur. Non-negative least squares fits how often each pattern repeats;
the counts are rounded down, what is left is packed best fit in decreasing length, whole groups of
equal sequences at a time. The plan is a bounded table too: pieces of one length are numbered across
the cluster, and the plan maps (length, number) to a place.

Defined results: a null text is empty and packs as its end token alone. Repeated rows are packed
each. Pieces equal in length are interchangeable. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm import tokens
from ebbtide.llm.frames import mapped, named, stored

#: Rows numbered by one task within a length; a length that a third of all pieces have is split into many.
NUMBERED = 50_000
#: Steps of the fit, and patterns that one step may add.
STEPS, ADDED = 30, 64
#: Share of each fitted count that is used; the rest leaves the residual packing lengths of all kinds to match.
USED = 0.75


# -- the plan ---------------------------------------------------------------------------------------


@dataclass
class Plan:
    """Rows (length, first number, end number, first sequence, pieces per sequence, offset)."""

    rows: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0
    used: dict[int, int] = field(default_factory=dict)

    def add(self, pieces: dict[int, int], repeats: int) -> None:
        """``repeats`` sequences that each hold ``pieces[length]`` pieces of each length."""
        offset = 0
        for length, times in sorted(pieces.items(), reverse=True):
            first = self.used.get(length, 0)
            self.rows.append((length, first, first + repeats * times, self.sequences, times, offset))
            self.used[length] = first + repeats * times
            offset += length * times
        self.sequences += repeats


def patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """All ways to fill ``capacity`` with two or three of ``lengths``: rows of indices, -1 for no third."""
    place = np.full(capacity + 1, -1)
    place[lengths] = np.arange(len(lengths))
    found = []
    for i, a in enumerate(lengths):
        rest = capacity - a
        if rest >= a and place[rest] >= 0:
            found.append(np.array([[i, place[rest], -1]]))
        b = lengths[i:]
        c = rest - b
        fits = (c >= b) & (c <= capacity)
        b, c = b[fits], c[fits]
        third = place[c]
        there = third >= 0
        if there.any():
            found.append(np.stack([np.full(there.sum(), i), place[b[there]], third[there]], axis=1))
    return np.concatenate(found) if found else np.zeros((0, 3), int)


def fit(ways: np.ndarray, counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Repeat counts x >= 0 with least weighted squares of (pieces used - pieces there), by active sets."""
    rows, n = len(counts), len(ways)
    target = counts.astype(float)
    solution = np.zeros(n)
    if not n:
        return solution

    def used(x: np.ndarray) -> np.ndarray:
        out = np.zeros(rows + 1)
        np.add.at(out, ways, x[:, None])
        return out[:rows]

    def columns(active: np.ndarray) -> np.ndarray:
        out = np.zeros((rows + 1, len(active)))
        np.add.at(out, (ways[active], np.arange(len(active))[:, None]), 1.0)
        return out[:rows]

    active = np.zeros(0, int)
    for _ in range(STEPS):
        left = np.append(weights * (target - used(solution)), 0.0)
        gain = left[ways].sum(axis=1)
        gain[active] = -np.inf
        order = np.argsort(-gain, kind="stable")[: 64 * ADDED]
        best, taken = [], set()
        for way in order[gain[order] > 1e-3 * weights.max() * max(1.0, 1e-3 * target.sum() / rows)]:
            if taken.isdisjoint(lengths := set(ways[way][ways[way] >= 0].tolist())):
                best.append(way)
                taken |= lengths
        best = np.array(best[: min(ADDED, rows - len(active))], int)
        if not len(best):
            break
        active = np.concatenate([active, best])
        while len(active):
            a = columns(active)
            b = a * weights[:, None]
            x = np.linalg.solve(a.T @ b + 1e-9 * np.eye(len(active)), b.T @ target)
            if (x > 0).all():
                break
            active = active[x > 0]  # patterns that would fall below zero leave; a later step may bring them back
        solution[:] = 0
        if len(active):
            solution[active] = x
    return solution


def pack_rest(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best fit, longest first, for groups of sequences with equal contents: (pieces, repeats)."""
    open_: dict[int, list[tuple[dict[int, int], int]]] = {}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = min((r for r in open_ if r >= length), default=None)
            if room is None:
                times = min(capacity // length, left)
                groups, rest = divmod(left, times)
                open_.setdefault(capacity - times * length, []).append(({length: times}, groups))
                if rest:
                    open_.setdefault(capacity - rest * length, []).append(({length: rest}, 1))
                left = 0
                continue
            pieces, repeats = open_[room].pop()
            if not open_[room]:
                del open_[room]
            times = min(room // length, left)
            filled = min(repeats, left // times)
            grown = dict(pieces)
            grown[length] = grown.get(length, 0) + times
            open_.setdefault(room - times * length, []).append((grown, filled))
            if repeats > filled:
                open_.setdefault(room, []).append((pieces, repeats - filled))
            left -= filled * times
    return [group for groups in open_.values() for group in groups]


def plan(histogram: dict[int, int], capacity: int) -> Plan:
    """Places for all pieces of a histogram {length: number}."""
    out = Plan()
    left = {length: n for length, n in histogram.items() if n}
    if whole := left.pop(capacity, 0):
        out.add({capacity: 1}, whole)
    lengths = np.array(sorted(left), dtype=int)
    ways = patterns(lengths, capacity)
    # A long piece that finds no partner costs most, so lengths are weighted by themselves.
    fitted = fit(ways, np.array([left[x] for x in lengths]), lengths / capacity)
    for way, repeats in zip(ways, np.floor(USED * fitted + 1e-6), strict=True):
        pieces: dict[int, int] = {}
        for i in way[way >= 0]:
            pieces[int(lengths[i])] = pieces.get(int(lengths[i]), 0) + 1
        repeats = min([int(repeats), *(left[x] // n for x, n in pieces.items())])
        if repeats > 0:
            out.add(pieces, repeats)
            for x, n in pieces.items():
                left[x] -= repeats * n
    for pieces, repeats in pack_rest({x: n for x, n in left.items() if n}, capacity):
        out.add(pieces, repeats)
    return out


# -- on Spark ---------------------------------------------------------------------------------------


def _piecewise(path: str, capacity: int, end_id: int, with_ids: bool):
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(path)
        for batch in batches:
            kept = batch.schema.names[:-1]
            rows, piece, start, length, crc, ids_out = [], [], [], [], [], []
            for row, text in enumerate(batch.column(len(kept))):
                ids = np.append(encoder.ids(text.as_py()), np.uint32(end_id)).astype("<u4")
                first = len(ids) % capacity or capacity
                bounds = [0, *range(first, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    rows.append(row)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[a:b].tobytes()))
                    if with_ids:
                        ids_out.append(ids[a:b].tobytes())
            taken = batch.select(kept).take(pa.array(rows, pa.int64()))
            new = [
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
            ] + ([pa.array(ids_out, pa.binary())] if with_ids else [])
            names = ["piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
            yield pa.RecordBatch.from_arrays([*taken.columns, *new], [*kept, *names])

    return cut


def pieces(
    docs: DataFrame, text: str, keep: list[str], tokenizer: str, capacity: int, end_id: int, with_ids: bool = False
) -> DataFrame:
    """Token pieces of every whole text and its end token: ``keep_0`` .. with ``piece``, ``start``, ``length``,
    ``ids_crc32`` and, on request, ``ids`` (32-bit, little-endian). All but a text's first piece are full."""
    rows = docs.select(*[named(docs, c).alias(f"keep_{i}") for i, c in enumerate(keep)], named(docs, text).alias("text"))
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema[:-1])
    schema = f"{kept}{', ' * bool(kept)}piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return mapped(rows, _piecewise(tokenizer, capacity, end_id, with_ids), schema)


def _placer(rows: list[tuple[int, int, int, int, int, int]]):
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 6)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = np.int64(1) << np.int64(40)
        begins = table[:, 0] * shift + table[:, 1]
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            row = table[np.searchsorted(begins, length * shift + number, side="right") - 1]
            sequence, nth = np.divmod(number - row[:, 1], row[:, 4])
            kept = batch.select(batch.schema.names[:-1])
            new = [pa.array(sequence + row[:, 3]), pa.array(row[:, 5] + nth * length)]
            yield pa.RecordBatch.from_arrays([*kept.columns, *new], [*kept.schema.names, "sequence_id", "offset"])

    return place


def pack(found: DataFrame, capacity: int, numbered: int = NUMBERED) -> DataFrame:
    """``found`` (any columns, with ``length`` of 1 to ``capacity``) with ``sequence_id`` and ``offset``.

    ``found`` is read several times; hand over a stored table."""
    counts = {r["length"]: r["count"] for r in found.groupBy("length").count().collect()}
    if not counts:
        return found.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    layout = plan(counts, capacity)
    salts = max(1, -(-max(counts.values()) // numbered))
    light = [c for c in found.columns if c != "ids"]
    salted = found.withColumn("salt", F.pmod(F.xxhash64(*light), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    # One row per length and salt: a few hundredths of a thousandth of the pieces.
    base = salted.groupBy("length", "salt").count().select(
        "length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base")
    )
    within = Window.partitionBy("length", "salt").orderBy(*light)
    ranked = salted.withColumn("rank", F.row_number().over(within) - 1).join(base, ["length", "salt"])
    ranked = ranked.select(*found.columns, (F.col("base") + F.col("rank")).alias("number"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema)
    return mapped(ranked, _placer(layout.rows), f"{schema}, sequence_id long, offset long")


def pack_texts(
    docs: DataFrame, text: str, keep: list[str], tokenizer: str, capacity: int, end_id: int, with_ids: bool = False
) -> DataFrame:
    """Every piece of every text with its sequence and its offset there."""
    found = stored(pieces(docs, text, keep, tokenizer, capacity, end_id, with_ids), "token-pieces")
    packed = pack(found, capacity)
    return packed.select(*[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)], *packed.columns[len(keep) :])
