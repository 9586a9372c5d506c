"""Runs of periodic text: stretches of words that repeat themselves, with every run's start, length and period.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) that is at least
``LEAST_WORDS`` and ``LEAST_TURNS`` * q words long and that no neighbouring word extends keeping period q.

Runs are found by internal pattern matching. The words of many texts, with a word of its own after each, become one
sequence with a suffix array, built by prefix doubling. For each power of two, the sequence is cut into blocks of that
length. All occurrences of a block are one interval of the suffix array; a wavelet tree over the array answers which of
them comes next at or after a place (range successor). Each block asks for its occurrences in the window before it and
in the window after it, each as long as the block. Occurrences that close form a progression whose difference is the
period of the stretch, so the first two tell it. Why nothing is missed: for a run of period q take the smallest power of
two that is q or more. It is under 2q, so the run of 4q or more words holds a whole block of it, and the block's next
occurrence after or before it lies q words away within the run; a block of q words or more has none that is nearer.
Candidates are then extended as far as their period holds, by digests of prefixes, and each run is compared word by word.

The work on n words is some n log n steps, all on arrays; the wavelet tree takes a bit per word and level. Texts share
arrays up to ``BLOCK_WORDS`` words; a longer text has arrays of its own.

Words are what lies between white space (space, tab to carriage return), compared as they are. Defined results: null and
empty texts have no runs and an empty collapsed text. Repeated rows get their runs each. An empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from ebbtide.llm.frames import mapped

#: A run has at least so many words, and so many times its period.
LEAST_WORDS, LEAST_TURNS = 6, 4
BLOCK_WORDS = 1 << 17
#: Bytes of a text that are split into words at once.
PART = 1 << 20
RUNS = "array<struct<start:long,length:long,period:long>>"
_RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_BASE = 0x9E3779B97F4A7C15


def suffix_array(words: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray, int]]]:
    """The suffix array of ``words``, and the blocks that occur more than once: their starts, the first and the end place
    of their interval in the array, and their length, for each power of two. Blocks whose first word does not come
    again within their length, before or after, are left out: they have no occurrence in their windows.

    Prefix doubling: after each round suffixes are ranked by their first 1, 2, 4, ... words, and equal ones share a rank,
    which is where their interval begins. Suffixes that are alone in their interval take no further part."""
    n = len(words)
    order = np.argsort(words, kind="stable")
    ranked = words[order]
    first = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    rank = np.empty(n, np.int64)
    begins = np.flatnonzero(first)
    rank[order] = np.repeat(begins, np.diff(np.append(begins, n)))
    # Suffixes that begin alike are still in the order of their places.
    apart = np.where(first[1:], n, np.diff(order))
    nearest = np.full(n, n)
    nearest[order[:-1]] = apart
    nearest[order[1:]] = np.minimum(nearest[order[1:]], apart)
    width, blocks = 1, []
    sizes = np.zeros(n + 1, np.int64)
    sizes[begins] = np.diff(np.append(begins, n))
    tied = np.flatnonzero(sizes[rank[order]] > 1)  # places in the array, in order
    while len(tied):
        starts = np.arange(0, n - width + 1, width)
        starts = starts[(nearest[starts] <= width) & (sizes[rank[starts]] > 1)]
        if len(starts):
            low = rank[starts]
            blocks.append((starts, low, low + sizes[low], width))
        suffixes = order[tied]
        later = suffixes + width
        after = np.where(later < n, rank[np.minimum(later, n - 1)] + 1, 0)
        own = rank[suffixes]
        # Intervals stay in order, each is sorted by what follows.
        inner = np.lexsort((after, own))
        suffixes, own, after = suffixes[inner], own[inner], after[inner]
        order[tied] = suffixes
        new = np.concatenate(([True], (own[1:] != own[:-1]) | (after[1:] != after[:-1])))
        begins = np.flatnonzero(new)
        counts = np.diff(np.append(begins, len(tied)))
        sizes[own] = 0
        sizes[tied[begins]] = counts
        rank[suffixes] = np.repeat(tied[begins], counts)
        tied = tied[np.repeat(counts, counts) > 1]
        width *= 2
    return order, blocks


class WaveletTree:
    """Numbers below their count, level by level from the highest bit: how many of the first i have a zero there."""

    def __init__(self, values: np.ndarray) -> None:
        self.n = len(values)
        self.levels: list[tuple[int, np.ndarray, np.ndarray, int]] = []
        for bit in reversed(range(max(self.n - 1, 1).bit_length())):
            zero = (values >> bit & 1) == 0
            packed = np.packbits(np.append(zero, np.zeros(-len(zero) % 64 + 64, bool)), bitorder="little").view(np.uint64)
            before = np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)))[:-1]
            self.levels.append((bit, packed, before, int(zero.sum())))
            values = np.concatenate((values[zero], values[~zero]))

    @staticmethod
    def _zeros(level: tuple[int, np.ndarray, np.ndarray, int], i: np.ndarray) -> np.ndarray:
        _, packed, before, _ = level
        at = i >> 6
        part = packed[at] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1))
        return before[at] + np.bitwise_count(part)

    def smaller(self, low: np.ndarray, high: np.ndarray, than: np.ndarray) -> np.ndarray:
        """How many of the values at places low to high lie below ``than`` (at most n)."""
        count = np.zeros(len(low), np.int64)
        whole = than >= self.n
        count[whole] = (high - low)[whole]
        than = np.where(whole, 0, than)
        for level in self.levels:
            bit, _, _, zeros = level
            a, b = self._zeros(level, low), self._zeros(level, high)
            one = (than >> bit & 1) == 1
            count += np.where(one, b - a, 0)
            low, high = np.where(one, zeros + low - a, a), np.where(one, zeros + high - b, b)
        return count

    def nth(self, low: np.ndarray, high: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The value with ``n`` smaller ones among those at places low to high; there must be one."""
        value = np.zeros(len(low), np.int64)
        for level in self.levels:
            bit, _, _, zeros = level
            a, b = self._zeros(level, low), self._zeros(level, high)
            one = n >= b - a
            n = np.where(one, n - (b - a), n)
            value |= np.where(one, 1 << bit, 0)
            low, high = np.where(one, zeros + low - a, a), np.where(one, zeros + high - b, b)
        return value

    def successor(self, low: np.ndarray, high: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The smallest value at places low to high that is ``least`` or more; n if there is none."""
        below = self.smaller(low, high, least)
        found = np.full(len(low), self.n)
        there = below < high - low
        found[there] = self.nth(low[there], high[there], below[there])
        return found


def candidates(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of stretches that repeat: a block here and the same block a period later."""
    order, blocks = suffix_array(words)
    if not blocks:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    tree = WaveletTree(order)
    start, low, high = (np.concatenate([b[i] for b in blocks]) for i in range(3))
    width = np.concatenate([np.full(len(b[0]), b[3]) for b in blocks])
    out = []
    for begin in range(0, len(start), BLOCK_WORDS):
        s, a, b, w = (x[begin : begin + BLOCK_WORDS] for x in (start, low, high, width))
        after = tree.successor(a, b, s + 1)
        near = after <= np.minimum(s + w, len(words) - 1)
        out.append((s[near], (after - s)[near]))
        before = tree.successor(a, b, np.maximum(s - w, 0))
        near = before < s
        a, b, before = a[near], b[near], before[near]
        out.append((before, tree.successor(a, b, before + 1) - before))
    found, period = (np.concatenate([x[i] for x in out]) for i in range(2))
    pairs = np.unique(found * (len(words) + 1) + period)
    return pairs // (len(words) + 1), pairs % (len(words) + 1)


class _Prefixes:
    """Digests of all prefixes, to tell whether two stretches are alike."""

    def __init__(self, words: np.ndarray) -> None:
        with np.errstate(over="ignore"):
            spread = words.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(0x94D049BB133111EB)
            spread ^= spread >> np.uint64(29)
            power = np.full(len(words) + 1, _BASE, np.uint64)
            power[0] = 1
            self.power = np.multiply.accumulate(power)
            self.total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(spread * self.power[:-1], dtype=np.uint64)))

    def alike(self, i: np.ndarray, j: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the ``n`` words from i are those from j, where i < j."""
        a, b = self.total[i + n] - self.total[i], self.total[j + n] - self.total[j]
        return a * self.power[j - i] == b


def _reach(alike, most: np.ndarray) -> np.ndarray:
    """The largest number up to ``most`` for which ``alike`` holds; it holds below any for which it does."""
    low, high = np.zeros(len(most), np.int64), most.copy()
    while (open_ := low < high).any():
        middle = (low + high + 1) // 2
        holds = alike(middle)
        low = np.where(open_ & holds, middle, low)
        high = np.where(open_ & ~holds, middle - 1, high)
    return low


def _walked(words: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """Start and end of the stretch of this period around ``at``, word by word."""
    low, high = at, at
    while low > 0 and words[low - 1] == words[low - 1 + period]:
        low -= 1
    while high + period < len(words) and words[high] == words[high + period]:
        high += 1
    return low, high + period


def runs(words: np.ndarray) -> np.ndarray:
    """(start, length, period) of every run, by start and then by period."""
    at, period = candidates(words)
    if not len(at):
        return np.zeros((0, 3), np.int64)
    prefixes, n = _Prefixes(words), len(words)
    with np.errstate(over="ignore"):
        right = _reach(lambda k: prefixes.alike(at, at + period, k), n - at - period)
        left = _reach(lambda k: prefixes.alike(at - k, at - k + period, k), at)
    found = np.column_stack((at - left, at + right + period, period, at))
    long_enough = found[:, 1] - found[:, 0] >= np.maximum(LEAST_WORDS, LEAST_TURNS * found[:, 2])
    found = found[long_enough]
    stretches, of = np.unique(found[:, :3], axis=0, return_inverse=True)
    out, wrong = set(), []
    for i, (low, high, q) in enumerate(stretches.tolist()):
        if np.array_equal(words[low : high - q], words[low + q : high]):
            out.add((low, high - low, q))
        else:
            wrong.append(i)
    for place, q in found[np.isin(of, wrong)][:, [3, 2]].tolist():  # where digests agreed by chance
        low, high = _walked(words, place, q)
        if high - low >= max(LEAST_WORDS, LEAST_TURNS * q):
            out.add((low, high - low, q))
    return np.array(sorted(out, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)


def _split(text: str) -> Iterator[list[bytes]]:
    """The words of a text, a part of it at a time."""
    data, at = text.encode("utf-8", "surrogatepass"), 0
    while at < len(data):
        end = at + PART
        if end < len(data):
            spaces = [p for p in (data.rfind(c, at, end) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) if p > at]
            end = max(spaces) if spaces else min((p for p in (data.find(c, end) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) if p >= 0), default=len(data))
        yield data[at:end].split()
        at = end


class _Texts:
    """Texts as one sequence of numbers, one per distinct word, with a number of its own after each text."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}
        self.parts: list[np.ndarray] = []
        self.sizes: list[int] = []

    def add(self, text: str | None) -> int:
        known, size = self.known, 0
        for words in _split(text or ""):
            numbers = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
            self.parts.append(numbers)
            size += len(numbers)
        self.parts.append(np.array([-1 - len(self.sizes)]))
        self.sizes.append(size)
        return size

    def each(self) -> Iterator[tuple[np.ndarray, bytes]]:
        """The runs and the collapsed text of every text."""
        words, vocabulary = np.concatenate(self.parts), list(self.known)
        found = runs(words)
        begins = np.concatenate(([0], np.cumsum(np.array(self.sizes) + 1)))
        cuts = np.searchsorted(found[:, 0], begins)
        for i, size in enumerate(self.sizes):
            own = found[cuts[i] : cuts[i + 1]] - np.array([begins[i], 0, 0])
            kept = words[begins[i] : begins[i] + size]
            if len(own):
                change = np.zeros(size + 1, np.int64)
                np.add.at(change, own[:, 0] + own[:, 2], 1)
                np.add.at(change, own[:, 0] + own[:, 1], -1)
                kept = kept[np.cumsum(change)[:size] == 0]
            yield own, b" ".join([vocabulary[w] for w in kept.tolist()])


def _searching(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column(batch.num_columns - 1)
        kept, begin = batch.select(list(range(batch.num_columns - 1))), 0
        texts, size = _Texts(), 0
        for row in range(len(column)):
            size += texts.add(column[row].as_py()) + 1
            if size >= BLOCK_WORDS or row == len(column) - 1:
                found = list(texts.each())
                counts = np.concatenate(([0], np.cumsum([len(own) for own, _ in found])))
                flat = np.concatenate([own for own, _ in found]) if found else np.zeros((0, 3), np.int64)
                each = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(_RUN_TYPE.value_type))
                lists = pa.ListArray.from_arrays(pa.array(counts, pa.int32()), each)
                collapsed = pa.array([text.decode("utf-8", "surrogatepass") for _, text in found], pa.string())
                own_rows = kept.slice(begin, len(found))
                yield pa.RecordBatch.from_arrays([*own_rows.columns, lists, collapsed], [*own_rows.schema.names, "runs", "collapsed"])
                texts, size, begin = _Texts(), 0, row + 1


def find(docs: DataFrame, text: Column, keep: dict[str, Column]) -> DataFrame:
    """One row per document: the columns ``keep``, ``runs`` (start in words, length, period; by start and then period) and
    ``collapsed``: the words that no run holds after its first period, with one space between them."""
    slim = docs.select(*[c.alias(f"keep_{i}") for i, c in enumerate(keep.values())], text.alias("text"))
    kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in slim.schema[:-1])
    found = mapped(slim, _searching, f"{kinds}runs {RUNS}, collapsed string")
    return found.withColumnsRenamed({f"keep_{i}": name for i, name in enumerate(keep)})
