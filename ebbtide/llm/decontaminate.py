"""Test items in training documents: rare n-gram seeds, then local alignment.

A document holds an item if a local alignment of words (Smith-Waterman: words equal, replaced, left out, put in) reaches a
given share of the best score that the item could reach, 0 to 1. What such an alignment must contain decides the seeds, so that none
is missed, however it was edited and however often:

* Of an item of n words with score f, m words match and e are edits, 2m - e >= 2fn. The matches are at most e + 1 stretches,
  so at least T = (2f - 1)n - 1 pairs of neighbouring words are as in the item. Pairs are the seeds where that is 1 or more;
  items too short for it have their single words as seeds, of which at least T = fn match. All lie within (3 - 2f)n words of text.
* A first pass counts in how many documents each seed occurs. Each item leaves out its T - 1 commonest seeds: one of the T in
  a copy is among the others, its rare seeds. In the second pass they join documents to items inside the scan's own tasks.
* A document and an item that meet have their seeds counted, and only where T of them lie within (3 - 2f)n words is the text
  aligned with the item. Alignments of equal stretches are made once.

A block of seeds goes to each task (its size is a parameter, so that a benchmark of any size is several passes over the texts
and no larger table in memory).

Words are runs of letters and digits in lower case (ASCII letters; other characters are kept as they are).
Defined results: null and empty texts hold no item; items without words are never found. Repeated items are found each under their id,
repeated documents each get their rows. Items with a null id have no id to be found under in ``find``; ``clean`` removes their
copies like all others'. Without items, or without documents, nothing is found.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm import hashing
from ebbtide.llm.frames import fresh, mapped, named, sized, stored

#: Word equal, word replaced, word left out or put in.
MATCH, REPLACED, GAP = 2, -1, -1
SCORE = 0.6
#: Seeds that go to a task at once (16 bytes each), and words of items (8 bytes each).
BLOCK_SEEDS = 1_000_000
#: Bytes of texts whose alignments are remembered in a task.
MEMORY = 32 << 20


def seed_width(n: int, score: float) -> tuple[int, int]:
    """Words of a seed (2 or 1) for an item of ``n`` words, and how many seeds each copy holds at least."""
    pairs = math.ceil((2 * score - 1) * n - 1 - 1e-9)
    return (2, pairs) if pairs >= 1 else (1, max(1, math.ceil(score * n - 1e-9)))


def seeds_of(words: np.ndarray, width: int) -> np.ndarray:
    """The seed that begins at each word."""
    return hashing.runs(words, 2) if width == 2 else hashing.mix(words + np.uint64(1))


class _Seeds:
    """Distinct seeds of a block with their items, in the order of the digests."""

    def __init__(self, seeds: np.ndarray, owner: np.ndarray) -> None:
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.owner = seeds[order], owner[order]
        #: Most seeds are told absent by this table of bits alone.
        self.sieve = np.zeros(1 << 22, bool)
        self.sieve[(self.seeds >> np.uint64(42)).astype(np.int64)] = True

    def rows(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``found``, item) of every seed in this block."""
        maybe = np.flatnonzero(self.sieve[(found >> np.uint64(42)).astype(np.int64)])
        low = np.searchsorted(self.seeds, found[maybe], side="left")
        count = np.searchsorted(self.seeds, found[maybe], side="right") - low
        row = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
        return np.repeat(maybe, count), self.owner[row]


class Items:
    """A block of test items as arrays: their words, their seeds, and how many of these a copy holds at least."""

    def __init__(self, ids: list[int], words: list[np.ndarray], score: float) -> None:
        self.ids, self.words = ids, words
        sizes = np.array([len(w) for w in words])
        of = [seed_width(len(w), score) for w in words]
        self.width, self.needed = (np.array([x[i] for x in of]) for i in range(2))
        self.span = np.floor((3 - 2 * score) * sizes + 1e-9).astype(np.int64)
        every = [seeds_of(w, k) for w, k in zip(words, self.width.tolist(), strict=True)]
        #: One row per place of an item; an item may hold a seed several times.
        self.seeds = np.concatenate(every) if every else np.zeros(0, np.uint64)
        self.owner = np.repeat(np.arange(len(words)), [len(s) for s in every])
        self.distinct = np.unique(self.seeds)
        pairs = np.unique(np.rec.fromarrays([self.seeds, self.owner]))
        self.all = _Seeds(np.asarray(pairs["f0"]), np.asarray(pairs["f1"]))
        self.rare = self.all

    def keep_rare(self, documents: np.ndarray) -> None:
        """Leaves out each item's commonest seeds; ``documents`` has the number for each of the ``distinct`` seeds."""
        often = documents[np.searchsorted(self.distinct, self.seeds)]
        order = np.lexsort((self.seeds, -often, self.owner))
        owner = self.owner[order]
        rank = np.arange(len(order)) - np.searchsorted(owner, owner)
        kept = order[rank >= self.needed[owner] - 1]
        pairs = np.unique(np.rec.fromarrays([self.seeds[kept], self.owner[kept]]))
        self.rare = _Seeds(np.asarray(pairs["f0"]), np.asarray(pairs["f1"]))


def _text_seeds(words: np.ndarray, widths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Seeds of a text with the word each begins at."""
    seeds = [seeds_of(words, k) for k in widths]
    return np.concatenate(seeds), np.concatenate([np.arange(len(s)) for s in seeds])


def _texts(column: pa.Array) -> Iterator[np.ndarray]:
    data, offsets = hashing.text_bytes(column)
    for _, words, marks in hashing.words_of(data, offsets, hashing.plain_words()):
        for a, b in zip(marks[:-1].tolist(), marks[1:].tolist(), strict=True):
            yield words[a:b]


def align(text: np.ndarray, item: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: its score, and the first and the end word of the text in it.

    One step per word of the item, over all words of the text at once: runs of words put in are a running maximum."""
    n = len(text)
    ramp = -GAP * np.arange(n + 1)
    score = np.zeros(n + 1, np.int64)
    origin = np.arange(n + 1)
    best, span = 0, (0, 0)
    for word in item:
        up = score + GAP
        diagonal = np.concatenate(([0], score[:-1] + np.where(text == word, MATCH, REPLACED)))
        from_diagonal = np.concatenate(([0], origin[:-1]))
        value = np.maximum(up, diagonal)
        source = np.where(diagonal >= up, from_diagonal, origin)
        fresh_start = value <= 0
        value[fresh_start] = 0
        source[fresh_start] = np.flatnonzero(fresh_start)
        lifted = value + ramp
        run = np.maximum.accumulate(lifted)
        holder = np.maximum.accumulate(np.where(lifted == run, np.arange(n + 1), 0))
        score = run - ramp
        origin = source[holder]
        top = int(score.argmax())
        if score[top] > best:
            best, span = int(score[top]), (int(origin[top]), top)
    return best, *span


def _stretches(low: np.ndarray, high: np.ndarray) -> list[tuple[int, int]]:
    """Ranges as few as they can be; ranges that overlap are one. Given in the order of ``low``."""
    out: list[tuple[int, int]] = []
    for a, b in zip(low.tolist(), high.tolist(), strict=True):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _counting(items: Items):
    widths = sorted(set(items.width.tolist()))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(items.distinct), np.int64)
        for batch in batches:
            for words in _texts(batch.column(0)):
                found, _ = _text_seeds(words, widths)
                maybe = found[items.all.sieve[(found >> np.uint64(42)).astype(np.int64)]]
                if len(maybe):
                    at = np.minimum(np.searchsorted(items.distinct, maybe), len(items.distinct) - 1)
                    total[np.unique(at[items.distinct[at] == maybe])] += 1
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(items.distinct[there].view(np.int64)), pa.array(total[there])], ["seed", "documents"]
        )

    return count


def _aligning(items: Items, least: float):
    widths = sorted(set(items.width.tolist()))

    def aligned(i: int, text: np.ndarray, memory: dict) -> tuple[int, int, int]:
        key = (i, text.tobytes())
        if key not in memory:
            if memory.get("bytes", 0) > MEMORY:
                memory.clear()
            memory["bytes"] = memory.get("bytes", 0) + text.nbytes + 200
            memory[key] = align(text, items.words[i])
        return memory[key]

    def matches(words: np.ndarray, memory: dict) -> Iterator[tuple[int, float, int, int]]:
        found, begins = _text_seeds(words, widths)
        _, met = items.rare.rows(found)
        if not len(met):
            return
        meets = np.zeros(len(items.ids), bool)
        meets[met] = True
        place, owner = items.all.rows(found)
        mine = meets[owner]
        owner, at = owner[mine], begins[place[mine]]
        order = np.lexsort((at, owner))
        owner, at = owner[order], at[order]
        last = np.arange(len(owner)) + items.needed[owner] - 1
        whole = last < len(owner)
        last = np.minimum(last, len(owner) - 1)
        dense = whole & (owner[last] == owner) & (at[last] + items.width[owner] - at <= items.span[owner])
        if not dense.any():
            return
        first, last, own = at[dense], at[last[dense]], owner[dense]
        low, high = last + items.width[own] - items.span[own], first + items.span[own]
        cuts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        for begin, end in zip(cuts, [*cuts[1:], len(own)], strict=True):
            i, best = int(own[begin]), (0, 0, 0)
            for a, b in _stretches(low[begin:end], high[begin:end]):
                a, b = max(a, 0), min(b, len(words))
                score, start, stop = aligned(i, words[a:b], memory)
                if score > best[0]:
                    best = (score, a + start, a + stop)
            size = MATCH * len(items.words[i])
            if best[0] >= least * size:
                yield i, best[0] / size, best[1], best[2]

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict = {}
        for batch in batches:
            rows, out = [], []
            for row, words in enumerate(_texts(batch.column(batch.num_columns - 1))):
                if len(items.distinct):
                    for match in matches(words, memory):
                        rows.append(row)
                        out.append(match)
            kept = batch.select(list(range(batch.num_columns - 1))).take(pa.array(rows, pa.int64()))
            new = [
                pa.array([items.ids[m[0]] for m in out], pa.int64()),
                pa.array([m[1] for m in out], pa.float64()),
                pa.array([m[2] for m in out], pa.int64()),
                pa.array([m[3] for m in out], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays([*kept.columns, *new], [*kept.schema.names, "item_id", "score", "first_word", "end_word"])

    return search


def _blocks(benchmark: DataFrame, id_: str, text: str, seeds: int, score: float) -> Iterator[Items]:
    """The test items, a bounded number of words at a time."""
    ids, words, size = [], [], 0
    for row in benchmark.select(named(benchmark, id_).alias("id"), named(benchmark, text).alias("text")).toLocalIterator():
        own = next(_texts(pa.array([row["text"]], pa.string())))
        if row["id"] is None or not len(own):
            continue
        ids.append(row["id"])
        words.append(own)
        size += len(own)
        if size >= seeds:
            yield Items(ids, words, score)
            ids, words, size = [], [], 0
    if ids:
        yield Items(ids, words, score)


def find(
    docs: DataFrame,
    text: str,
    keep: list[str],
    benchmark: DataFrame,
    item_id: str = "item_id",
    item_text: str = "text",
    score: float = SCORE,
    block: int = BLOCK_SEEDS,
) -> DataFrame:
    """The columns ``keep`` (as ``keep_0`` ..) of each document that holds a test item, with ``item_id``, ``score``,
    ``first_word`` and ``end_word``: one row per document row and item."""
    spark = docs.sparkSession
    texts = docs.select(*[named(docs, c).alias(f"keep_{i}") for i, c in enumerate(keep)], named(docs, text).alias("text"))
    kept = "".join(f"keep_{i} {texts.schema[i].dataType.simpleString()}, " for i in range(len(keep)))
    schema = f"{kept}item_id long, score double, first_word long, end_word long"
    found = None
    for items in _blocks(benchmark, item_id, item_text, block, score):
        counted = mapped(texts.select("text"), _counting(items), "seed long, documents long")
        totals = counted.groupBy("seed").agg(F.sum("documents").alias("documents")).collect()  # seeds of one block
        documents = np.zeros(len(items.distinct), np.int64)
        seeds = np.array([r["seed"] for r in totals], np.int64).view(np.uint64)
        documents[np.searchsorted(items.distinct, seeds)] = [r["documents"] for r in totals]
        items.keep_rare(documents)
        some = stored(mapped(texts, _aligning(items, score), schema), "test-items")
        found = some if found is None else found.unionByName(some)
    return spark.createDataFrame([], schema) if found is None else found


def clean(docs: DataFrame, text: str, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows whose text holds a test item; all columns stay."""
    digest = fresh(docs.columns, "_digest")
    keyed = docs.withColumn(digest, F.xxhash64(F.coalesce(named(docs, text), F.lit(""))))
    # Only the texts count here: items get ids of their own, so that those without one are looked for too.
    options.pop("item_id", None)
    given = named(benchmark, options.pop("item_text", "text")).alias("text")
    items = benchmark.select(given).distinct().select(F.monotonically_increasing_id().alias("item_id"), "text")
    found = find(keyed, text, [digest], items, **options)
    gone = stored(found.select(F.col("keep_0").alias(digest)).distinct(), "found-digests")
    return keyed.join(sized(gone), digest, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
