"""Digests of words and of runs of words, for whole Arrow batches of texts at once."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes hashed at once; each costs some 40 bytes of memory meanwhile.
BLOCK = 1 << 18
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def spaced_words() -> np.ndarray:
    """Byte table: white space (space, tab to carriage return) is 0, A-Z are lower case."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[[32, *range(9, 14)]] = 0
    return _distinct(table, {32, *range(9, 14)})


def exact_words() -> np.ndarray:
    """Byte table: white space (space, tab to carriage return) is 0, all else as it is."""
    return _distinct(np.arange(256, dtype=np.uint8), {32, *range(9, 14)})


def plain_words() -> np.ndarray:
    """Byte table: every ASCII byte but letters and digits is 0, A-Z are lower case."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    keep = {*range(48, 58), *range(97, 123), *range(65, 91), *range(128, 256)}
    return _distinct(table, set(range(256)) - keep)


def _distinct(table: np.ndarray, separators: set[int]) -> np.ndarray:
    """Room for the zero byte: codes are one more than the byte, 0 is for separators."""
    codes = table.astype(np.uint16) + 1
    codes[sorted(separators)] = 0
    return codes


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def row(base: int) -> np.ndarray:
        out = np.full(size, base, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return row(_BASE), row(_INVERSE)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column one after the other, and where each row begins. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, places, data = column.buffers()
    if len(column) == 0 or places is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(places, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    if column.null_count:
        kept = np.where(np.asarray(column.is_valid()), np.diff(offsets), 0)
        if int(kept.sum()) != int(offsets[-1] - offsets[0]):
            return text_bytes(column.fill_null(""))
    return np.frombuffer(data, np.uint8), offsets


def _hash_block(codes: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Digest and first place of each word; ``breaks`` are places where a text begins."""
    inside = codes > 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    breaks = breaks[(breaks > 0) & (breaks < len(codes))]
    first[breaks] = inside[breaks]
    last[breaks - 1] = inside[breaks - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _powers(max(BLOCK * 2, 1 << (len(codes) + 1).bit_length()))
    total = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(codes * up[: len(codes)], out=total[1:])
    words = (total[ends] - total[starts]) * down[starts]
    return mix(words + (ends - starts).astype(np.uint64) * np.uint64(_BASE)), starts


def words_of(
    data: np.ndarray, offsets: np.ndarray, table: np.ndarray
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For runs of texts: the first text's number, the digests of all their words, and where each
    text's words begin among them. A text longer than a block is hashed in parts that end at separators."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(int(np.searchsorted(offsets, offsets[row] + BLOCK, side="right")) - 1, row + 1)
        low, high = int(offsets[row]), int(offsets[end])
        if high - low <= BLOCK:
            marks = offsets[row : end + 1] - low
            words, starts = _hash_block(table[data[low:high]], marks)
            yield row, words, np.searchsorted(starts, marks)
        else:
            parts = []
            while low < high:
                stop = min(low + BLOCK, high)
                if stop < high:
                    gaps = np.flatnonzero(table[data[low:stop]] == 0)
                    if not len(gaps):  # one word longer than a block
                        later = np.flatnonzero(table[data[stop:high]] == 0)
                        stop = stop + int(later[0]) if len(later) else high
                    else:
                        stop = low + int(gaps[-1]) + 1
                parts.append(_hash_block(table[data[low:stop]], np.zeros(0, np.int64))[0])
                low = stop
            words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            yield row, words, np.array([0, len(words)])
        row = end


def runs(words: np.ndarray, width: int) -> np.ndarray:
    """Digests of every ``width`` consecutive words; none if there are fewer."""
    if len(words) < width:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - width + 1, dtype=np.uint64)
    for i in range(width):
        out *= np.uint64(_BASE)
        out += words[i : i + len(out)]
    return mix(out)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """The set of a text: ascending distinct digests of its runs, or of all its words if there are fewer."""
    if 0 < len(words) < width:
        return mix(runs(words, len(words)) + np.uint64(len(words)))
    found = np.sort(runs(words, width))
    return found[np.concatenate(([True], found[1:] != found[:-1]))] if len(found) else found
