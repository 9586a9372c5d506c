import zlib

import numpy as np
import public_tokenizers
import pytest

from ebbtide.llm import packing, queries, tokens
from tests.conftest import DATA
from tests.llm.cases import TEXTS

PATH = public_tokenizers.path("byte_bpe_50k.json")


def _histogram(lengths):
    return {int(k): int(n) for k, n in zip(*np.unique(lengths, return_counts=True), strict=True)}


@pytest.mark.parametrize("kind", ["uniform", "short", "long", "skewed", "few"])
def test_plan_places_every_piece_once_and_tightly(kind):
    rng = np.random.default_rng(3)
    lengths = {
        "uniform": rng.integers(1, 129, 4000),
        "short": rng.integers(1, 20, 4000),
        "long": rng.integers(70, 129, 500),
        "skewed": np.minimum(rng.geometric(0.02, 4000), 128),
        "few": np.array([128, 127, 1, 64, 64, 3]),
    }[kind]
    made = packing.plan(_histogram(lengths), 128)
    filled, seen = {}, {}
    for length, first, end, sequence, times, offset in made.rows:
        assert first == seen.get(length, 0) and (end - first) % times == 0
        seen[length] = end
        for s in range(sequence, sequence + (end - first) // times):
            filled.setdefault(s, []).append((offset, length * times))
    assert seen == _histogram(lengths) and len(filled) == made.sequences
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 128
    least = max(-(-int(lengths.sum()) // 128), int((lengths > 64).sum()))
    assert made.sequences <= least * 1.02 + 2


def test_fit_is_the_least_squares_solution():
    lengths, counts = np.array([1, 2, 3]), np.array([5, 4, 5])
    ways = packing.patterns(lengths, 4)
    assert sorted(tuple(lengths[i] for i in w if i >= 0) for w in ways) == [(1, 1, 2), (1, 3), (2, 2)]
    x = packing.fit(ways, counts, np.ones(3))
    used = {tuple(sorted(lengths[i] for i in w if i >= 0)): v for w, v in zip(ways, x, strict=True)}
    assert used[1, 3] == pytest.approx(5, abs=1e-3) and used[2, 2] == pytest.approx(2, abs=1e-3)


def _check(found, texts, capacity):
    encoder, pieces = tokens.encoder(PATH), []
    for key, text in texts:
        ids = [*encoder.slow(text or ""), 2]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            pieces.append((key, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found), key=repr) == sorted(pieces, key=repr)
    by = {}
    for r in found:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by), -(-sum(p[3] for p in pieces) // capacity)


def test_query(spark):
    found = queries.QUERIES["op2_best_fit_packing"](spark, DATA).collect()
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    used, least = _check(found, texts, 1024)
    assert used <= 1.05 * least + 2


def test_awkward_rows_with_their_ids(messy):
    df = packing.pack_texts(messy, "text", ["doc_id", "length"], PATH, 64, 2, with_ids=True).withColumnsRenamed({})
    assert df.columns == ["doc_id", "length", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"]
    found = packing.pack_texts(messy, "text", ["doc_id"], PATH, 64, 2, with_ids=True).collect()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in found)
    _check(found, TEXTS, 64)


def test_a_length_that_most_pieces_have_is_numbered_in_parts(spark):
    found = spark.range(5000).selectExpr("id AS keep_0", "0 AS piece", "0L AS start", "IF(id % 10 = 0, 30L, 50L) AS length", "id AS ids_crc32")
    packed = packing.pack(found, 100, numbered=100).collect()
    places = {(r.sequence_id, r.offset) for r in packed}
    assert len(places) == len(packed) == 5000
    assert len({r.sequence_id for r in packed}) <= 2250 + 170


def test_empty(empty):
    assert packing.pack_texts(empty, "text", ["doc_id"], PATH, 64, 2).collect() == []
