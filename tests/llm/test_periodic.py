import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from ebbtide.llm import periodic, queries
from tests.conftest import DATA
from tests.llm.cases import TEXTS, messy

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def _runs(words):
    """Every stretch of every period, and whether a smaller period holds for it too."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(6, 4 * q):
                own = words[i : i + length]
                if not any(own[p:] == own[:-p] for p in range(1, q)):
                    out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def _collapsed(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def _found(text):
    words = WORDS.findall(text or "")
    runs = _runs(words)
    return [tuple(r) for r in runs], _collapsed(words, runs)


def _random(source):
    n, letters = source.randint(0, 70), source.choice([1, 2, 2, 3, 5])
    words = [source.randrange(letters) for _ in range(n)]
    if n > 8 and source.random() < 0.6:
        a, p = source.randrange(n), 1 + source.randrange(n // 4)
        words = [w if i < a else words[min(n - 1, a + (i - a) % p)] for i, w in enumerate(words)]
    return words


@pytest.mark.parametrize("seed", range(4))
def test_runs_are_those_of_plain_loops(seed):
    source = random.Random(seed)
    for _ in range(400):
        words = _random(source)
        assert [tuple(r) for r in periodic.runs(np.array([*words, -1], np.int64)).tolist()] == _runs(words), words


def test_runs_do_not_depend_on_digests(monkeypatch):
    """Stretches whose digests agree by chance are walked word by word."""
    source = random.Random(9)
    texts = [_random(source) for _ in range(150)]
    monkeypatch.setattr(periodic._Prefixes, "alike", lambda self, i, j, n: np.ones(len(i), bool))
    for words in texts:
        assert [tuple(r) for r in periodic.runs(np.array([*words, -1], np.int64)).tolist()] == _runs(words), words


def test_suffix_array_and_range_successor():
    source = np.random.default_rng(2)
    for n in (1, 2, 3, 64, 65, 200, 700):
        words = source.integers(0, 3, n)
        order, blocks = periodic.suffix_array(words)
        assert order.tolist() == sorted(range(n), key=lambda i: words[i:].tolist())
        for starts, low, high, width in blocks:
            for s, a, b in zip(starts.tolist(), low.tolist(), high.tolist(), strict=True):
                same = [i for i in range(n - width + 1) if words[i : i + width].tolist() == words[s : s + width].tolist()]
                assert sorted(order[a:b].tolist()) == same and s % width == 0
        tree = periodic.WaveletTree(order)
        low = source.integers(0, n + 1, 300)
        high = np.minimum(low + source.integers(0, n + 1, 300), n)
        least = source.integers(0, n + 2, 300)
        expected = [min((v for v in order[a:b] if v >= x), default=n) for a, b, x in zip(low, high, least, strict=True)]
        assert tree.successor(low, high, least).tolist() == expected


def test_texts_across_blocks_and_very_long_ones(spark, monkeypatch):
    source = random.Random(5)
    texts = [" ".join(map(str, _random(source))) for _ in range(200)] + [None, "", " \n", "é é é é é é é", "\x1c\x1c a\x0bb"]
    for words, part in ((7, 5), (1 << 17, 1 << 20)):
        monkeypatch.setattr(periodic, "BLOCK_WORDS", words)
        monkeypatch.setattr(periodic, "PART", part)
        import pyarrow as pa

        batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["k", "text"])
        got = [r for b in periodic._searching([batch, batch.slice(0, 0)]) for r in b.to_pylist()]
        assert [r["k"] for r in got] == list(range(len(texts)))
        for r, text in zip(got, texts, strict=True):
            assert ([(x["start"], x["length"], x["period"]) for x in r["runs"]], r["collapsed"]) == _found(text)
    # A hundred thousand words: a period of 7 within one of 5,000.
    unit = [f"u{i}" for i in range(4000)] + [f"v{i % 7}" for i in range(1000)]
    long = "start " + " ".join(unit * 20) + " end"
    docs = spark.createDataFrame([(1, long), (2, "x " * 150_000)], "doc_id long, text string")
    got = {r.doc_id: r for r in periodic.find(docs, docs["text"], {"doc_id": docs["doc_id"]}).collect()}
    expected = [(1, 100_000, 5000)] + [(1 + 5000 * i + 4000, 1000, 7) for i in range(20)]
    assert [tuple(r) for r in got[1].runs] == expected and [tuple(r) for r in got[2].runs] == [(0, 150_000, 1)]
    assert got[1].collapsed == "start " + " ".join(unit[:4007]) + " end" and got[2].collapsed == "x"


def test_awkward_rows(spark, empty):
    df = messy(spark)
    found = periodic.find(df, df["text"], {"doc_id": df["doc_id"], "runs_": df["n"]})
    assert found.columns == ["doc_id", "runs_", "runs", "collapsed"]
    got = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in found.collect()), key=repr)

    def expected(key, text):
        words = WORDS.findall(text or "")
        runs = [(0, 120_000, 2 * 13 * 977)] if key in (10, 11) else []
        return key, runs, _collapsed(words, runs)

    assert got == sorted((expected(k, t) for k, t in TEXTS), key=repr)
    assert periodic.find(empty, empty["text"], {"doc_id": empty["doc_id"]}).collect() == []


def _expected(key, text):
    words = WORDS.findall(text or "")
    n = len(words)
    if key is not None and n:
        h = zlib.crc32(str(key).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = _runs(words)
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    return key, len(runs), *told, digest(listed), digest(_collapsed(words, runs))


def test_query(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    found = queries.QUERIES["op11_periodic_runs"](spark, DATA)
    short = [(k, t) for k, t in texts if len(t or "") < 20_000]
    expected = {k: _expected(k, t) for k, t in short}
    got = {r[0]: tuple(r) for r in found.collect()}
    assert len(got) == len(texts) and {k: got[k] for k in expected} == expected and sum(r[1] > 0 for r in got.values()) > 5


def test_query_on_awkward_rows(spark, tmp_path):
    messy(spark).write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.QUERIES["op11_periodic_runs"](spark, str(tmp_path))
    texts = {}
    for key, text in TEXTS:
        texts.setdefault(key, set()).add(text)
    got = found.collect()
    assert len(got) == len(TEXTS)
    for r in got:
        if r.doc_id not in (10, 11):  # too long for plain loops
            assert tuple(r) in {_expected(r.doc_id, text) for text in texts[r.doc_id]}
