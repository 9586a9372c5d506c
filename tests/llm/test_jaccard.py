import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import jaccard, queries
from tests.conftest import DATA
from tests.llm.cases import TEXTS, messy, rows


def _set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if 0 < len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def _expected(texts, percent=75):
    """(id, set size, smallest id reached), comparing all pairs."""
    sets = [_set(t) for _, t in texts]
    above = list(range(len(texts)))

    def root(i):
        while above[i] != i:
            i = above[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if both and 100 * both >= percent * (len(x) + len(sets[j]) - both):
                above[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(texts):
        known = [k for k in (least.get(root(i)), key) if k is not None]
        least[root(i)] = min(known) if known else None
    return sorted(((k, len(s), least[root(i)] if s else k) for i, ((k, _), s) in enumerate(zip(texts, sets, strict=True))), key=repr)


def _corpus(seed, families, copies, boilerplate):
    """Families of edited copies, some with a shared passage, some exact."""
    rng, out = random.Random(seed), []
    passage = [f"common{i}" for i in range(40)]
    for family in range(families):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 5, 8, 30, 120]))]
        for _ in range(rng.randrange(1, copies)):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 6])):
                at = rng.randrange(len(words))
                words[at : at + rng.choice([0, 1])] = [f"e{rng.randrange(50)}"] * rng.choice([0, 1, 1])
            if rng.random() < boilerplate:
                words = words + passage if rng.random() < 0.5 else passage + words
            out.append(" ".join(words))
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize(("seed", "families", "copies", "boilerplate"), [(1, 60, 8, 0.3), (2, 8, 60, 0.9), (3, 150, 3, 0.0)])
def test_all_links_are_found(spark, monkeypatch, seed, families, copies, boilerplate):
    monkeypatch.setattr(jaccard, "FREQUENT", 5)
    texts = _corpus(seed, families, copies, boilerplate)
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    found = jaccard.join(docs, "doc_id", "text")
    assert rows(found, "id", "n_shingles", "component_id") == _expected(texts)


@pytest.mark.parametrize("percent", [50, 90])
def test_other_thresholds(spark, percent):
    texts = _corpus(7, 30, 9, 0.5)
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert rows(jaccard.join(docs, "doc_id", "text", percent=percent), "id", "n_shingles", "component_id") == _expected(texts, percent)


def test_a_pivot_with_many_partners_has_several_groups(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "COMPARED", 7)
    base = [f"w{i}" for i in range(100)]
    texts = [(i, " ".join([*base[:50], f"x{i}", *base[51:]])) for i in range(90)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    assert rows(jaccard.join(docs, "doc_id", "text"), "id", "n_shingles", "component_id") == _expected(texts)


def _pages(seed, count, kinds, held, edits):
    """Pages of stock paragraphs, a few of them edited copies of others."""
    rng = random.Random(seed)
    stock = [[f"p{kind}w{i}" for i in range(25)] for kind in range(kinds)]
    out = []
    for _ in range(count):
        if out and rng.random() < edits:
            words = rng.choice(out).split()
            for _ in range(rng.randrange(1, 5)):
                words[rng.randrange(len(words))] = f"e{rng.randrange(1000)}"
        else:
            words = [w for kind in rng.sample(range(kinds), held) for w in stock[kind]]
        out.append(" ".join(words))
    return list(enumerate(out))


@pytest.mark.parametrize(("together", "percent"), [(256, 75), (6, 75), (2, 75), (6, 40), (6, 90)])
def test_large_regions_are_divided(spark, monkeypatch, together, percent):
    """Pages of common paragraphs share regions without being linked."""
    monkeypatch.setattr(jaccard, "UNDIVIDED", 4)
    monkeypatch.setattr(jaccard, "TOGETHER", together)
    texts = _pages(together, 260, 14, 6, 0.3)
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    assert rows(jaccard.join(docs, "doc_id", "text", percent=percent), "id", "n_shingles", "component_id") == _expected(texts, percent)


def test_regions_that_no_division_helps(spark, monkeypatch):
    """Sets of few, common shingles, and families of near copies around one pivot."""
    monkeypatch.setattr(jaccard, "UNDIVIDED", 3)
    monkeypatch.setattr(jaccard, "TOGETHER", 3)
    rng = random.Random(5)
    texts = list(enumerate(" ".join(rng.choice("ab") for _ in range(rng.randrange(5, 40))) for _ in range(120)))
    texts += [(1000 + i, t) for i, t in _corpus(4, 4, 30, 0.9)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    assert rows(jaccard.join(docs, "doc_id", "text"), "id", "n_shingles", "component_id") == _expected(texts)


def test_windows_without_a_pair_to_compare_go_no_further(spark):
    """Of a group's windows those stay whose set may be linked with one of another component in it."""
    percent, source = 75, random.Random(6)
    drawn = [(source.randrange(12), cid, n := source.randrange(4, 60), source.randrange(n // 4 + 1), cid % source.choice([1, 3])) for cid in range(60)]
    drawn += [(100, cid, 20, cid % 5, 7) for cid in range(50)]  # one component
    drawn += [(102, 1, 20, 0, 1), (102, 2, 20, 5, 2), (102, 3, 21, 0, 3)]
    windows = spark.createDataFrame(drawn, "key long, cid long, n int, place int, root long")
    kept = {tuple(r) for r in jaccard._meeting(windows, percent, "key").collect()}

    def reached(x, y):
        return min(x[2] - x[3], y[2] - y[3]) * (100 + percent) >= (x[2] + y[2]) * percent

    needed = {x for x in drawn for y in drawn if x[0] == y[0] and x[4] != y[4] and reached(x, y)}
    assert needed and needed <= kept <= set(drawn)
    assert not {x for x in kept if x[0] == 100} and (102, 2, 20, 5, 2) not in kept


def test_regions_across_batches(spark):
    """Rows of a key may lie in many batches; a region's pivot goes with each of them."""
    import pyarrow as pa

    rng = np.random.default_rng(0)
    key = np.sort(rng.integers(0, 60, 400))
    rows_ = sorted({(int(k), int(rng.integers(0, 5)), int(rng.integers(0, 12))) for k in key})
    rows_ = sorted(((k, c % 4, c) for k, _, c in rows_ + rows_[::3]), key=lambda r: (r[0], r[2]))  # repeated classes too
    expected = []
    for k in {r[0] for r in rows_}:
        members = sorted({(r[2], r[1]) for r in rows_ if r[0] == k})
        if len(members) > 1:
            expected += [(k, c, n, *members[0]) for c, n in members]
    for size in (1, 2, 3, 7, 1000):
        batches = [
            pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in part]), pa.array([r[2] for r in part]), pa.array([r[1] for r in part], pa.int32()), pa.array([0] * len(part), pa.int32())],
                ["key", "cid", "n", "place"],
            )
            for part in (rows_[i : i + size] for i in range(0, len(rows_), size))
        ]
        got = [r for b in jaccard._shared(iter(batches)) for r in b.to_pylist()]
        assert sorted((r["key"], r["cid"], r["n"], r["pivot"], r["pivot_n"]) for r in got) == sorted(expected)


def test_awkward_rows(spark, empty):
    found = jaccard.join(messy(spark), "doc_id", "text")
    assert rows(found, "id", "n_shingles", "component_id") == _expected(TEXTS)
    assert jaccard.join(empty, "doc_id", "text").collect() == []


def test_one_document_of_each_group_stays(spark, empty):
    df = messy(spark)
    kept = jaccard.distinct_documents(df, "doc_id", "text")
    assert kept.columns == df.columns
    # 1 and 2 have one set, 6 and 7 too, 9 is there twice, 10 and 11 are near copies; without words all stay.
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        [(k, t) for i, (k, t) in enumerate(TEXTS) if k not in (2, 7, 11) and not (k == 9 and i == TEXTS.index((k, t)))], key=repr
    )
    assert jaccard.distinct_documents(empty, "doc_id", "text").collect() == []


def test_components_of_a_chain(spark):
    links = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).unionByName(spark.sql("SELECT 1000L AS a, 1001L AS b"))
    found = {r.cid: r.root for r in jaccard.components(links).collect()}
    assert found == {**{i: 0 for i in range(201)}, 1000: 1000, 1001: 1000}


def test_small_tables_are_few_files(spark, monkeypatch):
    """However many partitions the shuffles have: a table of few rows is a file, a larger one is as many as its rows are worth."""
    from ebbtide.llm import frames

    links = spark.range(400).select(F.col("id").alias("a"), (F.col("id") + 1000).alias("b"))
    before = {key: spark.conf.get(key) for key in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = jaccard.components(links)
        assert len(found.inputFiles()) == 1
        monkeypatch.setattr(frames, "FILE_ROWS", 400)
        several = jaccard.components(links)
        assert len(several.inputFiles()) == 4  # 800 ends of links, and their rows beside their neighbours'
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert rows(found, "cid", "root") == rows(several, "cid", "root") == sorted(((i + k, i) for i in range(400) for k in (0, 1000)), key=repr)


def test_query(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    found = queries.QUERIES["op10_ngram_jaccard_join"](spark, DATA)
    assert rows(found, "doc_id", "n_shingles", "component_id") == _expected(texts)
