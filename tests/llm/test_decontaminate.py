import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ebbtide.llm import decontaminate, queries
from tests.conftest import DATA
from tests.llm.cases import messy, rows


def _plain_align(text, item):
    """Smith-Waterman by its definition."""
    best = 0
    before = [0] * (len(text) + 1)
    for word in item:
        row = [0]
        for j, other in enumerate(text):
            same = decontaminate.MATCH if word == other else decontaminate.REPLACED
            row.append(max(0, before[j] + same, before[j + 1] + decontaminate.GAP, row[j] + decontaminate.GAP))
        best = max(best, *row)
        before = row
    return best


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=25), st.lists(st.integers(0, 4), min_size=1, max_size=12))
def test_alignment_is_smith_waterman(text, item):
    score, first, end = decontaminate.align(np.array(text, np.uint64), np.array(item, np.uint64))
    assert score == _plain_align(text, item)
    if score:
        assert _plain_align(text[first:end], item) == score


def _words(text):
    return next(decontaminate._texts(pa.array([text], pa.string())))


def _brute(texts, items, least):
    """Every whole text aligned with every item."""
    out = []
    for key, text in texts:
        own = _words(text)
        for item, words in items:
            words = _words(words)
            if len(words) and len(own) and (score := decontaminate.align(own, words)[0]) >= least * decontaminate.MATCH * len(words):
                out.append((key, item, round(score / (decontaminate.MATCH * len(words)), 9)))
    return sorted(out, key=repr)


def _found(df):
    return sorted(((r.keep_0, r.item_id, round(r.score, 9)) for r in df.collect()), key=repr)


def test_edited_copies(spark):
    rng = random.Random(5)
    items = [(i, " ".join(f"t{rng.randrange(3000)}" for _ in range(rng.randrange(12, 50)))) for i in range(12)]
    texts = []
    for i in range(150):
        words = [f"t{rng.randrange(3000)}" for _ in range(rng.randrange(10, 150))]
        if i % 3 == 0:
            copy = items[i % 12][1].split()
            for _ in range(rng.randrange(0, 1 + len(copy) // 6)):
                at = rng.randrange(len(copy))
                copy[at : at + rng.choice([0, 1])] = rng.choice([[], ["new"], ["New,"]])
            at = rng.randrange(len(words))
            words[at:at] = copy
        texts.append((i, " ".join(words).upper() if i % 5 == 0 else " ".join(words)))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find(docs, "text", ["doc_id"], benchmark)
    assert _found(found) == _brute(texts, items, decontaminate.SCORE)
    assert len({r.keep_0 for r in found.collect()}) >= 48
    # In blocks of a few items each.
    assert _found(decontaminate.find(docs, "text", ["doc_id"], benchmark, block=60)) == _found(found)


def _edited(words, rng, kind, count):
    out = list(words)
    for at in sorted(rng.sample(range(len(out)), min(count, len(out))), reverse=True):
        out[at : at + (kind != "put in")] = {"replaced": ["new"], "left out": [], "put in": ["put"]}[kind]
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 7, 11, 15, 40])
def test_nothing_that_whole_alignment_finds_is_missed(spark, n):
    """Short and long items with every kind of edit up to the limit, among texts of few words that hold many seeds."""
    rng = random.Random(n)
    items = [(i, " ".join(f"t{rng.randrange(30 if i % 2 else 4)}" for _ in range(n))) for i in range(6)]
    texts = []
    for i in range(240):
        words = [f"t{rng.randrange(40)}" for _ in range(rng.randrange(0, 60))]
        copy = items[i % 6][1].split()
        for _ in range(rng.randrange(1, 3)):
            copy = _edited(copy, rng, rng.choice(["replaced", "left out", "put in"]), rng.randrange(0, 1 + max(1, n // 3)))
        at = rng.randrange(len(words) + 1)
        words[at:at] = copy if i % 4 else []
        texts.append((i, " ".join(words)))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    found = decontaminate.find(docs, "text", ["doc_id"], spark.createDataFrame(items, "item_id long, text string"))
    assert _found(found) == _brute(texts, items, decontaminate.SCORE) and found.count() > 0


def test_seeds_are_those_that_every_copy_holds():
    """The bound against random alignments' own pairs and words."""
    rng = random.Random(1)
    for _ in range(4000):
        n = rng.randrange(1, 40)
        item, text, pairs, words, edits, span, fresh_run = list(range(n)), [], 0, 0, 0, 0, True
        for w in item:
            lot = rng.random()
            if lot < 0.2:
                edits, fresh_run = edits + 1, True
                span += lot < 0.12
                continue
            if lot > 0.8 and words:
                edits, fresh_run, span = edits + 1, True, span + 1
            pairs, words, span, fresh_run = pairs + (not fresh_run), words + 1, span + 1, False
        if 2 * words - edits >= 1.2 * n:
            width, needed = decontaminate.seed_width(n, 0.6)
            assert (pairs if width == 2 else words) >= needed and span <= 1.8 * n + 1e-9


def test_copies_of_a_very_common_item_with_edits(spark):
    """A seed is common here because the item is: three of 15 words replaced, in 300 of 2,300 documents; every fourth word replaced."""
    rng = random.Random(8)
    items = [(1, " ".join(f"q{i}" for i in range(15))), (2, " ".join(f"r{i}" for i in range(40)))]
    texts = []
    for i in range(2300):
        words = [f"w{rng.randrange(5000)}" for _ in range(40)]
        if i < 300:
            words[20:20] = _edited(items[0][1].split(), rng, "replaced", 3)
        elif i < 330:
            copy = items[1][1].split()
            copy[3::4] = ["other"] * len(copy[3::4])
            words[10:10] = copy
        texts.append((i, " ".join(words)))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(6)
    found = decontaminate.find(docs, "text", ["doc_id"], spark.createDataFrame(items, "item_id long, text string"))
    got = _found(found)
    assert got == _brute(texts, items, decontaminate.SCORE)
    assert {k for k, item, _ in got if item == 2} >= set(range(300, 330)) and sum(item == 1 for _, item, _ in got) == 300


def test_many_common_items(spark):
    """Ten items in a third of the documents each, lightly edited."""
    rng = random.Random(3)
    items = [(i, " ".join(f"i{i}.{rng.randrange(50)}" if j % 3 else "the" for j in range(24))) for i in range(10)]
    texts = []
    for i in range(600):
        words = [f"w{rng.randrange(300)}" if rng.random() < 0.7 else "the" for _ in range(50)]
        for item in rng.sample(range(10), 3):
            at = rng.randrange(len(words))
            words[at:at] = _edited(items[item][1].split(), rng, rng.choice(["replaced", "left out", "put in"]), rng.randrange(0, 6))
        texts.append((i, " ".join(words)))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    found = decontaminate.find(docs, "text", ["doc_id"], spark.createDataFrame(items, "item_id long, text string"))
    assert _found(found) == _brute(texts, items, decontaminate.SCORE)


def test_an_item_that_is_everywhere_is_found_everywhere(spark):
    item = " ".join(f"q{i}" for i in range(20))
    texts = [(i, f"a{i} b{i} {item} c{i}") for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    found = decontaminate.find(docs, "text", ["doc_id"], spark.createDataFrame([(7, item)], "item_id long, text string"))
    assert found.where((F.col("item_id") == 7) & (F.col("score") == 1)).count() == 400
    assert {(r.first_word, r.end_word) for r in found.collect()} == {(2, 22)}


ITEMS = [(1, "beta gamma delta epsilon zeta eta"), (1, "beta gamma delta epsilon zeta eta"), (2, "two"), (3, ""), (4, None), (None, "one two"), (5, "MIT license.")]


def test_awkward_rows(spark, empty):
    df = messy(spark)
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("keep_0", F.lit(1))
    found = decontaminate.find(df, "text", ["doc_id", "score"], benchmark)
    expected = [(1, 1, 1.0), (1, 1, 1.0), (2, 1, 1.0), (2, 1, 1.0), (None, 2, 1.0), (12, 5, 1.0)]
    assert _found(found) == sorted(expected, key=repr)
    clean = decontaminate.clean(df, "text", benchmark)
    assert clean.columns == df.columns
    assert rows(clean, "doc_id", "text") == rows(df.where("text IS NULL OR NOT text RLIKE '(?i)beta|two|MIT'"), "doc_id", "text")
    assert decontaminate.clean(df, "text", benchmark.where("false")).count() == df.count()
    assert decontaminate.clean(empty, "text", benchmark).collect() == []


def test_copies_of_items_without_an_id_go(spark):
    texts = [(1, "see alpha beta gamma delta epsilon there"), (2, "nothing of the kind is in this one")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    benchmark = spark.createDataFrame([(None, "alpha beta gamma delta epsilon")], "key long, body string")
    kept = decontaminate.clean(docs, "text", benchmark, item_id="key", item_text="body")
    assert [r.doc_id for r in kept.collect()] == [2]


@pytest.mark.parametrize("name", ["op9_benchmark_decontamination"])
def test_query(spark, name):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    mine = queries.QUERIES[name](spark, DATA).collect()
    found = sorted(((r.doc_id, r.item_id, round(r.score, 9)) for r in mine), key=repr)
    assert found == _brute(texts, items, decontaminate.SCORE) and found
