import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import neighbours, queries
from tests.conftest import DATA


def _exact(rows, asked, k):
    """(query, id) -> the best score, by plain inner products, best first and ties to the smaller id."""
    rows = [(i, np.asarray(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    length = max({len(v) for _, v in rows}, key=lambda n: sum(len(v) == n for _, v in rows))
    rows = [(i, v) for i, v in rows if len(v) == length]
    out = {}
    for q, x in rows:
        if asked(q):
            best = {}
            for i, v in rows:
                if i != q:
                    best[i] = max(best.get(i, -math.inf), float(x @ v))
            merged = out.setdefault(q, {})
            for i, s in best.items():
                merged[i] = max(merged.get(i, -math.inf), s)
    return {q: sorted(((-s, i) for i, s in found.items()))[:k] for q, found in out.items()}


def _check(found, exact, recall=1.0):
    by = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append(r)
    assert set(by) <= set(exact)
    hits = 0
    for q, best in exact.items():
        mine = by.get(q, [])
        assert [r.rank for r in mine] == list(range(1, len(mine) + 1))
        assert [(r.score, -r.id) for r in mine] == sorted([(r.score, -r.id) for r in mine], reverse=True)
        known = {i: -s for s, i in best}
        assert all(abs(known[r.id] - r.score) < 1e-12 for r in mine if r.id in known)
        hits += len({r.id for r in mine} & set(known))
    assert hits >= recall * sum(map(len, exact.values()))


def test_rotations_keep_lengths_and_angles():
    x = np.random.default_rng(1).normal(size=(20, 16))
    assert np.allclose(neighbours.rotated(x, 3) @ neighbours.rotated(x, 3).T, x @ x.T)
    assert not np.allclose(neighbours.rotated(x, 3), neighbours.rotated(x, 4))
    unit = neighbours.unit(x, float(np.linalg.norm(x, axis=1).max()), query=False)
    assert np.allclose(np.linalg.norm(unit, axis=1), 1)


def test_recall_with_norms_that_differ(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 24)) * rng.lognormal(0, 0.5, size=(3000, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, v array<double>").repartition(4)
    found = neighbours.search(df, "id", "v", lambda i: i % 30 == 0, 10).collect()
    _check(found, _exact(rows, lambda i: i % 30 == 0, 10), 0.9)


@pytest.mark.parametrize("lengths", ["one 100 times as long", "lognormal(1)"])
@pytest.mark.parametrize("whole", [0, neighbours.WHOLE])
def test_recall_with_skewed_norms(spark, monkeypatch, lengths, whole):
    monkeypatch.setattr(neighbours, "WHOLE", whole)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(4000, 64))
    if lengths == "lognormal(1)":
        x *= rng.lognormal(0, 1, size=(4000, 1))
    else:
        x[1234] *= 100
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, v array<double>").repartition(4)
    found = neighbours.search(df, "id", "v", lambda i: i % 40 == 0, 20).collect()
    _check(found, _exact(rows, lambda i: i % 40 == 0, 20), 0.9)


def test_overfull_buckets_and_many_queries_are_split(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL", 20)
    monkeypatch.setattr(neighbours, "QUERIES", 5)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1, 8)) + 0.01 * rng.normal(size=(300, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, v array<double>").repartition(4)
    _check(neighbours.search(df, "id", "v", lambda i: i % 3 == 0, 5).collect(), _exact(rows, lambda i: i % 3 == 0, 5), 0.95)


AWKWARD = (
    [(i, [1.0, 2.0, 0.0, 0.5]) for i in range(40)]  # one vector that most rows hold
    + [(100 + i, [float(i), 1.0, -1.0, 0.0]) for i in range(6)]
    + [(200, [0.0, 0.0, 0.0, 0.0]), (201, None), (202, [1.0, None, 0.0, 0.0]), (203, [math.nan, 1.0, 0.0, 0.0]), (204, [math.inf, 1.0, 0.0, 0.0])]
    + [(205, [1.0, 2.0]), (206, []), (None, [1.0, 2.0, 0.0, 0.5]), (104, [4.0, 1.0, -1.0, 0.0]), (104, [0.0, 0.0, 9.0, 9.0]), (300, [-0.0, 0.0, -2.0, 0.0]), (302, [0.0, 0.0, -2.0, 0.0])]
)


def test_awkward_rows(spark):
    df = spark.createDataFrame(AWKWARD, "vec_id long, embedding array<double>").repartition(3)
    df = df.withColumns({c: F.lit("x") for c in ("entry", "vector", "query", "bucket", "cell", "norm", "score", "rank", "id")})
    found = neighbours.search(df, "vec_id", "embedding", lambda i: i % 2 == 0, 8, probed=1.0).collect()
    _check(found, _exact(AWKWARD, lambda i: i % 2 == 0, 8))
    assert [r.id for r in sorted(found, key=lambda r: r.rank) if r.query_id == 2][:8] != []


@pytest.mark.parametrize("n", [21, 41])
@pytest.mark.parametrize("whole", [0, neighbours.WHOLE])
def test_small_tables_are_answered_in_full(spark, monkeypatch, n, whole):
    """With the registered parameters; where small tables are hashed too, the lists are full all the same."""
    monkeypatch.setattr(neighbours, "WHOLE", whole)
    rows = [(i, v.tolist()) for i, v in enumerate(np.random.default_rng(n).normal(size=(n, 64)))]
    df = spark.createDataFrame(rows, "id long, v array<double>").repartition(2)
    found = neighbours.search(df, "id", "v", lambda i: i % 20 == 0, 20).collect()
    assert len(found) == len(range(0, n, 20)) * min(20, n - 1)
    _check(found, _exact(rows, lambda i: i % 20 == 0, 20), 1.0 if whole or n <= 21 else 0.0)


def test_awkward_rows_with_the_registered_parameters(spark):
    df = spark.createDataFrame(AWKWARD, "id long, v array<double>").repartition(3)
    found = neighbours.search(df, "id", "v", lambda i: i % 2 == 0, 20).collect()
    _check(found, _exact(AWKWARD, lambda i: i % 2 == 0, 20))


def test_ties_at_the_cut_go_to_the_smaller_id(spark):
    """The query and 60 distinct vectors that tie with each other, far more than are asked for."""
    rows = [(i, [1.0, *(float(n) for n in np.eye(64)[i])]) for i in range(61)]
    df = spark.createDataFrame(rows, "id long, v array<double>").repartition(4)
    found = neighbours.search(df, "id", "v", lambda i: i % 30 == 0, 20, probed=1.0).collect()
    for q in (0, 30, 60):
        mine = [(r.id, r.score) for r in sorted(found, key=lambda r: r.rank) if r.query_id == q]
        assert mine == [(i, 1.0) for i in range(61) if i != q][:20]


def test_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 1.0])], "id long, v array<float>")
    found = neighbours.search(df, "id", "v", lambda i: i == 0, 20, probed=1.0).collect()
    assert [(r.rank, r.id, r.score) for r in sorted(found, key=lambda r: r.rank)] == [(1, 1, 0.5), (2, 2, 0.0)]
    assert neighbours.search(df.where("false"), "id", "v", lambda i: i == 0, 20).collect() == []
    assert neighbours.search(df, "id", "v", lambda i: i == 9, 20).collect() == []


@pytest.mark.parametrize("folder", [DATA, DATA.replace("0.001", "0.1")])
def test_query(spark, folder):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    found = queries.QUERIES["op1_nearest_neighbours"](spark, folder).withColumnRenamed("vec_id", "id").collect()
    _check(found, _exact(rows, lambda i: i % 20 == 0, 20), 0.9)
    assert len(found) == 20 * sum(i % 20 == 0 for i, _ in rows)
