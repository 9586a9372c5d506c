import zlib

import pytest
from pyspark.sql import functions as F

from ebbtide.llm import queries, sharding
from tests.conftest import DATA
from tests.llm.cases import CLASHING, TEXTS


def _laws(rows, shards, largest):
    """Slots are gapless in each shard, and sizes are equal but for a row."""
    by = {}
    for shard, slot, size in rows:
        by.setdefault(shard, []).append((slot, size))
    for parts in by.values():
        assert sorted(s for s, _ in parts) == list(range(len(parts)))
    assert set(by) <= set(range(shards))
    sums = [sum(size for _, size in by.get(s, [])) for s in range(shards)]
    assert max(sums) - min(sums) <= 2 * largest


def test_query(spark):
    found = queries.QUERIES["op5_sharding"](spark, DATA).collect()
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    expected = sorted((k, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for k, t in texts)
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in found) == expected
    assert {(r.law, r.grown_shard) for r in found} == {("bytes", None)}
    _laws([(r.shard, r.slot, r.size) for r in found], 24, max(e[1] for e in expected))


def _sharded(df, shards, key="text"):
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8
    return sharding.shard(df, shards, F.xxhash64(key), size, [F.col("doc_id")])


def test_awkward_rows_keep_all_columns(messy):
    found = _sharded(messy, 4)
    assert found.columns == [*messy.columns, "shard", "slot"]
    got = found.collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(TEXTS, key=repr)
    assert {tuple(r[c] for c in CLASHING) for r in got} == {tuple(r[c] for c in CLASHING) for r in messy.collect()}
    sizes = [len((t or "").encode()) + 8 for _, t in TEXTS]
    _laws([(r.shard, r.slot, len((r.text or "").encode()) + 8) for r in got], 4, max(sizes))


def test_null_keys_and_sizes(spark):
    df = spark.range(300).selectExpr("id AS doc_id", "IF(id % 3 = 0, NULL, CAST(id AS STRING)) AS text")
    found = sharding.shard(df, 5, F.col("text").cast("long"), F.when(F.col("doc_id") % 2 == 0, 10), [F.col("doc_id")]).collect()
    _laws([(r.shard, r.slot, 10 * (r.doc_id % 2 == 0)) for r in found], 5, 10)


@pytest.mark.parametrize("size", ["0L", "CAST(NULL AS BIGINT)"])
def test_rows_without_any_size(spark, size):
    df = spark.range(0, 403, 1, 4).selectExpr("id AS doc_id", "CAST(id % 50 AS STRING) AS text", f"{size} AS bytes")
    found = sharding.shard(df, 24, F.xxhash64("text"), F.col("bytes"), [F.col("doc_id")]).collect()
    assert len(found) == 403 and {r.shard for r in found} == set(range(24))
    _laws([(r.shard, r.slot, 1) for r in found], 24, 1)


def test_splitters_cut_by_size(spark):
    keys = spark.range(20_000).selectExpr("id AS key", "IF(id < 1000, 100L, 5L) AS size", "id AS tie")
    total = 1000 * 100 + 19_000 * 5
    bounds = sharding.splitters(keys, 16, total)
    assert bounds == sorted(set(bounds)) and 12 <= len(bounds) <= 15
    sums = [0] * (len(bounds) + 1)
    for r in keys.collect():
        sums[sum(b <= r.key for b in bounds)] += r["size"]
    assert max(sums) <= 1.6 * total / 16


@pytest.mark.parametrize("distinct", [1, 3])
def test_hot_keys_are_divided(spark, distinct):
    """A third or all of the rows have one key: shards are equal all the same, and no window holds them all."""
    df = spark.range(6000).selectExpr("id AS doc_id", f"IF(id % {distinct} = 0, 'hot', CAST(id AS STRING)) AS text")
    placed = _sharded(df, 8)
    got = placed.collect()
    _laws([(r.shard, r.slot, len(r.text) + 8) for r in got], 8, 12)
    hot = {r.shard for r in got if r.text == "hot"}
    assert len(hot) >= (8 if distinct == 1 else 2)


def test_same_rows_same_places(spark, messy):
    first, second = (sorted((r.doc_id or 0, r.text or "", r.shard) for r in _sharded(df, 4).collect()) for df in (messy, messy.repartition(7)))
    assert first == second


def test_empty(empty):
    found = _sharded(empty, 4)
    assert found.columns[-2:] == ["shard", "slot"] and found.collect() == []


def test_native(messy):
    plan = _sharded(messy, 4)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
