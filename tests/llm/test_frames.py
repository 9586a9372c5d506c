"""What the operators share: batches on their way to Python."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ebbtide.llm.frames import BATCH, BATCH_BYTES, mapped


@pytest.fixture
def unset(spark):
    before = spark.conf.get(BATCH, None)
    spark.conf.unset(BATCH)
    yield spark
    spark.conf.unset(BATCH) if before is None else spark.conf.set(BATCH, before)


def _measured(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64()), pa.array([batch.nbytes], pa.int64())], ["n", "bytes"])


def test_batches_are_bounded_by_bytes_and_lose_no_rows(unset):
    texts = unset.range(0, 9000, 1, 1).select(F.repeat(F.lit("word "), 800).alias("text"))
    found = mapped(texts, _measured, "n long, bytes long").collect()
    assert sum(r["n"] for r in found) == 9000 and sum(r["bytes"] for r in found) >= 9000 * 4000
    assert max(r["bytes"] for r in found) <= 1.1 * BATCH_BYTES


def test_a_row_longer_than_a_batch_passes_whole(unset):
    texts = unset.range(0, 3, 1, 1).select(F.repeat(F.lit("x"), BATCH_BYTES + 5).alias("text"))
    found = mapped(texts, _measured, "n long, bytes long").collect()
    assert sum(r["n"] for r in found) == 3 and sum(r["bytes"] for r in found) >= 3 * (BATCH_BYTES + 5)


def test_a_bound_of_the_session_stays(unset):
    unset.conf.set(BATCH, "100000")
    found = mapped(unset.range(0, 900, 1, 1).select(F.repeat(F.lit("x"), 1000).alias("text")), _measured, "n long, bytes long").collect()
    assert unset.conf.get(BATCH) == "100000" and len(found) >= 9
