"""Token counts through a digest cache.

A text's normalised content is the text itself, with null as the empty text: the tokenizers here
tell every other difference apart. Its SHA-256 and the digest of the tokenizer's file are the key of
a stored count. Documents are joined to the cache by digest; only distinct contents that it does not
hold are encoded, once each, and appended.

Defined results: null and empty texts have 0 bytes and 0 tokens. Repeated rows each get their row. An
empty table gives an empty result and leaves the cache as it is. A run that fails midway appends
nothing; two runs at once may append the same count twice, and reading takes one of them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm import tokens
from ebbtide.llm.frames import mapped, named

CACHE = "digest binary, n_tokens long, tokenizer string"


def cached(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """The stored counts of one tokenizer version, one row per digest."""
    try:
        rows = spark.read.schema(CACHE).parquet(cache)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], CACHE)
    return rows.where(F.col("tokenizer") == version).groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def _counter(path: str):
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(path)
        for batch in batches:
            texts, digests = batch.column("content"), batch.column("digest")
            counts = [len(encoder.ids(text.as_py())) for text in texts]
            yield pa.RecordBatch.from_arrays([digests.cast(pa.binary()), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    return count


def count_tokens(docs: DataFrame, text: str, tokenizer: str, cache: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of every document with ``n_bytes`` and ``n_tokens``, by way of the cache folder."""
    spark, version = docs.sparkSession, tokens.version(tokenizer)
    content = F.coalesce(named(docs, text), F.lit(""))
    digest = F.unhex(F.sha2(content, 256))
    texts = docs.select(digest.alias("digest"), content.alias("content"))
    # One shuffle of the texts, after copies within a task are combined; the cache comes to them by digest.
    misses = texts.dropDuplicates(["digest"]).join(cached(spark, cache, version), "digest", "left_anti")
    counted = mapped(misses, _counter(tokenizer), "digest binary, n_tokens long")
    counted.withColumn("tokenizer", F.lit(version)).write.mode("append").partitionBy("tokenizer").parquet(cache)
    rows = docs.select(
        *[named(docs, c).alias(f"keep_{i}") for i, c in enumerate(keep)],
        F.octet_length(content).cast("long").alias("n_bytes"),
        digest.alias("digest"),
    )
    return rows.join(cached(spark, cache, version), "digest").select(
        *[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)], "n_bytes", "n_tokens"
    )
