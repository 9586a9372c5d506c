"""From raw documents to packed training sequences: five stages, each on all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next one's documents; a lost executor repeats tasks of one stage at most. All but the last
return the columns of ``documents``. An empty table passes through every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm import decontaminate, jaccard, packing, quality, queries, secret_scan
from ebbtide.llm.frames import stored, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier and their site's record reject go."""
    return quality.accepted(docs, "doc_id", "text", "source", ["lang"], table(spark, sf_dir, "labels"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies stays: the one with the smallest id."""
    return jaccard.distinct_documents(docs, "doc_id", "text")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item, as it is or edited, go."""
    return decontaminate.clean(docs, "text", table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking credentials are masked; every document stays. ``n_chars`` follows the new text."""
    clean = secret_scan.redact(docs, "text", owner="source", repository="doc_id")
    masked = F.col("text").contains(secret_scan.MASK)
    return clean.withColumn("n_chars", F.when(masked, F.length("text").cast("long")).otherwise(F.col("n_chars")))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their places in the training sequences."""
    tokenizer = public_tokenizers.path(queries.TOKENIZER)
    return packing.pack_texts(docs, "text", ["doc_id"], tokenizer, queries.SEQUENCE, queries.END)


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]

#: No stage but the secret scan can be said in SQL; ``tests/llm/test_pipeline.py`` has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
