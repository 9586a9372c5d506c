"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm import decontaminate, jaccard, licenses, neighbours, packing, periodic, prefix_trie, quality, rules, secret_scan, sharding, token_cache, warc
from ebbtide.llm.frames import table
from ebbtide.llm.sql import SQL  # noqa: F401
from ebbtide.session import working_folder

TOKENIZER = "byte_bpe_50k.json"
SEQUENCE = 1024
END = 2
SHARDS = 24


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    found = neighbours.search(vectors, "vec_id", "embedding", lambda key: key % 20 == 0, k=20)
    return found.withColumnRenamed("id", "vec_id")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_texts(docs, "text", ["doc_id"], public_tokenizers.path(TOKENIZER), SEQUENCE, END)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From an empty cache, so that every text is counted in this run."""
    docs, cache = table(spark, sf_dir, "documents"), working_folder(spark, "token-cache")
    counted = token_cache.count_tokens(docs, "text", public_tokenizers.path(TOKENIZER), cache, ["doc_id"])
    return counted.withColumn("over_limit", F.col("n_tokens") > SEQUENCE)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, written as archives and read back from them."""
    folder = working_folder(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), folder, "page_id", "url", "html")
    return warc.read(spark, folder, with_payload=False).select(
        F.col("key").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records are ordered by the digest of their text, so that equal texts lie side by side."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8
    placed = sharding.shard(docs, SHARDS, F.xxhash64(F.coalesce("text", F.lit(""))), size, [F.col("doc_id")])
    return placed.select(
        "doc_id",
        size.alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owners are the sources, and every document is a repository of its own."""
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.scan(docs, "text", owner="source", repository="doc_id", keep=["doc_id"])

    def counted(field: str, value: str) -> Column:
        return F.size(F.filter("spans", lambda s: s[field] == value)).cast("long")

    return found.select(
        "doc_id",
        *[counted("kind", kind).alias(f"n_{kind}") for kind in secret_scan.KINDS],
        F.sha2(secret_scan.listed(F.filter("spans", lambda s: s["kind"] != secret_scan.BARE)), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"),
        *[counted("label", label).alias(f"n_{label}") for label in ("live", "copied", "placeholder")],
    )


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts are the sources; a source's documents of one language are a path."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality.score(
        docs, "doc_id", "text", docs["source"], docs["lang"], {"doc_id": docs["doc_id"]}, labels, "doc_id", "quality"
    )
    return scored.withColumn("keep", F.col("quality") >= quality.KEEP)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: a directory per source, one in it per language."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat(F.lit("/"), "source", F.lit("/"), "lang", F.lit("/"), F.col("doc_id").cast("string"))
    return licenses.scan(docs, path, "text", ["doc_id"]).withColumn("cosine", F.round("cosine", 6))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document that holds a test item, with the item, the alignment's score and its words."""
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.find(docs, "text", ["doc_id"], benchmark)
    return found.select(F.col("keep_0").alias("doc_id"), "item_id", "score", "first_word", "end_word")


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = jaccard.join(table(spark, sf_dir, "documents"), "doc_id", "text")
    return joined.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def _made_periodic(docs: DataFrame, text: str, key: str) -> DataFrame:
    """``docs`` with every tenth text, by the key's checksum, continued from some word on by words of its own."""
    h = F.crc32(F.col(key).cast("string").cast("binary"))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    with_words = docs.withColumn("g", F.floor(h / 10)).withColumn("words", F.when(h % 10 == 0, words))
    n, g = F.size("words"), F.col("g")
    with_a = with_words.withColumn("a", g % F.nullif(n, F.lit(0)))
    with_p = with_a.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + g % 8)))
    source = lambda i: (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")
    made = F.transform("words", lambda w, i: F.when(i >= F.col("a"), F.get("words", source(i))).otherwise(w))
    return with_p.withColumn(text, F.when(n > 0, F.array_join(made, " ")).otherwise(F.col(text)))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every text, a tenth of them made periodic first, as digests and the run with the most turns."""
    docs = _made_periodic(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", "doc_id")
    found = periodic.find(docs, docs["text"], {"doc_id": docs["doc_id"]})
    run = "struct<start:long,length:long,period:long>"

    def better(best: Column, other: Column) -> Column:
        more = other["length"] * best["period"] > best["length"] * other["period"]
        return F.when(best.isNull() | more, other).otherwise(best)

    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.withColumn("best", F.aggregate("runs", F.lit(None).cast(run), better))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )


#: So many first turns at most are taken from another conversation.
GIVEN = 8


def _rebuilt(lists: DataFrame) -> DataFrame:
    """Conversations that begin with turns of the one whose id is the next lower multiple of five."""
    donors = lists.where("conv_id % 5 = 0").select(F.col("conv_id").alias("donor"), F.slice("turns", 1, GIVEN).alias("given"))
    joined = lists.withColumn("donor", F.col("conv_id") - F.col("conv_id") % 5).join(donors, "donor", "left")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (GIVEN + 1)).cast("int")
    given = F.slice(F.coalesce("given", F.slice("turns", 1, 0)), F.lit(1), h)
    return joined.select("conv_id", F.concat(given, F.slice("turns", h + 1, F.size("turns"))).alias("turns"))


def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    lists = prefix_trie.gathered(rows, rows["conv_id"], rows["turn"], rows["role"], rows["text"])
    return prefix_trie.trie(_rebuilt(lists))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts are the sources."""
    docs = table(spark, sf_dir, "documents")
    judged = rules.judge(docs, docs["text"], docs["source"], {"doc_id": docs["doc_id"]})
    return judged.select(
        "doc_id",
        *[m for m in rules.MEASURES if m != "n_lines"],
        F.col("failed")[rules.BASE].alias("base_failed"),
        "kept",
        "host_rejected",
        "reason",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_nearest_neighbours": op1_nearest_neighbours,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_token_counts": op3_token_counts,
    "op4_warc": op4_warc,
    "op5_sharding": op5_sharding,
    "op6_secret_scan": op6_secret_scan,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_license_scan": op8_license_scan,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_conversation_prefix_trie": op12_conversation_prefix_trie,
    "op13_quality_rules": op13_quality_rules,
}
