"""Quality rules judged by host: what a document fails, and whether its whole host is known for failing it.

Every whole text is measured once (words, their characters, symbols, repeated lines, words in repeated runs of three).
Rules are shares of these measures. Their failures are added up by host; each host's rate is shrunk towards that of
all documents by an empirical beta prior, fitted by the method of moments to how much hosts differ beyond chance, so
that a host with few documents is judged by the corpus and a large one by itself. The hosts' verdicts then go back
to the documents:

* a document that fails the base rule goes, whatever its host;
* every document of a host goes whose shrunk rate for the base rule is ``HOST_LIMIT`` or more;
* a document that fails one of the softer rules goes if its host's shrunk rate for that rule is ``RULE_LIMIT`` or more:
  a single odd document on a good host is given the benefit of the doubt, one of a host's many is not.

Defined results: a null text is empty; it has no words and fails the base rule, and no softer one. Null hosts are one
host. Repeated rows are measured and counted each. An empty table has no hosts and an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm import hashing
from ebbtide.llm.frames import mapped, sized, stored

RUN = 3
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 50
#: Of the words, so many percent may lie in repeated runs.
MOST_REPEATED = 50
#: Percent of a host's documents, shrunk, from which the host as a whole, or its documents that fail a softer rule, go.
HOST_LIMIT, RULE_LIMIT = 90, 30

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
BASE = "base"


def rules() -> dict[str, Column]:
    """Each rule by name, over the measures: true where a document fails it. The first is the base rule."""
    words, repeated = F.col("n_words"), F.col("n_repeat_words")
    return {
        BASE: (words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * words),
        "symbols": 10 * F.col("n_symbols") > words,
        "lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
        "short_words": F.col("word_chars") < 3 * words,
        "long_words": F.col("word_chars") > 12 * words,
    }


def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    """Which bytes begin a code point of a word, and which are symbols."""
    begins = np.ones(256, np.uint8)
    begins[128:192] = 0
    begins[[32, *range(9, 14)]] = 0
    symbols = np.zeros(256, np.uint8)
    symbols[list(SYMBOLS)] = 1
    return begins, symbols


def _totals(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The sum of ``table`` over each row's bytes."""
    out = np.zeros(len(offsets) - 1, np.int64)
    filled = np.flatnonzero(np.diff(offsets))
    if len(filled):
        used = data[offsets[filled[0]] : offsets[filled[-1] + 1]]
        out[filled] = np.add.reduceat(table[used], offsets[filled] - offsets[filled[0]], dtype=np.int64)
    return out


def _in_repeated_runs(words: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Per text, the words that lie in a run of ``RUN`` words found twice or more in it."""
    out = np.zeros(len(marks) - 1, np.int64)
    if len(words) < RUN:
        return out
    text = np.repeat(np.arange(len(marks) - 1), np.diff(marks))
    inside = np.flatnonzero(text[RUN - 1 :] == text[: -RUN + 1])
    # A run's digest together with its text's number: runs are compared within a text.
    own = hashing.mix(hashing.runs(words, RUN)[inside] ^ hashing.mix(text[inside].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(own)
    ranked = own[order]
    equal = ranked[1:] == ranked[:-1]
    twice = np.concatenate((equal, [False])) | np.concatenate(([False], equal))
    covered = np.zeros(len(words), bool)
    for shift in range(RUN):
        covered[inside[order[twice]] + shift] = True
    return np.bincount(text[covered], minlength=len(out)).astype(np.int64)


def _lines(text: bytes) -> tuple[int, int]:
    """Lines that hold a word, and how many of them equal an earlier one."""
    if b"\n" not in text:
        return int(bool(text) and not text.isspace()), 0
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return len(lines), len(lines) - len(set(lines))


def _measured(column: pa.Array) -> list[np.ndarray]:
    data, offsets = hashing.text_bytes(column)
    n_words, repeated = np.zeros(len(column), np.int64), np.zeros(len(column), np.int64)
    for row, words, marks in hashing.words_of(data, offsets, hashing.exact_words()):
        rows = slice(row, row + len(marks) - 1)
        n_words[rows] = np.diff(marks)
        repeated[rows] = _in_repeated_runs(words, marks)
    begins, symbols = _byte_tables()
    lines = [_lines(data[a:b].tobytes()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
    n_lines, doubled = np.array(lines, np.int64).reshape(-1, 2).T
    return [n_words, _totals(data, offsets, begins), _totals(data, offsets, symbols), n_lines, doubled, repeated]


def _measuring(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.num_columns - 1
        kept = batch.select(list(range(texts)))
        new = [pa.array(x, pa.int64()) for x in _measured(batch.column(texts))]
        yield pa.RecordBatch.from_arrays([*kept.columns, *new], [*kept.schema.names, *MEASURES])


def measured(docs: DataFrame, text: Column, host: Column, keep: dict[str, Column]) -> DataFrame:
    """One row per document: the columns ``keep`` (as ``keep_0`` ..), ``host``, the measures and ``failed``, a struct with
    a flag for each rule. Stored, without texts."""
    slim = docs.select(*[c.alias(f"keep_{i}") for i, c in enumerate(keep.values())], host.alias("host"), text.alias("text"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in slim.schema[:-1])
    found = mapped(slim, _measuring, f"{kinds}, " + ", ".join(f"{m} long" for m in MEASURES))
    return stored(found.withColumn("failed", F.struct(*[rule.alias(name) for name, rule in rules().items()])), "rule-measures")


def host_failures(found: DataFrame) -> DataFrame:
    """Documents and failures of each rule by host: one row per task and host crosses the network."""
    failures = [F.sum(F.col("failed")[name].cast("long")).alias(name) for name in rules()]
    return found.groupBy("host").agg(F.count("*").alias("n"), *failures)


def prior(hosts: DataFrame) -> dict[str, tuple[float, float]]:
    """The beta prior (alpha, beta) of each rule: its mean is the rate over all documents, its strength how little hosts
    differ in it beyond chance, between 1 and a million documents."""
    names = list(rules())
    totals = hosts.agg(F.sum("n").alias("n"), F.count("*").alias("hosts"), *[F.sum(name).alias(name) for name in names]).first()
    n = totals["n"] or 0
    means = {name: (totals[name] or 0) / n if n else 0.0 for name in names}
    between = hosts.agg(
        *[F.sum(F.col("n") * F.pow(F.col(name) / F.col("n") - F.lit(means[name]), 2)).alias(name) for name in names]
    ).first()
    out = {}
    for name in names:
        chance = means[name] * (1 - means[name])
        spread = max(((between[name] or 0.0) - totals["hosts"] * chance) / n, 1e-9) if n else 1e-9
        strength = min(max(chance / spread - 1, 1.0), 1e6)
        out[name] = (means[name] * strength, (1 - means[name]) * strength)
    return out


def verdicts(hosts: DataFrame) -> DataFrame:
    """The hosts with their shrunk rate of each rule in percent (``rate_...``)."""
    fitted = prior(hosts)
    rates = {f"rate_{k}": 100 * (F.col(k) + a) / (F.col("n") + (a + b)) for k, (a, b) in fitted.items()}
    return hosts.withColumns(rates)


def judge(docs: DataFrame, text: Column, host: Column, keep: dict[str, Column]) -> DataFrame:
    """One row per document: the columns ``keep``, the measures, ``failed``, ``host_rejected`` (the whole host goes),
    ``reason`` (the base rule, the host, or the softer rule that decided; null if the document stays) and ``kept``."""
    found = measured(docs, text, host, keep)
    judged = verdicts(stored(host_failures(found), "rule-hosts"))
    limits = {name: F.col(f"rate_{name}") >= (HOST_LIMIT if name == BASE else RULE_LIMIT) for name in rules()}
    known = judged.select(F.col("host").alias("known_host"), *[limit.alias(f"known_{name}") for name, limit in limits.items()])
    # Only hosts known for something are joined; most corpora have few, and their number is looked at first.
    any_known = F.greatest(*[F.col(f"known_{name}") for name in rules()])
    known = stored(known.where(any_known), "known-hosts")
    with_host = found.join(sized(known), F.col("host").eqNullSafe(F.col("known_host")), "left")
    softer = [
        F.when(F.col("failed")[name] & F.coalesce(f"known_{name}", F.lit(False)), name) for name in rules() if name != BASE
    ]
    rejected = F.coalesce(f"known_{BASE}", F.lit(False))
    reason = F.coalesce(F.when(F.col("failed")[BASE], BASE), F.when(rejected, "host"), *softer)
    return with_host.select(
        *[F.col(f"keep_{i}").alias(name) for i, name in enumerate(keep)],
        *MEASURES,
        "failed",
        rejected.alias("host_rejected"),
        reason.alias("reason"),
        reason.isNull().alias("kept"),
    )
