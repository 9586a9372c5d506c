"""Quality of documents: a classifier's evidence, combined with what is known of the site by empirical Bayes.

The classifier is a logistic regression on hashed pairs of neighbouring bytes over the whole text. It is fitted
on a bounded sample of labelled documents (``TRAIN_ROWS``, those with the smallest hashes of their ids).
It scores every document; its evidence is the log-odds beyond the share of good documents among the labels.

Sites are levels of one hierarchy: all documents, a host, a path on the host. Each level's share of good
documents is a Beta-binomial posterior whose prior is the level above: sparse sites are shrunk towards it, by a
strength that the method of moments takes from how much sites differ beyond chance. A document's own score
is left out of its path's, its host's and the corpus's share before they are combined with it, so that no evidence counts twice:
the only document of a host is judged by the others of the corpus.

Defined results: null and empty texts, and those of one byte, give no evidence and are judged by their site. Null hosts are
one host, null paths one path of their host. Documents without labels are scored all the same. Repeated labels of
an id count once, by their mean (half or more is good); null labels not at all. With labels of one kind
only, or none, the classifier gives no evidence. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm import hashing
from ebbtide.llm.frames import fresh, mapped, named, sized, stored

#: Hashed byte pairs; one more feature each says how many words repeat one of the last 1, 2, 4 or 8.
PAIRS, BEHIND = 1024, (1, 2, 4, 8)
FEATURES = PAIRS + len(BEHIND)
#: Shares are of the text's pairs and this many more, so that a few words give little evidence.
SMOOTH = 100
TRAIN_ROWS = 8000
KEEP = 0.5
#: A site's share stays this far from 0 and 1, so that no site outvotes every text.
LEAST_SHARE = 0.02
PART = 1 << 20


def features(text: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Roots of the shares of hashed byte pairs, and shares of words that repeat."""
    out = np.zeros(FEATURES)
    for begin in range(0, max(len(text) - 1, 0), PART):
        part = text[begin : begin + PART + 1].astype(np.uint32)
        pairs = (part[:-1] * 256 + part[1:]) * np.uint32(2654435761)
        out[:PAIRS] += np.bincount(pairs >> np.uint32(22), minlength=PAIRS)
    out[:PAIRS] = np.sqrt(out[:PAIRS] / (len(text) + SMOOTH))
    again = np.zeros(len(words), bool)
    for back in range(1, BEHIND[-1] + 1):
        again[back:] |= words[back:] == words[:-back]
        if back in BEHIND:
            out[PAIRS + BEHIND.index(back)] = again.sum() / (len(words) + SMOOTH / 5)
    return out


def _each(column: pa.Array) -> Iterator[np.ndarray | None]:
    """The features of every text; None without a pair of bytes."""
    data, offsets = hashing.text_bytes(column)
    row = 0
    for _, words, marks in hashing.words_of(data, offsets, hashing.spaced_words()):
        for a, b in zip(marks[:-1].tolist(), marks[1:].tolist(), strict=True):
            text = data[offsets[row] : offsets[row + 1]]
            yield features(text, words[a:b]) if len(text) > 1 else None
            row += 1


def _vectors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(np.zeros(FEATURES) if x is None else x).tolist() for x in _each(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("label"), pa.array(rows, pa.list_(pa.float64()))], ["label", "features"]
        )


def fit(docs: DataFrame, id_: str, text: str, labels: DataFrame, label_id: str, label: str, rows: int = TRAIN_ROWS):
    """(weights, intercept, share of good labels) from at most ``rows`` labelled documents."""
    good = labels.where(named(labels, label).isNotNull() & named(labels, label_id).isNotNull()).groupBy(named(labels, label_id).alias("id"))
    good = good.agg((F.avg(named(labels, label)) >= 0.5).cast("double").alias("label"))
    sample = stored(good.orderBy(F.xxhash64("id"), "id").limit(rows), "label-sample")
    texts = docs.select(named(docs, id_).alias("id"), named(docs, text).alias("text"))
    # At most `rows` small rows go to every task.
    labelled = texts.join(F.broadcast(sample), "id").dropDuplicates(["id"]).select("label", "text")
    vectors = stored(mapped(labelled, _vectors, "label double, features array<double>"), "train-vectors")
    seen = vectors.agg(F.count("*").alias("n"), F.sum("label").alias("good")).first()
    if not seen["n"] or seen["good"] in (0, seen["n"]):
        return np.zeros(FEATURES), 0.0, 0.5
    learner = LogisticRegression(maxIter=60, regParam=1e-4, standardization=False)
    model = learner.fit(vectors.select("label", array_to_vector("features").alias("features")))
    return model.coefficients.toArray(), float(model.intercept), seen["good"] / seen["n"]


def _evidence(weights: np.ndarray, offset: float):
    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.num_columns - 1
            known = weights.any()
            sizes = np.diff(hashing.text_bytes(batch.column(texts))[1])
            # A few bytes are little evidence, for or against.
            rows = [
                0.0 if x is None or not known else float(x @ weights + offset) * size / (size + SMOOTH)
                for x, size in zip(_each(batch.column(texts)), sizes.tolist(), strict=True)
            ]
            kept = batch.select(list(range(texts)))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(rows, pa.float64())], [*kept.schema.names, "evidence"])

    return score


def _log_odds(share: Column) -> Column:
    share = F.greatest(F.least(share, F.lit(1 - LEAST_SHARE)), F.lit(LEAST_SHARE))
    return F.log(share / (1 - share))


def _strength(groups: DataFrame, mean: str) -> float:
    """Prior strength from groups (``n``, ``good`` and the ``mean`` of the level above): how little they differ beyond chance."""
    chance = F.col(mean) * (1 - F.col(mean))
    sums = groups.agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - F.col(mean), 2)).alias("between"),
        F.sum(chance).alias("expected"),
        F.sum(F.col("n") * chance).alias("within"),
    ).first()
    if not sums["n"]:
        return 1.0
    spread = max((sums["between"] - sums["expected"]) / sums["n"], 1e-9)
    return float(min(max(sums["within"] / sums["n"] / spread - 1, 1.0), 1e6))


def score(
    docs: DataFrame, id_: str, text: str, host: Column, path: Column, keep: dict[str, Column], labels: DataFrame,
    label_id: str, label: str, rows: int = TRAIN_ROWS,
) -> DataFrame:
    """The columns ``keep`` of every document with ``evidence``, ``site`` (its path's share without it) and ``quality``."""
    weights, intercept, prior = fit(docs, id_, text, labels, label_id, label, rows)
    offset = intercept - float(np.log(prior / (1 - prior)))
    texts = docs.select(
        *[c.alias(f"keep_{i}") for i, c in enumerate(keep.values())], host.alias("host"), path.alias("path"), named(docs, text).alias("text")
    )
    kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in texts.schema[:-1])
    scored = stored(mapped(texts, _evidence(weights, offset), f"{kinds}evidence double"), "evidence")
    start = float(np.log(prior / (1 - prior)))
    chance = 1 / (1 + F.exp(-(F.col("evidence") + start)))
    scored = scored.withColumn("chance", chance)
    # Grouped aggregation: paths from documents, hosts from paths, all from hosts. Each combines before it shuffles.
    paths = stored(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("chance").alias("good")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    top = hosts.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    mean = top["good"] / top["n"] if top["n"] else prior
    hosts = hosts.withColumn("mean", F.lit(mean))
    strong = _strength(hosts, "mean")
    host_share = (F.col("good") + strong * mean) / (F.col("n") + strong)
    hosts = hosts.select(F.col("host").alias("of"), host_share.alias("host_share"), F.col("n").alias("host_n"), F.col("good").alias("host_good"))
    paths = paths.join(hosts, F.col("host").eqNullSafe(F.col("of"))).drop("of")
    strength = _strength(paths, "host_share")
    sites = stored(
        paths.select(F.col("host").alias("site_host"), F.col("path").alias("site_path"), "n", "good", "host_n", "host_good"), "sites"
    )
    joined = scored.join(
        sites, F.col("host").eqNullSafe(F.col("site_host")) & F.col("path").eqNullSafe(F.col("site_path"))
    )
    # Each level without the document itself.
    of_all = (F.lit(top["good"]) - F.col("chance")) / (top["n"] - 1) if (top["n"] or 0) > 1 else F.lit(prior)
    of_host = (F.col("host_good") - F.col("chance") + strong * of_all) / (F.col("host_n") - 1 + strong)
    of_path = (F.col("good") - F.col("chance") + strength * of_host) / (F.col("n") - 1 + strength)
    joined = joined.withColumn("site", of_path)
    quality = 1 / (1 + F.exp(-(F.col("evidence") + _log_odds(F.col("site")))))
    return joined.select(
        *[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)], "evidence", "site", quality.alias("quality")
    )


def accepted(
    docs: DataFrame, id_: str, text: str, host: str, path: list[str], labels: DataFrame, label_id: str = "doc_id",
    label: str = "quality", least: float = KEEP,
) -> DataFrame:
    """``docs`` without the rows of a quality under ``least``; all columns stay."""
    key = fresh(docs.columns, "_key")
    columns = [named(docs, c).cast("string") for c in path]
    site = F.concat_ws("/", *[F.coalesce(c, F.lit("")) for c in columns])
    digest = F.xxhash64(F.coalesce(named(docs, text), F.lit("")), named(docs, host), site)
    scored = score(docs, id_, text, named(docs, host), site, {"key": digest}, labels, label_id, label)
    gone = stored(scored.where(F.col("quality") < least).select(F.col("key").alias(key)).distinct(), "rejected")
    return docs.withColumn(key, digest).join(sized(gone), key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
