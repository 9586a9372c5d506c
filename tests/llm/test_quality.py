import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import quality, queries
from tests.conftest import DATA
from tests.llm.cases import TEXTS, rows

LARGER = DATA.replace("0.001", "0.1")


def _odds(p):
    p = min(max(p, quality.LEAST_SHARE), 1 - quality.LEAST_SHARE)
    return math.log(p / (1 - p))


def _strength(groups):
    """From (n, good, mean of the level above), the formula of the docstring in plain sums."""
    n = sum(g[0] for g in groups)
    between = sum(g[0] * (g[1] / g[0] - g[2]) ** 2 for g in groups)
    spread = max((between - sum(g[2] * (1 - g[2]) for g in groups)) / n, 1e-9)
    return min(max(sum(g[0] * g[2] * (1 - g[2]) for g in groups) / n / spread - 1, 1.0), 1e6)


def _site(path, host, whole, own, s, k):
    """A document's site from (n, good) of its path, its host and all documents, each without the document."""
    of_all = (whole[1] - own) / (whole[0] - 1)
    of_host = (host[1] - own + k * of_all) / (host[0] - 1 + k)
    return (path[1] - own + s * of_host) / (path[0] - 1 + s)


def test_sites_are_shrunk_towards_the_level_above(spark, monkeypatch):
    """Evidence is given here; the posterior is that of plain sums."""
    evidence = {"good": 3.0, "bad": -3.0, "": 0.0}
    data = [("a", "x", "good")] * 40 + [("a", "y", "bad")] * 30 + [("a", "y", "good")] * 2 + [("b", "x", "bad")] * 25 + [("c", None, "bad")] + [(None, None, "")] * 2
    docs = spark.createDataFrame([(i, *d) for i, d in enumerate(data)], "doc_id long, host string, path string, text string")
    monkeypatch.setattr(quality, "fit", lambda *a: (np.ones(quality.FEATURES), 0.0, 0.5))
    monkeypatch.setattr(quality, "_evidence", lambda *a: None)
    told = F.create_map(*[F.lit(x) for pair in evidence.items() for x in pair])
    monkeypatch.setattr(quality, "mapped", lambda df, *_: df.withColumn("evidence", told[F.col("text")]).drop("text"))
    found = quality.score(docs, "doc_id", "text", docs["host"], docs["path"], {"doc_id": docs["doc_id"]}, docs, "doc_id", "doc_id")
    chance = {t: 1 / (1 + math.exp(-e)) for t, e in evidence.items()}
    paths, hosts = {}, {}
    for host, path, text in data:
        for table, key in ((paths, (host, path)), (hosts, host)):
            n, good = table.get(key, (0, 0.0))
            table[key] = (n + 1, good + chance[text])
    mean = sum(g for _, g in hosts.values()) / len(data)
    k = _strength([(*v, mean) for v in hosts.values()])
    share = {h: (g + k * mean) / (n + k) for h, (n, g) in hosts.items()}
    s = _strength([(*v, share[h]) for (h, _), v in paths.items()])
    got = {r.doc_id: r for r in found.collect()}
    for i, (host, path, text) in enumerate(data):
        site = _site(paths[host, path], hosts[host], (len(data), mean * len(data)), chance[text], s, k)
        assert got[i].site == pytest.approx(site, rel=1e-9)
        assert got[i].quality == pytest.approx(1 / (1 + math.exp(-(evidence[text] + _odds(site)))), rel=1e-9)


@pytest.mark.parametrize("size", [1, 2, 3])
def test_a_document_does_not_speak_for_itself(spark, monkeypatch, size):
    """On a host of one, two or three documents the site is the same whatever the document's own score."""
    told = {"good": 3.0, "bad": -3.0}
    monkeypatch.setattr(quality, "fit", lambda *a: (np.ones(quality.FEATURES), 0.0, 0.5))
    monkeypatch.setattr(quality, "_evidence", lambda *a: None)
    monkeypatch.setattr(quality, "_strength", lambda *a: 5.0)
    scores = F.create_map(*[F.lit(x) for pair in told.items() for x in pair])
    monkeypatch.setattr(quality, "mapped", lambda df, *_: df.withColumn("evidence", scores[F.col("text")]).drop("text"))
    sites = []
    for own in told:
        data = [("small", "p", own)] + [("small", "p", "good")] * (size - 1) + [("big", "p", "good")] * 20 + [("big", "q", "bad")] * 20
        docs = spark.createDataFrame([(i, *d) for i, d in enumerate(data)], "doc_id long, host string, path string, text string")
        found = quality.score(docs, "doc_id", "text", docs["host"], docs["path"], {"doc_id": docs["doc_id"]}, docs, "doc_id", "doc_id")
        sites.append(next(r.site for r in found.collect() if r.doc_id == 0))
    assert sites[0] == pytest.approx(sites[1], rel=1e-12)


def test_held_out_documents(spark):
    """Labels of half the documents train it, the other half judges it."""
    docs, labels = (spark.read.parquet(f"{LARGER}/{t}.parquet") for t in ("documents", "labels"))
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)) == 0
    scored = quality.score(docs, "doc_id", "text", docs["source"], docs["lang"], {"doc_id": docs["doc_id"]}, labels.where(half), "doc_id", "quality")
    judged = scored.join(labels.where(~half), "doc_id").groupBy(labels["quality"]).agg(
        F.avg((scored["quality"] >= quality.KEEP).cast("double")).alias("kept"), F.count("*").alias("n")
    )
    kept = {r["quality"]: (r["kept"], r["n"]) for r in judged.collect()}
    assert kept[1][0] > 0.98 and kept[0][0] < 0.08 and kept[0][1] > 200


def test_the_sample_is_bounded_and_labels_may_be_awkward(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", "quality")
    odd = labels.unionByName(labels).unionByName(spark.sql("SELECT NULL AS doc_id, 1 AS quality UNION ALL SELECT 5L, NULL UNION ALL SELECT 10000000L, 1"))
    whole = quality.fit(docs, "doc_id", "text", odd, "doc_id", "quality")
    assert np.allclose(whole[0], quality.fit(docs, "doc_id", "text", labels, "doc_id", "quality")[0], atol=1e-6)
    few = quality.fit(docs, "doc_id", "text", labels, "doc_id", "quality", rows=20)
    assert few[2] in {i / 20 for i in range(21)}
    one_kind = quality.fit(docs, "doc_id", "text", labels.where("quality = 1"), "doc_id", "quality")
    assert not one_kind[0].any()


def test_awkward_rows(spark, messy, empty):
    labels = spark.createDataFrame([(1, 1), (2, 1), (8, 0), (10, 1), (None, 1)], "doc_id long, quality int")
    keep = {"doc_id": messy["doc_id"], "host": messy["host"]}
    scored = quality.score(messy, "doc_id", "text", messy["source"], messy["lang"], keep, labels, "doc_id", "quality")
    got = scored.collect()
    assert sorted([r.doc_id for r in got], key=repr) == sorted([k for k, _ in TEXTS], key=repr)
    assert all(0 < r.quality < 1 for r in got)
    assert all(r.evidence == 0 for r in got if r.doc_id in (3, 4))
    kept = quality.accepted(messy, "doc_id", "text", "source", ["lang"], labels)
    assert kept.columns == messy.columns
    assert rows(quality.accepted(messy, "doc_id", "text", "source", ["lang"], labels.where("false"))) == rows(messy)
    assert quality.accepted(empty, "doc_id", "text", "source", ["lang"], labels).collect() == []


def test_query(spark):
    found = queries.QUERIES["op7_quality_classifier"](spark, DATA).collect()
    assert sorted(r.doc_id for r in found) == sorted(r.doc_id for r in spark.read.parquet(f"{DATA}/documents.parquet").collect())
    assert all(r.keep == (r.quality >= 0.5) for r in found) and {r.keep for r in found} == {True, False}
