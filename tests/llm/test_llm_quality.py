from __future__ import annotations

import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import prose
from ordergrain.llm import quality
from ordergrain.llm.catalog import good_labels

FOLDER = "/root/testdata/sf0.01"


def corpus(seed, number):
    """Good texts, texts of repeated words, texts with symbols and texts with a bad word."""
    chosen = random.Random(seed)
    for k in range(number):
        text, kind = prose(5000 + seed * 1000 + k, chosen.randrange(20, 200)), k % 6
        if kind == 3:
            text = " ".join(w + chosen.choice(["%%%", "***"]) for w in text.split())
        elif kind == 4:
            text = " ".join(" ".join([w] * 20) for w in text.split()[:10])
        elif kind == 5:
            words = text.split()
            words[len(words) // 2] = "nasty"
            text = " ".join(words)
        yield k, text, int(kind < 3)


def test_held_out_accuracy(spark, documents):
    rows = list(corpus(1, 900))
    docs = documents([(k, t) for k, t, _ in rows])
    labels = spark.createDataFrame([(k, good) for k, _, good in rows if k // 6 % 2], "doc_id long, good int")
    found = {r.doc_id: r.kept for r in quality.classify(docs, labels).collect()}
    unseen = [(found[k], good) for k, _, good in rows if k // 6 % 2 == 0]
    assert np.mean([kept == bool(good) for kept, good in unseen]) > 0.97
    accepted = {r.doc_id for r in quality.accepted(docs, labels).collect()}
    assert accepted == {k for k, kept in found.items() if kept}


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data")
def test_test_data(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = quality.classify(docs, good_labels(spark, FOLDER)).join(good_labels(spark, FOLDER), "doc_id")
    share = {r.good: r.kept for r in found.groupBy("good").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1] > 0.97 and share[0] < 0.25


def test_sites_are_shrunk(spark):
    """A bad host with many documents gets a low posterior, one with a single document hardly any shift."""
    rows = [("good", "p", 3.0)] * 300 + [("bad", "p", -2.0)] * 300 + [("sparse", "p", -2.0)] + [("good", "q", 3.0), (None, None, 3.0)]
    judged = spark.createDataFrame(rows, "host string, path string, evidence double")
    sites = quality.Sites(judged)
    found = {(r.host, r.path): r for r in quality.judge(judged, sites).collect()}
    assert len(found) == 5
    assert found["bad", "p"].host_posterior < 0.2 < 0.8 < found["good", "p"].host_posterior
    own = 1 / (1 + np.exp(2.0))
    assert own < found["sparse", "p"].host_posterior < sites.mean
    assert found["bad", "p"].posterior < found["sparse", "p"].posterior
    assert found[None, None].kept


def test_awkward_rows(spark, documents, awkward):
    labels = spark.createDataFrame(
        [(1, 1), (4, 0), (5, 1), (5, 0), (None, 1), (99, 0), (6, None), (7, 0), (8, 1)], "doc_id long, good int"
    )
    docs = documents(awkward)
    assert quality.classify(docs, labels).count() == len(awkward)
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns and kept.count() <= len(awkward)
    none = spark.createDataFrame([], "doc_id long, good int")
    assert quality.accepted(docs, none).count() == len(awkward)
    assert quality.classify(documents([]), labels).collect() == []
    assert quality.accepted(documents([]), none).collect() == []


def test_posteriors_equal_brute_force(spark):
    """All formulas of the sites, written out again in plain Python, on uneven random sites."""
    chosen = random.Random(5)
    rows = []
    for k in range(600):
        host = chosen.choice(["a", "a", "a", "b", "c", f"h{chosen.randrange(8)}", None])
        shift = {"a": 1.0, "b": -2.0}.get(host, 0.0)
        path = chosen.choice(["p", "q", None])
        rows.append((k, host, path, shift + {"p": 3.0, "q": -3.0}.get(path, 0.0) + chosen.gauss(0.5, 1.0)))
    judged = spark.createDataFrame(rows, "id long, host string, path string, evidence double")
    found = {r.id: r for r in quality.judge(judged, quality.Sites(judged)).collect()}

    chance = {k: 1 / (1 + np.exp(-e)) for k, _, _, e in rows}
    hosts, paths = {}, {}
    for k, host, path, _ in rows:
        hosts.setdefault(host, []).append(chance[k])
        paths.setdefault((host, path), []).append(chance[k])
    mean = np.mean(list(chance.values()))

    def strength(spread, noise):
        return float(np.clip(mean * (1 - mean) / (spread - noise) - 1, 1, 1e6)) if spread > noise else 1e6

    weight = strength(
        np.mean([(np.mean(p) - mean) ** 2 for p in hosts.values()]), np.mean([mean * (1 - mean) / len(p) for p in hosts.values()])
    )
    of_host = {h: (sum(p) + weight * mean) / (len(p) + weight) for h, p in hosts.items()}
    weight = strength(
        np.mean([(np.mean(p) - of_host[h]) ** 2 for (h, _), p in paths.items()]),
        np.mean([of_host[h] * (1 - of_host[h]) / len(p) for (h, _), p in paths.items()]),
    )
    assert 1 < weight < 1e6
    for k, host, path, evidence in rows:
        others = list(paths[host, path])
        others.remove(chance[k])
        own = (sum(others) + weight * of_host[host]) / (len(others) + weight)
        odds = evidence + np.log(own / (1 - own)) - np.log(mean / (1 - mean))
        got = found[k]
        assert got.host_posterior == pytest.approx(of_host[host]) and got.path_posterior == pytest.approx(own)
        assert got.posterior == pytest.approx(1 / (1 + np.exp(-odds))) and got.kept == (got.posterior >= 0.5)
