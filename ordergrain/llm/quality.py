"""Quality classifier with hierarchical empirical Bayes over hosts and paths.

Evidence. A document's features are its words (letters only, lower case) and, with the power of two
nearest to their share, the shapes of its words (``Aa***``, ``A!!``), words that repeat the one
before, and the commonest word; all hashed into ``BUCKETS`` buckets. The labelled documents give for
every bucket the number of good and of bad documents that have it, by one grouped aggregation;
buckets whose counts differ significantly get the log ratio as weight. A word counts only
against a document: else long texts would gather credit by their common words. A fifth of the labelled documents is kept out of this to turn the sum of the weights into a
probability (logistic regression on one number, from a histogram).

Sites. The mean probability of a host's documents is shrunk towards the global mean, that of a
path towards its host's, by prior weights estimated from how much the means differ beyond
chance (method of moments). A document's log-odds are its own plus the difference between its
path's posterior, without the document itself, and the global mean. Sparse sites thus decide
nothing, and large bad sites count against their doubtful documents.

What reaches the driver is bounded: at most ``BUCKETS`` weights, ``BINS`` histogram bins and
seven numbers about the sites. The site tables stay distributed.

Defined results: null and empty texts have no features and are judged by the prior and their
site; null hosts and paths are sites like others; labels that are null, or of unknown ids, or
contradict each other are not used; repeated rows count each; without labels of both kinds nothing
is rejected; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordergrain.llm.storage import settled, stored
from ordergrain.llm.textbytes import releasing

BUCKETS = 1 << 18
LEAST_DOCUMENTS, LEAST_CHI_SQUARE = 5, 15.0
BINS, BIN_WIDTH = 1024, 0.25
LEAST_WORDS = 10
CACHED_WORDS = 200_000
THRESHOLD = 0.5
_LETTERS = re.compile(r"[^\W\d_]+")
_REPEATS = re.compile(r"([Aa0])\1+")


def _bucket(name: str, word: bool = False) -> int:
    """Words have the lower half of the buckets, other features the upper half."""
    return zlib.crc32(name.encode("utf-8", "replace")) % (BUCKETS // 2) + (0 if word else BUCKETS // 2)


class _Classes(dict):
    """For ``str.translate``: letters become A or a, digits 0, other characters stay."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        self[code] = found = ("A" if char.isupper() else "a") if char.isalpha() else "0" if char.isdecimal() else char
        return found


_CLASSES = _Classes()


class Featurizer:
    """Feature buckets of texts; what a word contributes is remembered for the most recent words."""

    def __init__(self) -> None:
        self._known: dict[str, tuple[tuple[int, ...], str]] = {}

    def _word(self, word: str) -> tuple[tuple[int, ...], str]:
        parts = tuple(_bucket(x.lower(), word=True) for x in _LETTERS.findall(word))
        if len(self._known) >= CACHED_WORDS:
            self._known.clear()
        self._known[word] = found = parts, _REPEATS.sub(r"\1", word[:40].translate(_CLASSES))
        return found

    def __call__(self, text: str | None) -> list[int]:
        sequence = (text or "").split()
        words, total = Counter(sequence), len(sequence)
        buckets, shapes, known = set(), {}, self._known.get
        for word, times in words.items():
            parts, shape = known(word) or self._word(word)
            buckets.update(parts)
            shapes[shape] = shapes.get(shape, 0) + times
        shares = [("shape:" + shape, times) for shape, times in shapes.items()]
        if total >= LEAST_WORDS:
            shares.append(("repeated", sum(map(eq, sequence, islice(sequence, 1, None)))))
            shares.append(("commonest", max(words.values())))
        for name, times in shares:
            if times and (share := round(math.log2(total / times))) <= 6:
                buckets.add(_bucket(f"{share}:{name}"))
        return sorted(buckets)


def features(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with the text replaced by ``features``, its sorted buckets."""
    fields = [f for f in docs.schema.fields if f.name not in (text, "features")]

    @releasing
    def run(batches):
        featurize = Featurizer()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = pa.array([featurize(x) for x in part.column(text).to_pylist()], pa.list_(pa.int32()))
                names = [f.name for f in fields]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), found], [*names, "features"])

    schema = T.StructType([*fields, T.StructField("features", T.ArrayType(T.IntegerType()))])
    return docs.select(*(f"`{f.name}`" for f in fields), f"`{text}`").mapInArrow(run, schema)


class Model:
    """Weights of the buckets, and slope and intercept that turn their sum into log-odds."""

    def __init__(self, weights: np.ndarray, slope: float, intercept: float) -> None:
        self.weights, self.slope, self.intercept = weights, slope, intercept

    def log_odds(self, lists: pa.Array) -> np.ndarray:
        counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        sums = np.concatenate([[0.0], np.cumsum(self.weights[lists.flatten().to_numpy()])])
        ends = np.concatenate([[0], np.cumsum(counts)])
        return self.intercept + self.slope * (sums[ends[1:]] - sums[ends[:-1]])


def _evidence(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` with ``features`` replaced by ``evidence``, the document's own log-odds of being good."""
    fields = [f for f in rows.schema.fields if f.name != "features"]

    @releasing
    def run(batches):
        for batch in batches:
            names = [f.name for f in fields]
            found = pa.array(model.log_odds(batch.column("features")))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), found], [*names, "evidence"])

    return rows.mapInArrow(run, T.StructType([*fields, T.StructField("evidence", T.DoubleType())]))


def _logistic(x: np.ndarray, good: np.ndarray, bad: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic regression with a slight ridge, by Newton steps."""
    slope, intercept = 0.1, 0.0
    design = np.stack([x, np.ones(len(x))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * x + intercept, -30, 30)))
        total = good + bad
        gradient = design @ (good - total * p) - 1e-3 * np.array([slope, intercept])
        hessian = (design * (total * p * (1 - p))) @ design.T + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        slope, intercept = slope + step[0], intercept + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(slope), float(intercept)


def train(featured: DataFrame, labels: DataFrame, key: str) -> Model:
    """The model of the labelled documents; ``labels`` has the key and ``good`` (1, 0 or null)."""
    clear = labels.where(f"`{key}` IS NOT NULL").groupBy(F.col(key).alias("id")).agg(F.min("good").alias("good"), F.max("good").alias("most"))
    clear = clear.where("good = most").select("id", "good")
    # A merge join at every size: few labels today must not make the plan another one.
    known = featured.select(F.col(f"`{key}`").alias("id"), "features").join(clear.hint("merge"), "id")
    known = stored(known.withColumn("kept_out", F.pmod(F.xxhash64("id"), F.lit(5)) == 0))
    fit, rest = known.where("NOT kept_out"), known.where("kept_out")
    totals = {r["good"]: r["count"] for r in fit.groupBy("good").count().collect()}
    good, bad = totals.get(1, 0), totals.get(0, 0)
    if not good or not bad:
        return Model(np.zeros(BUCKETS), 0.0, 0.0)
    counts = fit.select("good", F.explode("features").alias("bucket")).groupBy("bucket").agg(
        F.sum("good").alias("a"), F.sum(1 - F.col("good")).alias("b")
    )
    all_ = good + bad
    off = F.col("a") * F.lit(float(bad)) - F.col("b") * F.lit(float(good))
    with_, without = F.col("a") + F.col("b"), F.lit(float(all_)) - F.col("a") - F.col("b")
    chi_square = off * off * F.lit(float(all_)) / (with_ * F.greatest(without, F.lit(1.0)) * F.lit(float(good) * bad))
    told = counts.where((with_ >= LEAST_DOCUMENTS) & (chi_square >= LEAST_CHI_SQUARE)).toPandas()
    weights = np.zeros(BUCKETS)
    a, b = told["a"].to_numpy(float), told["b"].to_numpy(float)
    weights[told["bucket"].to_numpy(int)] = np.log((a + 0.5) / (good + 1)) - np.log((b + 0.5) / (bad + 1))
    weights[: BUCKETS // 2] = np.minimum(weights[: BUCKETS // 2], 0.0)
    binned = F.greatest(F.lit(-BINS // 2), F.least(F.lit(BINS // 2), F.round(F.col("evidence") / BIN_WIDTH).cast("int")))
    histogram = _evidence(rest.select("good", "features"), Model(weights, 1.0, 0.0)).groupBy(binned.alias("bin")).agg(
        F.sum("good").alias("a"), F.sum(1 - F.col("good")).alias("b")
    ).toPandas()
    if not len(histogram) or not histogram["a"].sum() or not histogram["b"].sum():
        return Model(weights, 1.0, math.log(good / bad))
    return Model(weights, *_logistic(histogram["bin"].to_numpy(float) * BIN_WIDTH, histogram["a"].to_numpy(float), histogram["b"].to_numpy(float)))


def _strength(mean: float, spread: float | None, noise: float | None) -> float:
    """Prior weight in documents: large where the means differ no more than by chance."""
    beyond = max((spread or 0.0) - (noise or 0.0), 0.0)
    return float(np.clip(mean * (1 - mean) / beyond - 1, 1.0, 1e6)) if beyond > 0 else 1e6


class Sites:
    """Shrunk posteriors of hosts and paths, as tables, and the global mean."""

    def __init__(self, judged: DataFrame) -> None:
        p = _probability(F.col("evidence"))
        paths = stored(judged.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(p).alias("s"), F.sum(p * (1 - p)).alias("v")))
        hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"), F.sum("v").alias("hv"))
        first = hosts.agg(F.sum("hs"), F.sum("hn")).first()
        self.mean = float(np.clip((first[0] or 0.0) / (first[1] or 1), 1e-6, 1 - 1e-6)) if first[1] else 0.5
        own = F.col("hs") / F.col("hn")
        within = self.mean * (1 - self.mean) / F.col("hn")
        by_host = hosts.agg(F.avg((own - self.mean) * (own - self.mean)), F.avg(within)).first()
        self.host_weight = _strength(self.mean, *by_host)
        hosts = hosts.select(F.col("host").alias("_host"), ((F.col("hs") + self.host_weight * self.mean) / (F.col("hn") + self.host_weight)).alias("host_posterior"))
        joined = paths.join(hosts, F.col("host").eqNullSafe(F.col("_host"))).select("host", "path", "n", "s", "host_posterior")
        own, prior = F.col("s") / F.col("n"), F.col("host_posterior")
        by_path = joined.agg(F.avg((own - prior) * (own - prior)), F.avg(prior * (1 - prior) / F.col("n"))).first()
        self.path_weight = _strength(self.mean, *by_path)
        self.table = stored(joined)


def _probability(log_odds: Column) -> Column:
    return 1 / (1 + F.exp(-log_odds))


def judge(judged: DataFrame, sites: Sites, threshold: float = THRESHOLD) -> DataFrame:
    """Rows with host, path and evidence, plus host_posterior, path_posterior, posterior and kept."""
    table = sites.table.select(F.col("host").alias("_host"), F.col("path").alias("_path"), "n", "s", "host_posterior")
    both = judged.join(table, F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path")), "left")
    others = F.greatest(F.col("s") - _probability(F.col("evidence")), F.lit(0.0)) + sites.path_weight * F.col("host_posterior")
    path = others / (F.col("n") - 1 + sites.path_weight)
    odds = F.log(F.col("path_posterior") / (1 - F.col("path_posterior"))) - math.log(sites.mean / (1 - sites.mean))
    return (
        both.withColumn("path_posterior", F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), path)))
        .withColumn("posterior", _probability(F.col("evidence") + odds))
        .withColumn("kept", F.col("posterior") >= threshold)
        .drop("_host", "_path", "n", "s")
    )


def classify(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", path: str = "lang"
) -> DataFrame:
    """Per document: key, evidence, host_posterior, path_posterior, posterior, kept.

    ``labels`` has the key and ``good``: 1, 0 or null.
    """
    judged, sites, _ = _fitted(docs, labels, key, text, host, path)
    return judge(judged, sites).select(F.col("id").alias(key), "evidence", "host_posterior", "path_posterior", "posterior", "kept")


def _fitted(docs, labels, key, text, host, path):
    named = docs.select(
        F.col(f"`{key}`").alias("id"), F.col(f"`{host}`").alias("host"), F.col(f"`{path}`").alias("path"), F.col(f"`{text}`").alias("text")
    )
    featured = stored(features(named, "text"))
    model = train(featured, labels.withColumnRenamed(key, "id"), "id")
    judged = stored(_evidence(featured, model))
    return judged, Sites(judged), model


def accepted(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", path: str = "lang"
) -> DataFrame:
    """The documents that are not rejected, with their columns.

    Evidence is computed again from the texts on the way, so that texts are not moved; only the
    site table is joined.
    """
    sites = model = None

    def fitted() -> DataFrame:
        nonlocal sites, model
        _, sites, model = _fitted(docs, labels, key, text, host, path)
        return sites.table

    table = settled(docs.sparkSession, fitted)
    sites.table = table
    fields = docs.schema.fields
    place = f"c{[f.name for f in fields].index(text)}"
    named = docs.select(*(F.col(f"`{f.name}`").alias(f"c{k}") for k, f in enumerate(fields)), F.col(f"`{host}`").alias("host"), F.col(f"`{path}`").alias("path"))

    @releasing
    def run(batches):
        featurize = Featurizer()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = pa.array([featurize(x) for x in part.column(place).to_pylist()], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(model.log_odds(found))], [*part.schema.names, "evidence"])

    judged = judge(named.mapInArrow(run, T.StructType([*named.schema.fields, T.StructField("evidence", T.DoubleType())])), sites)
    return judged.where("kept").select(*(F.col(f"c{k}").alias(f.name) for k, f in enumerate(fields)))
