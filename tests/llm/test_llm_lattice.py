from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import CLASHING
from ordergrain.llm import lattice

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))])


def brute(rows, threshold=0.95):
    """Links and components of all valid vectors by all pairs."""
    valid = []
    for key, vector in rows:
        usable = key is not None and vector and all(x is not None and math.isfinite(x) for x in vector) and any(vector)
        if usable:
            valid.append((key, np.array(vector) / np.abs(vector).max()))
    links = {k: set() for k, _ in valid}
    for i, (a, x) in enumerate(valid):
        for b, y in valid[i + 1 :]:
            if a != b and len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= threshold:
                links[a].add(b)
                links[b].add(a)
    component = {}
    for start in sorted(links):
        if start not in component:
            stack = [start]
            while stack:
                k = stack.pop()
                if k not in component:
                    component[k] = start
                    stack += links[k]
    return {k: (len(v), component[k]) for k, v in links.items()}


def clusters(seed, copies, width=64, noise=0.02):
    random = np.random.default_rng(seed)
    rows = []
    for size in copies:
        centre = random.normal(size=width)
        rows += [centre + noise * random.normal(size=width) * np.linalg.norm(centre) / math.sqrt(width) for _ in range(size)]
    return [(k, x.tolist()) for k, x in enumerate(rows)]


def check(spark, rows, **options):
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in CLASHING})
    found = lattice.similar_vectors(docs, **options).collect()
    assert len(found) == len(rows)
    expected = brute(rows)
    for r in found:
        links, component = expected.get(r.vec_id, (0, r.vec_id))
        assert (r.n_links, r.component_id) == (links, component), r.vec_id
        assert r.kept == (r.vec_id == component)
    return found


def test_nearest_points_of_the_lattice():
    random = np.random.default_rng(1)
    points = random.normal(size=(500, 8)) * 3
    found = lattice.nearest_lattice_points(points)
    doubled = 2 * found
    assert (np.abs(doubled - np.rint(doubled)) < 1e-12).all()
    parity = np.rint(doubled).astype(int) % 2
    assert (parity == parity[:, :1]).all() and (np.rint(found.sum(axis=1)) % 2 == 0).all()
    distance = ((points - found) ** 2).sum(axis=1)
    for step in lattice.NEIGHBOURS:
        assert (distance <= ((points - found - step) ** 2).sum(axis=1) + 1e-9).all()
    assert (distance <= 1 + 1e-9).all()  # the covering radius
    assert len(lattice.NEIGHBOURS) == 240 and np.allclose((lattice.NEIGHBOURS**2).sum(axis=1), 2)


def test_clusters(spark):
    check(spark, clusters(3, [1] * 200 + [2] * 40 + [5] * 10 + [40], noise=0.2))


def test_large_group_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(lattice, "CHUNK", 16)
    monkeypatch.setattr(lattice, "GROUP_ROWS", 64)
    check(spark, clusters(4, [150, 60, 3, 1, 1], noise=0.21))


@pytest.mark.parametrize("width", [8, 16, 32, 64])
def test_recall_at_the_threshold(spark, width):
    random = np.random.default_rng(5)
    rows = []
    for k in range(400):
        x, z = random.normal(size=(2, width))
        x /= np.linalg.norm(x)
        z -= (z @ x) * x
        z /= np.linalg.norm(z)
        rows += [(2 * k, x.tolist()), (2 * k + 1, (0.951 * x + math.sqrt(1 - 0.951**2) * z).tolist())]
    found = lattice.similar_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sum(r.n_links > 0 for r in found) >= 0.999 * 800


def test_awkward_vectors(spark):
    one, other = [1.0] + [0.0] * 63, [0.0] * 63 + [2.0]
    rows = [
        (1, one), (2, one), (2, one), (3, [5.0] + [0.0] * 63), (4, None), (5, []), (6, [0.0] * 64), (7, [None] + one[1:]),
        (8, [math.nan] + one[1:]), (9, [math.inf] + one[1:]), (None, one), (None, None), (10, [1.0, 0.0]), (11, [1.0, 0.0]),
        (12, [3.0]), (13, [1e-300] + [0.0] * 63), (14, other), (15, [1e300] * 64), (16, [1.0] * 64),
    ]
    check(spark, rows)


def test_float_vectors_and_empty_table(spark):
    rows = clusters(6, [3, 1])
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("embedding", F.col("embedding").cast("array<float>"))
    assert sorted(r.n_links for r in lattice.similar_vectors(docs).collect()) == [0, 2, 2, 2]
    assert lattice.similar_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
