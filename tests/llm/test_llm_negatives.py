from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordergrain.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows, every=10, positives=5, count=5):
    """By whole numbers of any size, one pair at a time; ids differ."""
    usable = [
        (i, label, [math.floor(256 * float(np.float32(x))) for x in vec])
        for i, vec, label in rows
        if None not in (i, vec, label) and None not in vec and all(math.isfinite(np.float32(x)) for x in vec)
    ]
    out = []
    for a, label, left in usable:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(left, right)), i, other == label) for i, other, right in usable if i != a)
        for minus, p, _ in [s for s in scored if s[2]][:positives]:
            fit = [(i, -s) for s, i, same in scored if not same and 80 * -minus <= 100 * -s <= 100 * -minus]
            out += [(a, p, rank, i, -minus, s) for rank, (i, s) in enumerate(fit[:count], 1)]
    return out


def check(spark, rows, **options):
    df = spark.createDataFrame([(*r, 0, "clash") for r in rows], SCHEMA + ", rank int, row string")
    found = negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, **options)
    assert found.columns == COLUMNS
    expected = plain(rows, count=options.get("negatives", 5), positives=options.get("positives", 5))
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    return expected


def vectors(seed, number, width, labels=4, spread=1.0):
    random_ = np.random.default_rng(seed)
    centre = random_.normal(size=width)
    made = centre + spread * random_.normal(size=(number, width))
    return [(k, made[k].tolist(), int(random_.integers(labels))) for k in range(number)]


def test_residue_products_are_exact():
    random_ = np.random.default_rng(1)
    for width, size in ((1, 10**6), (3, 2**26), (64, 300), (200, 90_000)):
        left, right = random_.integers(-size, size + 1, (7, width)), random_.integers(-size, size + 1, (9, width))
        left[0], right[0], right[1] = size, size, -size  # the largest scores of either sign
        bound = width * size * size
        got = negatives.Scores(left, right, negatives.primes_for(bound)).of(0, 7)
        assert np.array_equal(got.astype(object), left.astype(object) @ right.T.astype(object))


@pytest.mark.parametrize("bound", [0, 1, 10**5, 2**56])
def test_primes_cover_the_bound(bound):
    primes = negatives.primes_for(bound)
    assert math.prod(primes) > 2 * bound and all(all(p % d for d in range(2, p)) for p in primes)


@pytest.mark.parametrize("width", [1, 2, 16, 70])
def test_against_all_pairs(spark, width):
    assert check(spark, vectors(width, 160, width, spread=0.4))


def test_other_numbers_of_positives_and_negatives(spark):
    check(spark, vectors(5, 90, 8, spread=0.3), positives=2, negatives=9)


def test_many_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ANCHORS", 3)
    monkeypatch.setattr(negatives, "COMPONENTS", 160)
    monkeypatch.setattr(negatives, "SLAB", 2)
    assert check(spark, vectors(7, 120, 16, spread=0.4))


def test_ties_and_hot_groups(spark):
    same = [0.5, 0.25, -0.125]
    rows = [(k, same, k % 3 if k % 4 else 0) for k in range(150)] + vectors(8, 40, 3, 3)[1:]
    check(spark, list({r[0]: r for r in rows}.values()))


def test_negative_and_zero_scores(spark):
    random.seed(2)
    rows = [(k, [random.choice((-1.0, 0.0, 1.0)), random.choice((-0.5, 0.0))], k % 2) for k in range(60)]
    check(spark, rows)


def test_awkward_rows(spark):
    rows = [
        *vectors(9, 40, 4, 2, spread=0.3), (None, [1.0, 1.0, 1.0, 1.0], 1), (50, None, 1), (60, [1.0, None, 1.0, 1.0], 0),
        (70, [math.nan, 1.0, 1.0, 1.0], 0), (80, [math.inf, 0.0, 0.0, 0.0], 1), (90, [1.0, 1.0, 1.0, 1.0], None),
        (100, [0.0, 0.0, 0.0, 0.0], 1), (110, [1.0, 1.0], 0), (111, [], 1), (120, [], 0),
    ]
    check(spark, rows)


def test_repeated_rows_are_one(spark):
    rows = vectors(11, 50, 4, 2, spread=0.3)
    twice = spark.createDataFrame(rows + rows, SCHEMA)
    found = negatives.hard_negatives(twice, F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, found.collect())) == sorted(plain(rows))


def test_rows_that_share_an_id_are_rows_of_their_own(spark):
    # 11 is in reach of one of the two rows of anchor 10 only, with the other one as its positive.
    for far, reached in ((0.9, (10, 10, 1, 11, 32768, 29440)), (0.45, (10, 10, 1, 11, 32768, 29440)), (2.0, None)):
        rows = [(10, [1.0, 0.0], 0), (10, [0.5, 0.5], 0), (11, [far, 0.0], 1)]
        found = negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0).collect()
        assert [tuple(r) for r in found] == ([reached] if reached else [])


def test_text_labels_and_ids(spark):
    df = spark.createDataFrame([("a", [1.0], "x"), ("b", [1.0], "x"), ("c", [0.9], "y")], "vec_id string, embedding array<double>, label string")
    found = negatives.hard_negatives(df, F.col("vec_id") == "a").collect()
    assert [tuple(r) for r in found] == [("a", "b", 1, "c", 65536, 58880)]


def test_no_rows_or_no_anchors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert negatives.hard_negatives(empty, F.lit(True)).collect() == []
    assert negatives.hard_negatives(spark.createDataFrame([(1, [1.0], 0), (2, [1.0], 0)], SCHEMA), F.col("vec_id") > 5).collect() == []


def test_scores_beyond_the_range_raise(spark):
    df = spark.createDataFrame([(0, [1e9], 0)], SCHEMA)
    with pytest.raises(ValueError, match="too large"):
        negatives.hard_negatives(df, F.lit(True))
