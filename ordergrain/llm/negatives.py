"""Hard negatives by exact integer matrix products in a residue number system.

Vectors are scaled to whole numbers and their scores (inner products) are needed exactly. Their components are
reduced modulo several primes below 1024 to residues around zero, so that a product of 64 components stays
below 2^24 and float32 holds it exactly. One float32 matrix product per prime gives the scores modulo
that prime; Chinese remaindering (mixed radix, whole numbers only) puts the signed scores together. The
largest squared norm, a bound of every score, tells how many primes are needed.

The anchors are a stated part of the rows. Anchors and rows are dealt by hash into blocks; each pair of
an anchor block and a row block is one group of a co-grouped task, so nothing is broadcast and no
task holds more than ``ANCHORS`` anchors and ``COMPONENTS`` components of rows, about. A group
leaves the best few rows of each anchor; windows over all groups select from these. The first pass finds the
positives, the second the negatives of each.

Defined results: rows with a null id, label or vector, or any null or non-finite component take no part; rows
equal in id, label and scaled vector are one; other rows that share an id are rows of their own, ordered by a hash;
missing components of a shorter vector count as zero, and so does an empty vector; ties go to the smaller id;
other columns are left out; an empty table, or one without anchors, gives an empty table. Scores that could
reach 2^56 raise an error.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordergrain.llm.storage import stored
from ordergrain.llm.textbytes import releasing

SCALE, POSITIVES, NEGATIVES = 256, 5, 5
LOW, HIGH = 80, 100  # a negative's score in percent of the positive's
ANCHORS, COMPONENTS, SLAB = 1024, 1 << 20, 64
LARGEST_PRIME, EXACT = 1024, 1 << 24
_LIMIT = float(1 << 56)


def primes_for(bound: int) -> list[int]:
    """Primes below ``LARGEST_PRIME``, the largest first, whose product is over twice ``bound``."""
    sieve = np.ones(LARGEST_PRIME, dtype=bool)
    sieve[:3] = False
    for k in range(2, math.isqrt(LARGEST_PRIME) + 1):
        sieve[k * k :: k] = False
    found = []
    for prime in np.flatnonzero(sieve)[::-1].tolist():
        found.append(prime)
        if math.prod(found) > 2 * bound + 1:
            return found
    raise ValueError("No set of small primes covers the scores")


def residues(numbers: np.ndarray, prime: int) -> np.ndarray:
    """``numbers`` modulo ``prime``, as float32 between -prime / 2 and prime / 2."""
    rest = numbers % prime
    return np.where(rest > prime // 2, rest - prime, rest).astype(np.float32)


def product_modulo(left: np.ndarray, right: np.ndarray, prime: int) -> np.ndarray:
    """``left @ right.T`` modulo ``prime`` for residues, in float32 blocks that are exact."""
    step = EXACT // (prime // 2) ** 2
    total = np.zeros((len(left), len(right)), dtype=np.int64)
    for at in range(0, left.shape[1], step):
        total += (left[:, at : at + step] @ right[:, at : at + step].T).astype(np.int64)
    return total % prime


def remaindered(parts: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """The signed numbers whose remainders are ``parts``: mixed-radix digits, the highest one first added."""
    digits = []
    for k, prime in enumerate(primes):
        value, radix = np.zeros_like(parts[k]), 1
        for digit, before in zip(digits, primes):
            value = (value + digit * radix) % prime
            radix = radix * before % prime
        digits.append((parts[k] - value) * pow(radix, -1, prime) % prime)
    # The upper half of the range stands for negative numbers: one product less, from the highest digit on.
    half, whole = [], math.prod(primes) // 2
    for prime in primes:
        half.append(whole % prime)
        whole //= prime
    above, equal = np.zeros(parts[0].shape, dtype=bool), np.ones(parts[0].shape, dtype=bool)
    for digit, middle in zip(digits[::-1], half[::-1]):
        above |= equal & (digit > middle)
        equal &= digit == middle
    number = digits[-1] - np.where(above, primes[-1], 0)
    for digit, prime in zip(digits[-2::-1], primes[-2::-1]):
        number = number * prime + digit
    return number


class Scores:
    """Exact inner products of anchors with the rows of a block."""

    def __init__(self, anchors: np.ndarray, rows: np.ndarray, primes: list[int]) -> None:
        self.primes = primes
        self.anchors = [residues(anchors, p) for p in primes]
        self.rows = [residues(rows, p) for p in primes]

    def of(self, low: int, high: int) -> np.ndarray:
        parts = [product_modulo(a[low:high], b, p) for a, b, p in zip(self.anchors, self.rows, self.primes)]
        return remaindered(parts, self.primes)


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Whole-number vectors as rows of ``width``, filled up with zeros."""
    column = column.combine_chunks()
    lengths = pc.list_value_length(column).to_numpy()
    found = np.zeros((len(column), width), dtype=np.int64)
    found[np.repeat(np.arange(len(column)), lengths), np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = (
        column.flatten().to_numpy()
    )
    return found


def best_first(scores: np.ndarray, among: np.ndarray, number: int) -> np.ndarray:
    """The places of the ``number`` highest scores among the given places; the first of equal ones."""
    held = scores[among]
    if len(held) > number:
        least = np.partition(held, len(held) - number)[len(held) - number]
        among, held = among[held >= least], held[held >= least]
    return among[np.argsort(-held, kind="stable")[:number]]


def _labels(*tables: pa.Table) -> list[np.ndarray]:
    """The labels of the tables as numbers that are equal where the labels are."""
    column = pa.chunked_array([c for t in tables for c in t.column("label").chunks], tables[0].schema.field("label").type)
    codes = column.combine_chunks().dictionary_encode().indices.to_numpy()
    return np.split(codes, np.cumsum([t.num_rows for t in tables])[:-1])


def _ordered(rows: pa.Table) -> pa.Table:
    return rows.sort_by([("id", "ascending"), ("row", "ascending")])


def hard_negatives(
    rows: DataFrame,
    anchor: Column,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    scale: int = SCALE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows where ``anchor`` holds.

    The positives of an anchor are the best rows of its label; the negatives of a positive the best rows of
    other labels with ``LOW`` to ``HIGH`` percent of its score.
    """
    whole = f"transform(`{vector}`, x -> double(floor({scale} * double(x))))"
    usable = f"`{id}` IS NOT NULL AND `{label}` IS NOT NULL AND forall(`{vector}`, x -> x IS NOT NULL AND abs(x) < double('infinity'))"
    numbers = rows.where(usable).select(
        F.col(f"`{id}`").alias("id"), F.col(f"`{label}`").alias("label"), F.expr(whole).alias("vec"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    )
    numbers = stored(numbers.select("*", F.xxhash64("id", "label", "vec").alias("row")).distinct())
    squares = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
    facts = numbers.agg(
        F.coalesce(F.max(squares), F.lit(0.0)).alias("bound"),
        F.coalesce(F.max(F.size("vec")), F.lit(0)).alias("width"),
        F.count("*").alias("rows"),
        F.count_if("anchor").alias("anchors"),
    ).first()
    if not facts.bound < _LIMIT:
        raise ValueError(f"Scores can reach {facts.bound:g}, which is too large for exact comparison")
    width, primes = max(1, facts.width), primes_for(math.ceil(facts.bound * (1 + 1e-9)))
    numbers = numbers.withColumn("vec", F.col("vec").cast("array<long>"))
    bands, stripes = facts.anchors // ANCHORS + 1, facts.rows * width // COMPONENTS + 1
    dealt = lambda seed, number: F.pmod(F.xxhash64("id", "row", F.lit(seed)), F.lit(number)).cast("int")
    every = lambda number: F.explode(F.sequence(F.lit(0), F.lit(number - 1)))
    block = numbers.select("id", "row", "label", "vec", dealt(1, stripes).alias("stripe"), every(bands).alias("band"))
    asked = numbers.where("anchor").select("id", "row", "label", "vec", dealt(2, bands).alias("band"))
    spread = lambda df: df.select("*", every(stripes).alias("stripe"))

    @releasing
    def like(anchors: pa.Table, block: pa.Table) -> pa.Table:
        out = []
        if anchors.num_rows and block.num_rows:
            block = _ordered(block)
            own, far = _labels(anchors, block)
            ids, marks = (block.column(c).to_numpy() for c in ("id", "row"))
            names, hashes = (anchors.column(c).to_numpy() for c in ("id", "row"))
            scores = Scores(matrix(anchors.column("vec"), width), matrix(block.column("vec"), width), primes)
            for low in range(0, len(own), SLAB):
                for i, found in enumerate(scores.of(low, low + SLAB), low):
                    among = np.flatnonzero((far == own[i]) & ~((ids == names[i]) & (marks == hashes[i])))
                    best = best_first(found, among, positives)
                    out.append((np.full(len(best), i), best, found[best]))
        i, best, found = (np.concatenate(x).astype(np.int64) for x in zip(*out)) if out else [np.zeros(0, np.int64)] * 3
        return pa.Table.from_arrays(
            [anchors.column("id").take(i), anchors.column("row").take(i), block.column("id").take(best), block.column("row").take(best), pa.array(found)],
            ["id", "row", "positive", "positive_row", "score"],
        )

    kind = numbers.schema["id"].dataType.simpleString()
    grid = ["band", "stripe"]
    near = spread(asked).groupBy(*grid).cogroup(block.groupBy(*grid))
    near = near.applyInArrow(like, f"id {kind}, row long, positive {kind}, positive_row long, score long")
    first = Window.partitionBy("id", "row").orderBy(F.desc("score"), "positive", "positive_row")
    chosen = near.withColumn("turn", F.row_number().over(first)).where(F.col("turn") <= positives)
    wanted = chosen.groupBy("id", "row").agg(F.collect_list(F.struct("score", "positive", "positive_row")).alias("positives"))
    anchors = stored(asked.join(wanted, ["id", "row"]))

    @releasing
    def unlike(anchors: pa.Table, block: pa.Table) -> pa.Table:
        out, sources = [], anchors.column("positives").combine_chunks()
        starts, flat = sources.offsets.to_numpy() if anchors.num_rows else [0], sources.flatten()
        if anchors.num_rows and block.num_rows:
            block = _ordered(block)
            own, far = _labels(anchors, block)
            limits = flat.field("score").to_numpy()
            starts = starts - starts[0]
            scores = Scores(matrix(anchors.column("vec"), width), matrix(block.column("vec"), width), primes)
            for low in range(0, len(own), SLAB):
                for i, found in enumerate(scores.of(low, low + SLAB), low):
                    most = limits[starts[i] : starts[i + 1]]
                    least = -((-LOW * most) // HIGH)  # rounded up
                    among = np.flatnonzero((far != own[i]) & (found >= least.min()) & (found <= most.max()))
                    among = among[np.argsort(-found[among], kind="stable")]
                    begin = np.searchsorted(-found[among], -most, "left")
                    for k, (at, bottom) in enumerate(zip(begin.tolist(), least.tolist()), starts[i]):
                        best = among[at : at + negatives]
                        best = best[found[best] >= bottom]
                        out.append((np.full(len(best), i), np.full(len(best), k), best, found[best]))
        i, k, best, found = (np.concatenate(x).astype(np.int64) for x in zip(*out)) if out else [np.zeros(0, np.int64)] * 4
        columns = [anchors.column("id").take(i), anchors.column("row").take(i)]
        columns += [flat.field(name).take(pa.array(k)) for name in ("positive", "positive_row", "score")]
        columns += [block.column("id").take(best), block.column("row").take(best), pa.array(found)]
        return pa.Table.from_arrays(columns, ["id", "row", "positive", "positive_row", "positive_score", "negative", "negative_row", "score"])

    hard = spread(anchors).groupBy(*grid).cogroup(block.groupBy(*grid)).applyInArrow(
        unlike, f"id {kind}, row long, positive {kind}, positive_row long, positive_score long, negative {kind}, negative_row long, score long"
    )
    first = Window.partitionBy("id", "row", "positive", "positive_row").orderBy(F.desc("score"), "negative", "negative_row")
    return hard.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives).select(
        F.col("id").alias("anchor_id"),
        F.col("positive").alias("positive_id"),
        "rank",
        F.col("negative").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
