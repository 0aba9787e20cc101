"""Connected components of link tables, by large-star and small-star rounds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordergrain.session import materialize


def local_roots(number: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest index reachable by the given links, for each of ``number`` items."""
    roots = np.arange(number)
    while True:
        low = np.minimum(roots[left], roots[right])
        new = roots.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, roots[left], low)
        np.minimum.at(new, roots[right], low)
        new = new[new]
        if np.array_equal(new, roots):
            return roots
        roots = new


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every higher end has one link and is nobody's lower end."""
    marks = edges.select(F.col("hi").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        edges.select(F.col("lo").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    sums = marks.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return sums.where("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``id`` and ``component``, the smallest id reachable, for every id that is not its own component.

    Each round reduces the links of a node to links with its smallest neighbour; all steps are
    aggregates and joins by node, and a round's links are written to the shared folder.
    """
    edges = (
        links.select(F.greatest(left, right).alias("hi"), F.least(left, right).alias("lo")).where("hi > lo").distinct()
    )
    edges = materialize(edges)
    while not _is_forest_of_stars(edges):
        both = edges.unionAll(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy(F.col("hi").alias("node")).agg(F.least(F.min("lo"), F.col("node")).alias("least"))
        large = (
            edges.select(F.col("lo").alias("node"), F.col("hi").alias("far"))
            .join(least, "node")
            .select(F.col("far").alias("hi"), F.col("least").alias("lo"))
            .unionAll(least.where("least < node").select(F.col("node").alias("hi"), F.col("least").alias("lo")))
            .where("hi > lo")
            .distinct()
        )
        lowest = large.groupBy("hi").agg(F.min("lo").alias("least"))
        small = (
            large.join(lowest, "hi")
            .select(F.explode(F.array(F.struct("hi", F.col("least").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("least").alias("lo")))).alias("e"))
            .select("e.*")
            .where("hi > lo")
            .distinct()
        )
        edges = materialize(small)
    return edges.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
