"""Positions, running totals and exact order statistics without a single-task window.

``row_number()`` over an unpartitioned (or very unevenly partitioned) window sorts all rows in
one task. Here rows are range-partitioned on the order key instead, so even one huge group is
spread over many tasks, and each partition then only needs the totals of the ones before it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordergrain.session import materialize

_SLICE, _PLACE, _START = "__slice", "__place", "__start"

# Half-widths, as a share of the rows, of the bracket searched for an order statistic, tried in turn,
# and the accuracy of the sketch that finds it (rank error at most 1/accuracy, within the bracket).
_BRACKETS = (0.0005, 0.02, 1.0)
_SKETCH_ACCURACY = 10_000


def _sorted_slices(df: DataFrame, group_by: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """Rows in range partitions, with their partition and their place in it.

    Stored once: the range bounds come from a sample, so two evaluations could cut differently.
    ``order_by`` has to identify a row within its group.
    """
    keys = [F.col(name) for name in group_by] + list(order_by)
    return materialize(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select("*", F.spark_partition_id().alias(_SLICE), F.monotonically_increasing_id().alias(_PLACE))
    )


def _join_slice_totals(rows: DataFrame, totals: DataFrame, group_by: Sequence[str]) -> DataFrame:
    # Without groups there is one row of totals per partition, a bound set by the session.
    if not group_by:
        totals = F.broadcast(totals)
    return rows.join(totals, [_SLICE, *group_by])


def row_positions(
    df: DataFrame,
    order_by: Sequence[Column],
    group_by: Sequence[str] = (),
    position: str = "position",
    size: str | None = None,
) -> DataFrame:
    """Add the 0-based position of each row in its group, and optionally the group size.

    ``group_by`` columns must not be null. One range shuffle of the rows; none after it when
    there are no groups.
    """
    rows = _sorted_slices(df, group_by, order_by)
    earlier = Window.partitionBy(*group_by).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        rows.groupBy(_SLICE, *group_by)
        .agg(F.min(_PLACE).alias("__first"), F.count("*").alias("__rows"))
        .select(
            _SLICE,
            *group_by,
            "__first",
            F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias(_START),
            F.sum("__rows").over(Window.partitionBy(*group_by)).alias("__size"),
        )
    )
    kept = [c for c in rows.columns if c not in (_SLICE, _PLACE)]
    added = [(F.col(_START) + F.col(_PLACE) - F.col("__first")).alias(position)]
    if size is not None:
        added.append(F.col("__size").alias(size))
    return _join_slice_totals(rows, totals, group_by).select(*kept, *added)


def running_totals(
    df: DataFrame,
    order_by: Sequence[Column],
    sums: Mapping[str, str],
    group_by: Sequence[str] = (),
) -> DataFrame:
    """Add, for each ``{column: name}``, ``name`` and ``name_total``.

    ``name`` is the sum of ``column`` over the earlier rows of the group, ``name_total`` the sum
    over the whole group. ``group_by`` columns must not be null.
    """
    rows = _sorted_slices(df, group_by, order_by)
    earlier = Window.partitionBy(*group_by).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group_by)
    totals = (
        rows.groupBy(_SLICE, *group_by)
        .agg(*[F.sum(column).alias(f"__in_{name}") for column, name in sums.items()])
        .select(
            _SLICE,
            *group_by,
            *[F.coalesce(F.sum(f"__in_{n}").over(earlier), F.lit(0)).alias(f"__start_{n}") for n in sums.values()],
            *[F.sum(f"__in_{n}").over(whole).alias(f"{n}_total") for n in sums.values()],
        )
    )
    # A window partition is one group within one range partition, so its size is bounded.
    before = (
        Window.partitionBy(_SLICE, *group_by).orderBy(_PLACE).rowsBetween(Window.unboundedPreceding, -1)
    )
    local = rows.select(
        "*",
        *[F.coalesce(F.sum(column).over(before), F.lit(0)).alias(f"__local_{name}") for column, name in sums.items()],
    )
    kept = [c for c in df.columns]
    added = []
    for name in sums.values():
        added.append((F.col(f"__start_{name}") + F.col(f"__local_{name}")).alias(name))
        added.append(F.col(f"{name}_total"))
    return _join_slice_totals(local, totals, group_by).select(*kept, *added)


def _counts_around_medians(df: DataFrame, group_by: str, columns: Sequence[str]) -> DataFrame:
    """Rows ``(grp, measure, total, inside, n)``: values in the bracket of a group's median and how often they
    occur, and with ``inside`` null the number of rows below the bracket."""
    margin = 4 / _SKETCH_ACCURACY
    sketch = "percentile_approx({c}, array({low}, {high}), {accuracy}) AS {c}_bracket, count({c}) AS {c}_n"
    sketches = ", ".join(
        sketch.format(c=f"c{i}", low=0.5 - margin, high=0.5 + margin, accuracy=_SKETCH_ACCURACY) for i in range(len(columns))
    )
    named = [f"CAST(`{c}` AS DOUBLE) AS c{i}" for i, c in enumerate(columns)]
    points = df.where(F.col(group_by).isNotNull()).selectExpr(f"`{group_by}` AS grp", *named)
    brackets = points.groupBy("grp").agg(F.expr(f"struct({sketches})").alias("s"))
    each = ", ".join(f"{i}, c{i}, s.c{i}_bracket, s.c{i}_n" for i in range(len(columns)))
    return (
        points.join(brackets, "grp")
        .selectExpr("grp", f"stack({len(columns)}, {each}) AS (measure, value, bracket, total)")
        .where("value IS NULL OR value <= bracket[1]")  # null values keep a group without values in the result
        .selectExpr("grp", "measure", "total", "CASE WHEN value >= bracket[0] THEN value END AS inside", "value")
        .groupBy("grp", "measure", "total", "inside")
        .agg(F.count("value").alias("n"))
    )


def grouped_medians(df: DataFrame, group_by: str, columns: Sequence[str]) -> DataFrame:
    """Exact median of each column per group: ``(group_by, *columns)``, null groups left out.

    A quantile sketch per group, merged map-side, brackets the median; with ``_SKETCH_ACCURACY`` it is exact
    for groups with fewer rows and off by a ten-thousandth of the rows at most for larger ones, which the
    bracket allows for fourfold. A second pass counts the rows below the bracket, and only the values inside
    it (about a thousandth of a large group) are put in order. So no task sees a whole group. A
    group whose median is not in its bracket would raise an error.
    """
    counts = _counts_around_medians(df, group_by, columns).repartition("grp")
    upto = "sum(n) OVER (PARTITION BY grp, measure ORDER BY inside ROWS UNBOUNDED PRECEDING)"
    placed = counts.selectExpr("grp", "measure", "total", "inside", "n", f"{upto} AS through")

    def at(i: int, place: str) -> str:
        return f"max(CASE WHEN measure = {i} AND through - n <= {place} AND {place} < through THEN inside END)"

    def median(i: int) -> str:
        found = f"({at(i, '(total - 1) DIV 2')} + {at(i, 'total DIV 2')}) / 2"
        known = f"max(CASE WHEN measure = {i} THEN total END)"
        return f"CASE WHEN {known} > 0 THEN coalesce({found}, raise_error('A median lies outside its bracket')) END"

    medians = [F.expr(median(i)).alias(c) for i, c in enumerate(columns)]
    return placed.groupBy(F.col("grp").alias(group_by)).agg(*medians)


@dataclass(frozen=True)
class Place:
    """One requested order statistic: the key at a 0-based position of a column."""

    column: str
    position: int


def _brackets(
    df: DataFrame, places: Sequence[Place], counts: Mapping[str, int], width: float
) -> dict[str, list[tuple]]:
    """Disjoint value ranges per column that contain every requested position."""
    sketches, spans = [], []
    for place in places:
        total = counts[place.column]
        margin = width + 2.0 / total
        share = (place.position + 0.5) / total
        bounds = [max(0.0, share - margin), min(1.0, share + margin)]
        sketches.append(F.percentile_approx(place.column, bounds, _SKETCH_ACCURACY).alias(f"b{len(spans)}"))
        spans.append(place.column)
    found = df.agg(*sketches).first()
    merged: dict[str, list[tuple]] = {}
    for column in dict.fromkeys(spans):
        ranges = sorted(tuple(found[i]) for i, name in enumerate(spans) if name == column)
        joined = [ranges[0]]
        for low, high in ranges[1:]:
            if low <= joined[-1][1]:
                joined[-1] = (joined[-1][0], max(high, joined[-1][1]))
            else:
                joined.append((low, high))
        merged[column] = joined
    return merged


def order_statistics(
    df: DataFrame,
    targets: Mapping[str, Callable[[int], Sequence[int]]],
    tie_key: str | None = None,
) -> dict[Place, tuple]:
    """Exact keys at given positions of whole columns.

    ``targets`` maps a numeric column to a function from its number of non-null values to the
    0-based positions wanted. The answer maps each :class:`Place` to ``(value, tie)``; rows with
    equal values are ordered by ``tie_key`` when it is given.

    A quantile sketch brackets each position, one scan counts the rows below the brackets, and
    only the rows inside a bracket (about a thousandth, plus ties) are ranked. Should a position lie
    outside its bracket, wider ones follow, the last of which holds all rows. ``df`` is read several
    times: pass stored rows. The driver receives one row per position.
    """
    columns = list(targets)
    tie = [F.col(tie_key).alias("tie")] if tie_key else []
    narrow = df.select(*[F.col(c).cast("double").alias(c) for c in columns], *tie)
    counts = narrow.agg(*[F.count(c).alias(c) for c in columns]).first().asDict()
    places = [Place(c, p) for c in columns if counts[c] for p in targets[c](counts[c])]
    if not places:
        return {}
    for width in _BRACKETS:
        answers = _search(narrow, places, counts, tie_key, width)
        if answers is not None:
            return answers
    raise RuntimeError("The input of an order statistic changed while it was read")


def _search(
    narrow: DataFrame, places: Sequence[Place], counts: Mapping[str, int], tie_key: str | None, width: float
) -> dict[Place, tuple] | None:
    """The keys at all places, or None if one lies outside its bracket."""
    brackets = _brackets(narrow, places, counts, width)
    numbered = [(c, low, high) for c, ranges in brackets.items() for low, high in ranges]
    below = narrow.agg(
        *[F.count(F.when(F.col(c) < low, 1)).alias(f"b{i}") for i, (c, low, _) in enumerate(numbered)]
    ).first()

    inside = [
        F.when(F.col(c).between(low, high), F.struct(F.lit(i).alias("bracket"), F.col(c).alias("value")))
        for i, (c, low, high) in enumerate(numbered)
    ]
    kept = ["tie"] if tie_key else []
    hits = narrow.select(*kept, F.explode(F.array_compact(F.array(*inside))).alias("hit")).select(
        *kept, "hit.bracket", "hit.value"
    )
    group = ["bracket"]
    if tie_key:
        ranked = row_positions(hits, [F.col("value"), F.col("tie")], group, "before").withColumn("n", F.lit(1))
    else:
        value_counts = hits.groupBy("bracket", "value").agg(F.count("*").alias("n"))
        ranked = running_totals(value_counts, [F.col("value")], {"n": "before"}, group)

    wanted: dict[tuple[int, int], Place] = {}
    for place in dict.fromkeys(places):
        homes = [i for i, (c, _, _) in enumerate(numbered) if c == place.column and below[i] <= place.position]
        if not homes:
            return None
        home = max(homes)
        wanted[home, place.position - below[home]] = place

    def covers(offset: int) -> Column:
        return (F.col("before") <= offset) & (offset < F.col("before") + F.col("n"))

    test = reduce(
        lambda a, b: a | b,
        [(F.col("bracket") == bracket) & covers(offset) for bracket, offset in wanted],
    )
    answers: dict[Place, tuple] = {}
    for row in ranked.where(test).collect():  # one row per requested position
        for (bracket, offset), place in wanted.items():
            if bracket == row["bracket"] and row["before"] <= offset < row["before"] + row["n"]:
                answers[place] = (row["value"], row["tie"] if tie_key else None)
    return answers if len(answers) == len(wanted) else None


def _median_places(total: int) -> list[int]:
    return sorted({(total - 1) // 2, total // 2})


def exact_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact median of whole columns; None for a column without values."""
    found = order_statistics(df, {c: _median_places for c in columns})
    values: dict[str, list[float]] = {c: [] for c in columns}
    for place, (value, _) in found.items():
        values[place.column].append(value)
    return {c: (min(v) + max(v)) / 2 if v else None for c, v in values.items()}


def after_key(value: Column, tie: Column, key: tuple) -> Column:
    """Whether ``(value, tie)`` sorts after ``key``."""
    return (value > key[0]) | ((value == key[0]) & (tie > key[1]))


def quartile_scores(
    df: DataFrame, columns: Mapping[str, str], tie_key: str, descending: Sequence[str] = ()
) -> DataFrame:
    """Add a score of 1 to 4 for each ``{column: score name}``, ties ordered by ``tie_key``.

    Row ``r`` of ``n`` (from 1) gets ``ceil(4r / n)``, or 5 minus that for columns listed in
    ``descending``. Only the nine boundary keys are searched; scoring itself moves no rows.
    """

    def last_of_quarters(total: int) -> list[int]:
        return sorted({q * total // 4 - 1 for q in (1, 2, 3)} - {-1})

    found = order_statistics(df, {c: last_of_quarters for c in columns}, tie_key)
    sizes = df.agg(*[F.count(c).alias(c) for c in columns]).first()
    scores = []
    for column, name in columns.items():
        value = F.col(column).cast("double")
        score = F.lit(1)
        for quarter in (1, 2, 3):
            position = quarter * sizes[column] // 4 - 1
            if position < 0:  # fewer rows than quarters: nothing lies in this one
                passed = F.lit(1)
            else:
                key = found[Place(column, position)]
                passed = after_key(value, F.col(tie_key), (key[0], F.lit(key[1]))).cast("int")
            score = score + passed
        if column in descending:
            score = F.lit(5) - score
        scores.append(F.when(F.col(column).isNotNull(), score).alias(name))
    return df.select("*", *scores)
