"""Near-duplicate vectors by lattice hashing.

Unit vectors are projected to eight random orthonormal directions and rounded to the nearest point
of the lattice E8, once per table. A vector lies in the cell of its own point and also probes the
cells of the nearest of the 240 neighbouring points. Two vectors meet where one lies in a cell that
the other lies in or probes; every meeting is decided by the cosine in double precision.

For a pair at the threshold one table finds 92 of 100 (``CELL`` 0.2, six probes), four tables miss
fewer than 1 in 10,000; closer pairs are missed less. The number of candidates is the share of the
vectors in a cell; for many more vectors lower ``cell`` and add tables.

Equal vectors are reduced to one with a weight first. A cell with over ``CHUNK`` rows is cut into
chunks and every pair of chunks is a unit of work, so no task holds an unbounded cell. A unit adds
up links and joins its vectors to local groups; pairs never leave it. A pair that meets in several
units counts in the first of them only, which both vectors' cells tell.

Defined results: a vector that is null, empty, all zero or holds null or non-finite components
links with nothing and keeps its own id; so does a row with a null id. Vectors of different length
never link. Rows that share an id share its links, which do not count the id itself.
Other columns are left out. An empty table gives an empty table.
"""

from __future__ import annotations

import itertools
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordergrain.llm.graph import components, local_roots
from ordergrain.llm.storage import stored
from ordergrain.llm.textbytes import mix, releasing, signed

TABLES, PROBES, CELL = 4, 6, 0.2  # the cell is that of 64 components and a threshold of 0.95
CHUNK, GROUP_ROWS, SLAB = 1024, 8192, 128
_VALID = (
    "{id} IS NOT NULL AND size({vec}) > 0 AND forall({vec}, x -> x IS NOT NULL AND abs(x) < double('infinity'))"
    " AND exists({vec}, x -> x <> 0)"
)


def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    found = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            vector = [0.0] * 8
            vector[i], vector[j] = a, b
            found.append(vector)
    found += [signs for signs in itertools.product((0.5, -0.5), repeat=8) if sum(s < 0 for s in signs) % 2 == 0]
    return np.array(found)


NEIGHBOURS = minimal_vectors()


def _nearest_even(points: np.ndarray) -> np.ndarray:
    """The nearest whole-number points with an even sum."""
    found = np.rint(points)
    odd = np.flatnonzero(found.sum(axis=1).astype(np.int64) & 1)
    off = points[odd] - found[odd]
    worst = np.abs(off).argmax(axis=1)
    found[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1, -1)
    return found


def nearest_lattice_points(points: np.ndarray) -> np.ndarray:
    """The nearest points of E8: whole or half-odd coordinates, even sum."""
    whole, half = _nearest_even(points), _nearest_even(points - 0.5) + 0.5
    closer = ((points - whole) ** 2).sum(axis=1) <= ((points - half) ** 2).sum(axis=1)
    return np.where(closer[:, None], whole, half)


@lru_cache(maxsize=64)
def _directions(width: int, table: int) -> np.ndarray:
    random = np.random.default_rng([0xE8, width, table]).normal(size=(max(width, 8), 8))
    return np.linalg.qr(random)[0][:width]


def _cell_ids(points: np.ndarray, table: int) -> np.ndarray:
    doubled = np.ascontiguousarray(np.rint(2 * points).astype(np.int8))
    return mix(doubled.view(np.uint64)[..., 0] + np.uint64(0x9E3779B97F4A7C15 * (table + 1) % 2**64))


def cells(vectors: np.ndarray, tables: int, probes: int, cell: float) -> np.ndarray:
    """Cell ids of unit vectors, (vectors, tables, 1 + probes): the own cell, then the probed ones.

    A projection keeps a larger part of a narrower vector, so the cell grows with the root of 64 / width.
    """
    cell = cell * np.sqrt(64 / vectors.shape[1])
    found = np.zeros((len(vectors), tables, 1 + probes), dtype=np.uint64)
    for t in range(tables):
        points = vectors @ _directions(vectors.shape[1], t) / cell
        own = nearest_lattice_points(points)
        found[:, t, 0] = _cell_ids(own, t)
        if probes:
            closeness = (points - own) @ NEIGHBOURS.T
            near = np.argpartition(-closeness, probes - 1, axis=1)[:, :probes]
            found[:, t, 1:] = _cell_ids(own[:, None, :] + NEIGHBOURS[near], t)
    return found


def unit_vectors(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)
    return flat / np.sqrt((flat * flat).sum(axis=1, keepdims=True))


def _first_meeting(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table and cell in which pairs meet first; ``left`` has the cells of the smaller id."""
    by_left = (left[:, :, :1] == right).any(axis=2)
    by_right = (right[:, :, :1] == left).any(axis=2)
    table = (by_left | by_right).argmax(axis=1)
    row = np.arange(len(left))
    cell = np.where(by_left[row, table], left[row, table, 0], right[row, table, 0])
    return table, cell


def similar_vectors(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    threshold: float = 0.95,
    tables: int = TABLES,
    probes: int = PROBES,
    cell: float | None = None,
) -> DataFrame:
    """Per row: id, n_links (other vectors linked directly), component_id, kept."""
    if cell is None:  # in proportion to the distance of unit vectors at the threshold
        cell = CELL * float(np.sqrt((1 - threshold) / 0.05))
    valid = vectors.where(_VALID.format(id=f"`{id}`", vec=f"`{vector}`")).select(
        F.col(id).alias("id"), F.col(vector).alias("vec")
    )
    classes = stored(valid.groupBy("vec").agg(F.min("id").alias("rep"), F.count_distinct("id").alias("weight")))
    members = valid.join(classes, "vec").select("id", "rep", "weight").distinct()

    @releasing
    def place(batches):
        for batch in batches:
            widths = pc.list_value_length(batch.column("vec")).to_numpy()
            for width in np.unique(widths):
                rows = batch.filter(pa.array(widths == width))
                for at in range(0, rows.num_rows, 4096):
                    some = rows.slice(at, 4096)
                    found = cells(unit_vectors(some.column("vec"), int(width)), tables, probes, cell)
                    found = found ^ mix(np.full(1, width, np.uint64))
                    each = tables * (1 + probes)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(some.column("rep").to_numpy(), each)),
                            pa.array(np.tile(np.repeat(np.arange(tables, dtype=np.int32), 1 + probes), some.num_rows)),
                            pa.array(signed(found.reshape(-1))),
                            pa.array(np.tile(np.arange(1 + probes) == 0, tables * some.num_rows)),
                        ],
                        ["rep", "tab", "cell", "own"],
                    )

    kind = vectors.schema[id].dataType.simpleString()
    places = stored(classes.select("rep", "vec").mapInArrow(place, f"rep {kind}, tab int, cell long, own boolean"))
    sizes = places.groupBy("tab", "cell").agg(F.count("*").alias("n"), F.sum(F.col("own").cast("int")).alias("owned"))
    sizes = sizes.where("n > 1 AND owned > 0").select("tab", "cell", F.ceil(F.col("n") / CHUNK).alias("chunks"))
    cut = places.join(sizes, ["tab", "cell"]).withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
    units = cut.withColumn("other", other).select(
        "rep", "tab", "cell", "own", "chunk", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j")
    )
    groups = F.pmod(F.xxhash64("tab", "cell", "i", "j"), F.lit(places.count() // GROUP_ROWS + 1)).alias("g")
    work = units.join(classes, "rep").select("*", groups)

    @releasing
    def compare(group: pa.Table) -> pa.Table:
        ids = group.column("rep").to_numpy()
        weight = group.column("weight").to_numpy()
        own, chunk = group.column("own").to_numpy(), group.column("chunk").to_numpy()
        names = ["tab", "cell", "i", "j"]
        columns = [group.column(c).to_numpy() for c in names]
        widths = pc.list_value_length(group.column("vec")).to_numpy()
        order = np.lexsort([*columns[::-1], widths])
        marks = np.stack([*(c[order] for c in columns), widths[order]])
        bounds = np.flatnonzero(np.concatenate([[True], (marks[:, 1:] != marks[:, :-1]).any(axis=0), [True]]))
        out = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            rows = order[a:b]
            if b - a < 2 or not own[rows].any():
                continue
            width = int(widths[rows[0]])
            unit = unit_vectors(group.column("vec").take(pa.array(rows)), width)
            out.append(_links_of_unit(unit, ids[rows], weight[rows], own[rows], chunk[rows], *(c[rows[0]] for c in columns)))
        found = [np.concatenate(x) for x in zip(*out)] or [ids[:0], weight[:0], ids[:0]]
        return pa.Table.from_arrays([pa.array(found[0]), pa.array(found[1]), pa.array(found[2])], ["id", "links", "root"])

    def _links_of_unit(unit, ids, weight, own, chunk, table, cell_id, i, j):
        place_of = cells(unit, tables, probes, cell) ^ mix(np.full(1, unit.shape[1], np.uint64))
        links, pairs = np.zeros(len(ids), dtype=np.int64), []
        for side, against in {(i, j), (j, i)}:
            bases, far = np.flatnonzero(own & (chunk == side)), np.flatnonzero(chunk == against)
            for at in range(0, len(bases), SLAB):
                some = bases[at : at + SLAB]
                x, y = np.nonzero(unit[some] @ unit[far].T >= threshold)
                x, y = some[x], far[y]
                once = (ids[x] != ids[y]) & (~own[y] | (ids[x] < ids[y]))  # two owners see each other twice
                x, y = x[once], y[once]
                low, high = np.where(ids[x] < ids[y], x, y), np.where(ids[x] < ids[y], y, x)
                first_table, first_cell = _first_meeting(place_of[low], place_of[high])
                first = (first_table == table) & (signed(first_cell) == cell_id)
                pairs.append(np.stack([low[first], high[first]]))
        left, right = np.concatenate(pairs, axis=1)
        np.add.at(links, left, weight[right])
        np.add.at(links, right, weight[left])
        order = np.argsort(ids, kind="stable")
        turn = np.empty(len(ids), dtype=np.int64)
        turn[order] = np.arange(len(ids))
        roots = local_roots(len(ids), turn[left], turn[right])
        hit = np.flatnonzero(links)
        return ids[hit], links[hit], ids[order][roots[turn[hit]]]

    found = stored(work.groupBy("g").applyInArrow(compare, f"id {kind}, links long, root {kind}"))
    links = found.groupBy("id").agg(F.sum("links").alias("links")).withColumnRenamed("id", "rep")
    group = components(found, "id", "root").withColumnRenamed("id", "rep")
    known = (
        members.join(links, "rep", "left")
        .join(group, "rep", "left")
        .groupBy("id")
        .agg(
            F.sum(F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.min(F.coalesce("component", "rep")).alias("component_id"),
        )
    )
    rows = vectors.select(F.col(id).alias("id")).join(known, "id", "left")
    component = F.coalesce("component_id", "id")
    return rows.select(
        F.col("id").alias(id),
        F.coalesce("n_links", F.lit(0).cast(T.LongType())).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
