"""Near-duplicate documents by HyperMinHash sketches, banding and confirmation on full sets.

A document's set are its distinct five-word shingles. The shingles are dealt into ``REGISTERS``
buckets by hash; a register keeps, of the smallest hash in its bucket, the number of leading zeros
(6 bits) and the next ``MANTISSA`` bits. Empty registers are filled from others in a fixed random
order for banding only. Documents that agree in a band of ``BAND`` registers meet; of these pairs
the Jaccard similarity is estimated from all registers, corrected for chance agreement. What could
still reach the threshold (five standard errors) is confirmed on the full sets.

At a threshold of 0.85 a pair meets in none of the 25 bands with a chance of 4 in 10 million, at 0.8
with one of 5 in 100,000.

Only components are asked for, so pairs need not be confirmed within one. Documents with equal sets
are one to begin with. First each document is confirmed with its likeliest partner; this joins most of
a group. Then the documents that may still link with another component come with their
texts, and all such pairs are confirmed where the documents meet, so that a large group costs its
members' texts, not its pairs'. A band with over ``CHUNK`` documents is cut into chunks, each pair of
which is a unit of work.

Defined results: null and empty texts and texts without words have an empty set and link with
nothing; rows with a null id link with nothing and have a null component; repeated rows share their
component; different texts under one id are all compared, and the id belongs to the component of each of them,
which are one; other columns are left out; an empty table gives an empty table. Shingles are compared
by 64-bit hash.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordergrain.llm.graph import components, local_roots
from ordergrain.llm.storage import stored
from ordergrain.llm.textbytes import Texts, combine, mix, ragged, releasing, row_of, row_slices, signed, texts_of, words_of

WORDS = 5
REGISTERS, MANTISSA, BAND = 128, 10, 5
BANDS = REGISTERS // BAND
EMPTY = np.uint16(0xFFFF)
CHUNK, GROUP_ROWS, GROUP_TEXTS, SLAB_PAIRS = 512, 8192, 1024, 1 << 16


def shingles(texts: Texts, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct shingles of each row, sorted by both.

    A row with fewer words has its whole sequence as one shingle, a row without words none.
    """
    found, _, _ = words_of(texts)
    counts = found.count()
    short = np.flatnonzero((counts > 0) & (counts < words))
    rows = row_of(found.first)
    if len(found.hashes) >= words:
        chain = found.hashes[: len(found.hashes) - words + 1]
        for k in range(1, words):
            chain = combine(chain, found.hashes[k : len(found.hashes) - words + 1 + k])
        whole = rows[: len(chain)] == rows[words - 1 :]
        chain, rows = chain[whole], rows[: len(chain)][whole]
    else:
        chain, rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(short):
        start = found.first[short]
        sequence = found.hashes[start]
        for k in range(1, words - 1):
            more = counts[short] > k
            sequence[more] = combine(sequence[more], found.hashes[start[more] + k])
        sequence = mix(sequence ^ counts[short].astype(np.uint64))
        chain, rows = np.concatenate([chain, sequence]), np.concatenate([rows, short])
    order = np.lexsort((chain, rows))
    chain, rows = chain[order], rows[order]
    new = np.ones(len(chain), dtype=bool)
    new[1:] = (chain[1:] != chain[:-1]) | (rows[1:] != rows[:-1])
    return rows[new], chain[new]


def registers(rows: np.ndarray, hashes: np.ndarray, number: int) -> np.ndarray:
    """HyperMinHash registers of ``number`` sets, ``EMPTY`` where a bucket has no element."""
    least = np.full(number * REGISTERS, 2**64 - 1, dtype=np.uint64)
    buckets = rows * REGISTERS + (hashes & np.uint64(REGISTERS - 1)).astype(np.int64)
    np.minimum.at(least, buckets, mix(hashes ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(1))
    fraction, exponent = np.frexp(least.astype(np.float64))
    zeros = np.clip(63 - exponent, 0, 62)
    found = (zeros << MANTISSA) + (fraction * 2 ** (MANTISSA + 1)).astype(np.int64) - 2**MANTISSA
    found[least == 2**64 - 1] = EMPTY
    return found.astype(np.uint16).reshape(number, REGISTERS)


@lru_cache(maxsize=1)
def _fill_order() -> np.ndarray:
    random = np.random.default_rng(0x4D48)
    return np.stack([random.permutation(REGISTERS) for _ in range(REGISTERS)])


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """(sets, bands) hashes of the bands; sets without elements must be left out."""
    full, order = sketches.copy(), _fill_order()
    rows, places = np.nonzero(full == EMPTY)
    for k in range(REGISTERS):
        if not len(rows):
            break
        taken = sketches[rows, order[places, k]]
        full[rows, places] = taken
        still = taken == EMPTY
        rows, places = rows[still], places[still]
    keys = np.zeros((len(full), BANDS), dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
    keys = mix(keys)
    for k in range(BAND):
        keys = combine(keys, full[:, k : BANDS * BAND : BAND].astype(np.uint64))
    return keys


def estimates(left: np.ndarray, right: np.ndarray, sizes_left: np.ndarray, sizes_right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of pairs, corrected for chance agreement, and the number of registers used."""
    used = ((left != EMPTY) | (right != EMPTY)).sum(axis=-1)
    equal = ((left == right) & (left != EMPTY)).sum(axis=-1)
    large, small = np.maximum(sizes_left, sizes_right), np.minimum(sizes_left, sizes_right)
    ratio = (1 + large) / np.maximum(small, 1)
    chance = 0.169919487159739094 * 2.0**-MANTISSA * 4 * (large / np.maximum(small, 1)) / (ratio * ratio)
    share = equal / np.maximum(used, 1)
    return (share - chance) / (1 - chance), used


def _sketch(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    @releasing
    def run(batches):
        for batch in batches:
            for at, texts in row_slices(batch.column("text")):
                rows, hashes = shingles(texts, words)
                number = len(texts)
                sizes = np.bincount(rows, minlength=number)
                ends = np.concatenate([[0], np.cumsum(sizes)])
                sums = [np.concatenate([[np.uint64(0)], np.cumsum(x, dtype=np.uint64)]) for x in (hashes, mix(hashes + np.uint64(1)))]
                digests = [signed(s[ends[1:]] - s[ends[:-1]]) for s in sums]
                body = registers(rows, hashes, number)
                flat = pa.py_buffer(body.tobytes())
                width = REGISTERS * 2
                places = pa.py_buffer((np.arange(number + 1) * width).astype(np.int32).tobytes())
                sketches = pa.Array.from_buffers(pa.binary(), number, [None, places, flat])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(at, number), pa.array(sizes), *map(pa.array, digests), sketches],
                    ["key", "n", "sum1", "sum2", "sketch"],
                )

    kind = docs.schema[key].dataType.simpleString()
    return docs.selectExpr(f"`{key}` AS key", f"`{text}` AS text").mapInArrow(
        run, f"key {kind}, n long, sum1 long, sum2 long, sketch binary"
    )


def _sketches_of(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _bands(classes: DataFrame, kind: str) -> DataFrame:
    @releasing
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                keys = band_keys(_sketches_of(batch.column("sketch")))
                reps = batch.column("rep").take(pa.array(np.repeat(np.arange(batch.num_rows), BANDS)))
                yield pa.RecordBatch.from_arrays([pa.array(signed(keys.reshape(-1))), reps], ["band", "rep"])

    return classes.select("rep", "sketch").mapInArrow(run, f"band long, rep {kind}")


def _pairs(band, i, j, reps, label, sizes, chunk, sketches, threshold):
    """Pairs of rows that may reach the threshold, in slabs: rows x and y, and the estimate.

    The rows are sorted by band, i, j and rep. Only pairs of one unit (band, i, j) and of different
    labels are formed, and only in the first band in which they meet.
    """
    edges = np.flatnonzero((band[1:] != band[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
    edges = np.concatenate([[0], edges, [len(band)]])
    partners = edges[row_of(edges) + 1] - np.arange(len(band)) - 1
    ends, keys, start = np.cumsum(partners), None, 0
    while start < len(band):
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] - partners[start] + SLAB_PAIRS, "right")))
        x = np.repeat(np.arange(start, stop), partners[start:stop])
        y = ragged(np.arange(start, stop) + 1, partners[start:stop])
        start = stop
        # Sets of very different size cannot be similar.
        large, small = np.maximum(sizes[x], sizes[y]), np.minimum(sizes[x], sizes[y])
        apart = (label[x] != label[y]) & ((i[x] == j[x]) | (chunk[x] != chunk[y])) & (small >= threshold * large)
        x, y = x[apart], y[apart]
        estimate, used = estimates(sketches[x], sketches[y], sizes[x], sizes[y])
        slack = 5 * np.sqrt(threshold * (1 - threshold) / np.maximum(used, 1)) + 1 / np.maximum(used, 1)
        good = estimate >= threshold - slack
        if good.any():
            x, y, estimate = x[good], y[good], estimate[good]
            keys = band_keys(sketches) if keys is None else keys
            meeting = (keys[x] == keys[y]).argmax(axis=1)
            first = signed(keys[x, meeting]) == band[x]
            yield x[first], y[first], estimate[first]


def _units(meeting: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents of bands with different labels, once per pair of chunks that holds them."""
    labelled = meeting.join(labels, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    mixed = labelled.groupBy("band").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("size"))
    mixed = mixed.where("x <> y").select("band", F.ceil(F.col("size") / CHUNK).alias("chunks"))
    cut = labelled.join(mixed, "band").withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")))
    return cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).select(
        "rep", "label", "band", "chunk", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j")
    )


def _group(rows: int, size: int):
    return F.pmod(F.xxhash64("band", "i", "j"), F.lit(rows // size + 1)).alias("g")


_SORTED = ("band", "i", "j", "rep", "label", "chunk")


def _in_order(table: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
    columns = [table.column(c).to_numpy() for c in _SORTED]
    order = np.lexsort(columns[3::-1])
    return order, [c[order] for c in columns]


def _likeliest(units: DataFrame, classes: DataFrame, threshold: float, kind: str) -> DataFrame:
    """For every document and unit the pair (a, b) with its most similar partner."""

    @releasing
    def compare(table: pa.Table) -> pa.Table:
        order, (band, i, j, reps, label, chunk) = _in_order(table)
        sizes, sketches = table.column("n").to_numpy()[order], _sketches_of(table.column("sketch"))[order]
        found = list(_pairs(band, i, j, reps, label, sizes, chunk, sketches, threshold))
        x, y, estimate = map(np.concatenate, zip(*found)) if found else [np.zeros(0, np.int64)] * 3
        keep = np.zeros(len(x), dtype=bool)
        for end in (x, y):
            by_end = np.lexsort((-estimate, end))
            keep[by_end[np.searchsorted(end[by_end], np.unique(end))]] = True
        return pa.Table.from_arrays([pa.array(reps[x[keep]]), pa.array(reps[y[keep]])], ["a", "b"])

    work = units.join(classes.select("rep", "n", "sketch"), "rep").select("*", _group(units.count(), GROUP_ROWS))
    return work.groupBy("g").applyInArrow(compare, f"a {kind}, b {kind}").distinct()


def _undecided(units: DataFrame, classes: DataFrame, threshold: float, kind: str) -> DataFrame:
    """The rows of ``units`` whose document may link with another label's document in the unit."""

    @releasing
    def compare(table: pa.Table) -> pa.Table:
        order, (band, i, j, reps, label, chunk) = _in_order(table)
        sizes, sketches = table.column("n").to_numpy()[order], _sketches_of(table.column("sketch"))[order]
        open_ = np.zeros(len(band), dtype=bool)
        for x, y, _ in _pairs(band, i, j, reps, label, sizes, chunk, sketches, threshold):
            open_[x] = open_[y] = True
        return pa.Table.from_arrays([pa.array(c[open_]) for c in (band, i, j, reps, label, chunk)], list(_SORTED))

    work = units.join(classes.select("rep", "n", "sketch"), "rep").select("*", _group(units.count(), GROUP_ROWS))
    return work.groupBy("g").applyInArrow(compare, f"band long, i long, j long, rep {kind}, label {kind}, chunk long")


def _links_of_units(rows: DataFrame, texts: DataFrame, words: int, percent: int, kind: str) -> DataFrame:
    """Links (a, b) that connect the documents of a unit as all their confirmed links do."""

    @releasing
    def compare(table: pa.Table) -> pa.Table:
        order, (band, i, j, reps, label, chunk) = _in_order(table)
        owner, hashes = shingles(texts_of(table.column("text").take(pa.array(order))), words)
        sizes = np.bincount(owner, minlength=len(order))
        ends = np.concatenate([[0], np.cumsum(sizes)])
        sketches = registers(owner, hashes, len(order))
        distinct, element = np.unique(hashes, return_inverse=True)
        marked = np.zeros(len(distinct), dtype=bool)
        left, right = [], []
        for x, y, _ in _pairs(band, i, j, reps, label, sizes, chunk, sketches, percent / 100):
            by_x = np.argsort(x, kind="stable")
            x, y = x[by_x], y[by_x]
            for part in np.split(np.arange(len(x)), np.flatnonzero(np.diff(x)) + 1):
                if len(part):
                    a, b = x[part[0]], y[part]
                    own = element[ends[a] : ends[a + 1]]
                    marked[own] = True
                    inside = np.concatenate([[0], np.cumsum(marked[element[ragged(ends[b], sizes[b])]])])
                    marked[own] = False
                    stops = np.cumsum(sizes[b])
                    shared = inside[stops] - inside[stops - sizes[b]]
                    linked = b[100 * shared >= percent * (sizes[a] + sizes[b] - shared)]
                    left.append(np.full(len(linked), a))
                    right.append(linked)
        left, right = (np.concatenate(z) if z else np.zeros(0, np.int64) for z in (left, right))
        roots = local_roots(len(order), left, right)
        moved = np.flatnonzero(roots != np.arange(len(order)))
        return pa.Table.from_arrays([pa.array(reps[moved]), pa.array(reps[roots[moved]])], ["a", "b"])

    work = rows.join(texts, "rep").select("*", _group(rows.count(), GROUP_TEXTS))
    return work.groupBy("g").applyInArrow(compare, f"a {kind}, b {kind}").distinct()


def _confirm(pairs: DataFrame, texts: DataFrame, words: int, percent: int, kind: str) -> DataFrame:
    """``pairs`` with ``linked``: whether 100 times the intersection reaches ``percent`` times the union."""
    both = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b").select("a", "b", "text_a", "text_b")

    @releasing
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                row_a, hash_a = shingles(texts_of(rows.column("text_a")), words)
                row_b, hash_b = shingles(texts_of(rows.column("text_b")), words)
                row, hashes = np.concatenate([row_a, row_b]), np.concatenate([hash_a, hash_b])
                order = np.lexsort((hashes, row))
                row, hashes = row[order], hashes[order]
                shared = np.bincount(row[1:][(row[1:] == row[:-1]) & (hashes[1:] == hashes[:-1])], minlength=rows.num_rows)
                union = np.bincount(row, minlength=rows.num_rows) - shared
                linked = (100 * shared >= percent * union) & (union > 0)
                yield pa.RecordBatch.from_arrays([rows.column("a"), rows.column("b"), pa.array(linked)], ["a", "b", "linked"])

    return both.mapInArrow(run, f"a {kind}, b {kind}, linked boolean")


def _labels(links: DataFrame) -> DataFrame:
    return components(links, "a", "b").select(F.col("id").alias("rep"), F.col("component").alias("label"))


def _texts_apart(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """``docs`` as id, node and text, and the ids with different texts.

    The node is the id; a text of an id with different texts has a node of its own, a hash of both.
    """
    kind = docs.schema[key].dataType
    plain = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    print_ = F.xxhash64("text")
    several = plain.where("id IS NOT NULL").groupBy("id").agg(F.min(print_).alias("low"), F.max(print_).alias("high"))
    several = stored(several.where("low <> high").select("id"))
    marked = plain.join(several.withColumn("own", F.lit(True)), "id", "left")
    wide = T.LongType() if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)) else kind
    node = F.when(F.col("own"), F.xxhash64("id", "text").cast(wide)).otherwise(F.col("id").cast(wide))
    return marked.select("id", node.alias("node"), "text"), several


def _named_by_id(rows: DataFrame, nodes: DataFrame, several: DataFrame) -> DataFrame:
    """``rows`` of nodes with the ids of the nodes; components that share an id are one, named by the smallest id."""
    ids = nodes.join(several, "id", "left_semi").select("node", "id").distinct()
    named = rows.join(ids, "node", "left").withColumn("id", F.coalesce("id", F.col("node").cast(nodes.schema["id"].dataType)))
    named = stored(named)
    least = named.groupBy("component_id").agg(F.min("id").alias("least"))
    links = named.join(least, "component_id").where("id <> least").select("id", "least").distinct()
    labels = components(links, "id", "least")
    component = F.coalesce("component", "id")
    return named.drop("component_id", "kept").join(labels, "id", "left").select(
        "id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept")
    )


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = 85
) -> DataFrame:
    """Per row: key, n_shingles, component_id (smallest id reachable by links), kept."""
    nodes, several = _texts_apart(docs, key, text)
    if several.isEmpty():
        return _groups(docs, key, text, words, percent)
    rows = _groups(nodes.select("node", "text"), "node", "text", words, percent)
    return _named_by_id(rows, nodes, several).withColumnRenamed("id", key)


def _groups(docs: DataFrame, key: str, text: str, words: int, percent: int) -> DataFrame:
    """The groups of documents of which an id has one text."""
    kind = docs.schema[key].dataType.simpleString()
    sketched = stored(_sketch(docs, key, text, words))
    usable = sketched.where("key IS NOT NULL AND n > 0")
    classes = stored(usable.groupBy("n", "sum1", "sum2").agg(F.min("key").alias("rep"), F.first("sketch").alias("sketch")))
    members = usable.join(classes.select("n", "sum1", "sum2", "rep"), ["n", "sum1", "sum2"]).select("key", "rep").distinct()
    bands = stored(_bands(classes, kind))
    shared = bands.groupBy("band").agg(F.count("*").alias("size")).where("size > 1").select("band")
    meeting = stored(bands.join(shared, "band"))
    wanted = meeting.select("rep").distinct()
    keyed = docs.select(F.col(key).alias("rep"), F.col(text).alias("text")).where("rep IS NOT NULL")
    texts = stored(keyed.join(wanted, "rep").groupBy("rep").agg(F.min("text").alias("text")))
    same = members.where("key <> rep").select(F.col("key").alias("a"), F.col("rep").alias("b"))
    units = stored(_units(meeting, _labels(same)))
    nearest = stored(_likeliest(units, classes, percent / 100, kind))
    links = same.unionAll(stored(_confirm(nearest, texts, words, percent, kind)).where("linked").select("a", "b"))
    units = stored(_units(meeting, _labels(links)))
    rest = stored(_undecided(units, classes, percent / 100, kind))
    links = links.unionAll(stored(_links_of_units(rest, texts, words, percent, kind)))
    labels = _labels(links)
    rows = sketched.select("key", "n").join(labels.withColumnRenamed("rep", "key"), "key", "left")
    component = F.coalesce("label", "key")
    return rows.select(
        F.col("key").alias(key),
        F.col("n").cast(T.LongType()).alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("key") == component, F.lit(True)).alias("kept"),
    )
