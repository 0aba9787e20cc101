"""Best-fit packing of token sequences with matching of large items.

Lengths are whole numbers up to the capacity, so a plan needs the number of items of each length
only. Items over a third of the capacity come first, longest first: each joins the fullest
sequence that still takes it, which pairs it with at most one other such item, or opens a new one.
Smaller items then fill the remaining gaps, again longest first and tightest gap first. The plan is
a list of runs ("the next 500 items of length 310 go, two each, to sequences 17 to 266"); the
items look up their run by length and rank. The plan's size depends on the capacity, not on the
number of items, and only the counts by length (at most ``capacity`` rows) reach the driver.

Defined results: null and empty texts have the end token only; longer texts are cut into pieces of
the capacity, the first of which may be shorter; repeated rows are packed each; other columns are
left out; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordergrain.llm.bpe import Vocabulary
from ordergrain.llm.storage import stored
from ordergrain.llm.textbytes import releasing, row_slices

ROWS_PER_SALT = 50_000


class Run(NamedTuple):
    """``count`` items of one length, from ``rank`` on, ``each`` per sequence from ``sequence`` on."""

    length: int
    rank: int
    count: int
    sequence: int
    each: int
    offset: int


def plan(counts: dict[int, int], capacity: int) -> tuple[list[Run], int]:
    """The runs that pack ``counts`` (items by length), and the number of sequences."""
    gaps: list[int] = []  # sorted gaps that some sequences have
    ranges: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> runs of sequences (first, number)
    runs, opened = [], 0

    def put(gap: int, first: int, number: int) -> None:
        if gap and number:
            if not ranges[gap]:
                insort(gaps, gap)
            ranges[gap].append((first, number))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(gaps, length)
            if at < len(gaps):
                gap = gaps[at]
                first, number = ranges[gap].pop()
                if not ranges[gap]:
                    gaps.pop(at)
            else:  # no gap takes it: open as many sequences as the rest of this length needs
                gap, first = capacity, opened
                number = -(-left // (capacity // length))
                opened += number
            each = min(gap // length, left)
            used = min(number, left // each)
            runs.append(Run(length, rank, used * each, first, each, capacity - gap))
            put(gap - each * length, first, used)
            put(gap, first + used, number - used)
            rank, left = rank + used * each, left - used * each
    return runs, opened


def pack(items: DataFrame, capacity: int, order: list[str], length: str = "length") -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``; gapless from 0 in every sequence.

    Every length lies between 1 and ``capacity``. ``order`` names the columns that rank items of
    equal length. ``items`` is read three times and must give the same rows each time; pass a
    stored table.
    """
    total = items.count()
    salt = F.pmod(F.xxhash64(*order), F.lit(max(1, total // ROWS_PER_SALT))).alias("_salt")
    salted = items.select("*", salt)
    counts = salted.groupBy(length, "_salt").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(length).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(length, "_salt", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    histogram = {r[0]: r[1] for r in counts.groupBy(length).agg(F.sum("_n")).collect()}
    runs, _ = plan(histogram, capacity)
    runs.sort()
    table = np.array(runs or [Run(1, 0, 0, 0, 1, 0)], dtype=np.int64).T
    keys = (table[0] << 48) + table[1]

    @releasing
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column("_rank").to_numpy()
            size = batch.column(length).to_numpy().astype(np.int64)
            run = np.searchsorted(keys, (size << 48) + rank, "right") - 1
            step, turn = np.divmod(rank - table[1][run], table[4][run])
            kept = [c for c in batch.schema.names if c != "_rank"]
            columns = [batch.column(c) for c in kept]
            columns += [pa.array(table[3][run] + step), pa.array(table[5][run] + turn * size)]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "sequence_id", "offset"])

    within = F.row_number().over(Window.partitionBy(length, "_salt").orderBy(*order))
    ranked = salted.join(bases, [length, "_salt"]).select(*items.columns, (F.col("_base") + within - 1).alias("_rank"))
    places = [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    return ranked.mapInArrow(place, T.StructType([*items.schema.fields, *places]))


def pieces(
    docs: DataFrame, path: str, capacity: int, end_id: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document its tokens and the end token, cut into pieces: start, length and CRC-32 of each."""
    vocabulary = Vocabulary(docs.sparkSession, path)

    @releasing
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocabulary.encoder()
        for batch in batches:
            for at, texts in row_slices(batch.column("text")):
                ids, first = encoder.encode(texts)
                ids = np.insert(ids, first[1:], end_id)
                first = first + np.arange(len(first))
                totals = np.diff(first)
                number = -(-totals // capacity)
                row = np.repeat(np.arange(len(totals)), number)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
                head = totals - (number - 1) * capacity
                start = np.where(piece > 0, head[row] + (piece - 1) * capacity, 0)
                length = np.where(piece > 0, capacity, head[row])
                little = memoryview(ids.astype("<u4").tobytes())
                begin = (first[row] + start) * 4
                sums = [zlib.crc32(little[a:b]) for a, b in zip(begin.tolist(), (begin + 4 * length).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").slice(at, len(texts)).take(pa.array(row)),
                        pa.array(piece.astype(np.int32)),
                        pa.array(start),
                        pa.array(length),
                        pa.array(sums, pa.int64()),
                    ],
                    [key, "piece", "start", "length", "ids_crc32"],
                )
        encoder.forget()

    schema = T.StructType(
        [
            T.StructField(key, docs.schema[key].dataType),
            T.StructField("piece", T.IntegerType()),
            *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32")),
        ]
    )
    return docs.selectExpr(f"`{key}` AS key", f"`{text}` AS text").mapInArrow(cut, schema)


def pack_documents(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, key: str = "doc_id") -> DataFrame:
    """The pieces of all documents with their places in sequences of ``capacity`` tokens."""
    return pack(stored(pieces(docs, path, capacity, end_id, key)), capacity, [key, "piece", "length", "ids_crc32"])
