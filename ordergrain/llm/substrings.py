"""Removal of repeated byte strings with suffix arrays.

A byte goes when it is covered by a string of ``length`` bytes that also starts anywhere else,
judged on the input. A position whose string is repeated is called a repeated start.

1. Each string is assigned to its anchor: of the grams (``length`` / 12.5 bytes) in it the one with the smallest
   hash, the last of equal ones. Equal strings have equal anchors at equal places. Consecutive
   starts with one anchor and the bytes that they reach form a span (about 185 starts of 400 bytes).
2. A span whose anchor occurs once has no repeated start and is left out. Equal spans are one from here on. In a
   span that occurs twice every start is repeated. Only the spans that share an
   anchor with different spans need their bytes, one copy each.
3. Those are cut into blocks of two grams aligned at the anchor, and a suffix array of the blocks
   is built by linear grouping (``suffixes``). Neighbours in it that agree in as many blocks as every
   string holds in full form classes; within a class the few bytes of a string before and after its
   full blocks decide.

Spans meet by anchor. An anchor with over ``MOST_SPANS`` different spans (a passage in front of very
many different texts) is not given to one task: its strings are counted one by one by hash, as rows.

Defined results: null and empty texts and texts shorter than ``length`` lose nothing; texts of any
length are handled whole, in slices; repeated rows are texts that repeat each other; rows with null
or repeated ids are told apart by their text; an empty table gives an empty table; columns named
like a result are replaced by it. Spans are compared by 64-bit hash.
"""

from __future__ import annotations

import gc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordergrain.llm.storage import settled, stored
from ordergrain.llm.suffixes import suffix_array
from ordergrain.llm.textbytes import (
    Texts, combine, mix, ragged, releasing, row_of, row_slices, signed, span_hashes, texts_of, words_at,
)

LENGTH = 400
MOST_SPANS = 20_000
GROUP_SPANS = 2_000
LONGEST = 4 << 20  # starts handled at once; a position fits into the low bits of a window's value
_PLACE = np.uint64((1 << 24) - 1)


def _gram(length: int) -> int:
    """Bytes of a gram, in whole words; a block is twice as long."""
    return max(8, length * 2 // 25 // 8 * 8)


def _anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchor of every string of ``length`` bytes in ``data`` (padded), and the hash of every gram."""
    gram = _gram(length)
    number = len(data) - 8 - gram + 1
    load = mix(words_at(data))
    grams = load[:number].copy()
    for k in range(8, gram, 8):
        grams *= np.uint64(0x9E3779B97F4A7C15)
        grams += load[k : k + number]
    grams = mix(grams)
    ranked = (grams & ~_PLACE) | (_PLACE - np.arange(number, dtype=np.uint64))
    width = length - gram + 1
    cut = np.concatenate([ranked, np.full(-number % width, 2**64 - 1, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(cut, axis=1).reshape(-1)
    back = np.minimum.accumulate(cut[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    least = np.minimum(back[: number - width + 1], ahead[width - 1 : number])
    return (_PLACE - (least & _PLACE)).astype(np.int64), grams


def spans_of(texts: Texts, length: int) -> dict[str, np.ndarray]:
    """The spans of all rows: row, anchor hash, span hash, first start, number of starts, anchor's place in it."""
    parts = []
    for low in range(0, max(texts.size, 1), LONGEST):
        high = min(texts.size, low + LONGEST + length - 1)
        if high - low < length:
            continue
        data = np.concatenate([texts.data[low:high], np.zeros(8, np.uint8)])
        anchors, grams = _anchors(data, length)
        starts = np.arange(low, low + len(anchors))
        row = np.searchsorted(texts.offsets, starts, "right") - 1
        whole = starts + length <= texts.offsets[row + 1]
        mark = np.where(whole, anchors, -1)
        edges = np.flatnonzero(np.concatenate([[True], (mark[1:] != mark[:-1]) | (row[1:] != row[:-1]), [True]]))
        first, number = edges[:-1], np.diff(edges)
        used = mark[first] >= 0
        first, number = first[used], number[used]
        anchor = anchors[first]
        place = anchor - first
        key = grams[anchor]
        body = span_hashes(data, first, number + length - 1)
        span = combine(combine(key, place.astype(np.uint64)), body)
        parts.append((row[first], key, span, first + low - texts.offsets[row[first]], number, place))
    columns = [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 6
    return dict(zip(("row", "key", "span", "first", "number", "place"), columns))


def repeated_starts(spans: Texts, number: np.ndarray, place: np.ndarray, length: int) -> np.ndarray:
    """For each start of each span, one after the other, whether its string starts elsewhere in the spans."""
    wide = 2 * _gram(length)
    blocks = (length - wide + 1) // wide  # full blocks that every string holds
    shift = place % wide
    sizes = np.diff(spans.offsets)
    counts = np.maximum(sizes - shift, 0) // wide
    row = np.repeat(np.arange(len(sizes)), counts)
    turn = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = spans.offsets[row] + shift[row] + turn * wide
    _, symbol = np.unique(span_hashes(spans.data, at, np.full(len(at), wide)), return_inverse=True)
    # One sequence with a different smallest symbol after every span.
    places = np.arange(len(row)) + row
    sequence = np.full(len(row) + len(sizes), -1, dtype=np.int64)
    sequence[places] = symbol + len(sizes)
    sequence[sequence < 0] = np.arange(len(sizes))
    collecting = gc.isenabled()
    gc.disable()  # only lists of numbers are made, which cannot form cycles
    try:
        order = suffix_array(sequence)
    finally:
        if collecting:
            gc.enable()
    padded = np.concatenate([sequence, -1 - np.arange(blocks)])
    equal = np.ones(len(order) - 1, dtype=bool) if len(order) else np.zeros(0, bool)
    for k in range(blocks):
        equal &= padded[order[1:] + k] == padded[order[:-1] + k]
    classes = np.concatenate([[0], np.cumsum(~equal)]) if len(order) else np.zeros(0, np.int64)
    class_of = np.empty(len(order), dtype=np.int64)
    class_of[order] = classes
    shared = np.bincount(classes, minlength=1)[class_of] > 1

    total = int(number.sum())
    owner = np.repeat(np.arange(len(number)), number)
    start = np.arange(total) - np.repeat(np.cumsum(number) - number, number)
    lead = (shift[owner] - start) % wide
    begin = np.concatenate([[0], np.cumsum(counts + 1)])[:-1]
    block = begin[owner] + (start + lead - shift[owner]) // wide
    open_ = np.flatnonzero(shared[block])
    here = spans.offsets[owner[open_]] + start[open_]
    lead, block = lead[open_], block[open_]
    tail = length - blocks * wide - lead
    head_hash = span_hashes(spans.data, here, lead)
    tail_hash = span_hashes(spans.data, here + lead + blocks * wide, tail)
    whole = combine(combine(head_hash, tail_hash), (class_of[block] * wide + lead).astype(np.uint64))
    _, which, times = np.unique(whole, return_inverse=True, return_counts=True)
    found = np.zeros(total, dtype=bool)
    found[open_] = times[which] > 1
    return found


def _runs(flags: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Span, first and last start of the runs of flagged starts."""
    owner = np.repeat(np.arange(len(number)), number)
    start = np.arange(len(flags)) - np.repeat(np.cumsum(number) - number, number)
    hit = np.flatnonzero(flags)
    new = np.ones(len(hit) + 1, dtype=bool)
    new[1:-1] = (hit[1:] != hit[:-1] + 1) | (owner[hit[1:]] != owner[hit[:-1]])
    edges = np.flatnonzero(new)
    return owner[hit[edges[:-1]]], start[hit[edges[:-1]]], start[hit[edges[1:] - 1]]


def repeated_spans(docs: DataFrame, length: int = LENGTH, most_spans: int = MOST_SPANS) -> DataFrame:
    """Byte ranges (row, first, last + 1) covered by repeated strings; ``docs`` has row and text.

    Ranges of a row may overlap. ``row`` is a number that tells texts apart.
    """

    @releasing
    def scan(batches):
        for batch in batches:
            for at, texts in row_slices(batch.column("text")):
                found = spans_of(texts, length)
                rows = batch.column("row").slice(at, len(texts)).take(pa.array(found["row"]))
                numbers = [pa.array(found[c].astype(np.int32)) for c in ("first", "number", "place")]
                hashes = [pa.array(signed(found[c])) for c in ("key", "span")]
                yield pa.RecordBatch.from_arrays([rows, *hashes, *numbers], ["row", "key", "span", "first", "number", "place"])

    def met() -> DataFrame:
        """The spans whose anchor occurs more than once; no start of the others is repeated."""
        all_spans = stored(
            docs.select("row", "text").mapInArrow(scan, "row long, key long, span long, first int, number int, place int")
        )
        anchors = stored(all_spans.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"))
        return all_spans.join(anchors, "key")

    spans = settled(docs.sparkSession, met)
    distinct = stored(
        spans.groupBy("key", "span").agg(
            F.count("*").alias("times"),
            F.first("number").alias("number"),
            F.first("place").alias("place"),
            F.min(F.struct("row", "first")).alias("at"),
        )
    )
    sizes = distinct.groupBy("key").agg(F.count("*").alias("spans")).where("spans > 1")
    open_ = distinct.join(sizes, "key").select("key", "span", "times", "number", "place", "at.row", "at.first", "spans")
    open_ = stored(open_)

    # The bytes of one copy of every span that has to be looked at.
    wanted = open_.groupBy("row").agg(F.collect_list(F.struct("key", "span", "times", "number", "place", "first", "spans")).alias("list"))
    held = wanted.join(docs.select("row", "text"), "row").select("row", "list", "text")
    names = ["key", "span", "times", "number", "place", "first", "spans"]

    @releasing
    def take(batches):
        for batch in batches:
            for at, texts in row_slices(batch.column("text")):
                lists = batch.column("list").slice(at, len(texts))
                flat = pa.RecordBatch.from_struct_array(lists.flatten())
                owner = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy())
                first, number = flat.column("first").to_numpy().astype(np.int64), flat.column("number").to_numpy()
                sizes_ = number.astype(np.int64) + length - 1
                body = texts.data[ragged(texts.offsets[owner] + first, sizes_)]
                ends = np.concatenate([[0], np.cumsum(sizes_)])
                for a in range(0, len(sizes_), 4096):  # offsets of a binary column are 32-bit
                    b = min(a + 4096, len(sizes_))
                    offsets = pa.py_buffer((ends[a : b + 1] - ends[a]).astype(np.int32).tobytes())
                    data = pa.py_buffer(body[ends[a] : ends[b]].tobytes())
                    rows = batch.column("row").slice(at, len(texts)).take(pa.array(owner[a:b]))
                    part = flat.slice(a, b - a)
                    yield pa.RecordBatch.from_arrays(
                        [rows, *(part.column(c) for c in names), pa.Array.from_buffers(pa.binary(), b - a, [None, offsets, data])],
                        ["row", *names, "body"],
                    )

    kinds = "row long, key long, span long, times long, number int, place int, first int, spans long, body binary"
    bodies = stored(held.mapInArrow(take, kinds))
    few, many = bodies.where(F.col("spans") <= most_spans), bodies.where(F.col("spans") > most_spans)

    @releasing
    def compare(table: pa.Table) -> pa.Table:
        spans = texts_of(table.column("body"))
        number, place = (table.column(c).to_numpy().astype(np.int64) for c in ("number", "place"))
        key, times = table.column("span").to_numpy(), table.column("times").to_numpy()
        # A repeated row can deliver the same span twice: it is compared once.
        _, once = np.unique(key, return_index=True)
        once.sort()
        kept = texts_of(table.column("body").take(pa.array(once))) if len(once) < len(key) else spans
        flags = repeated_starts(kept, number[once], place[once], length)
        owner, first, last = _runs(flags, number[once])
        single = times[once][owner] == 1
        owner, first, last = once[owner[single]], first[single], last[single]
        at = table.column("first").to_numpy()[owner].astype(np.int64)
        rows = table.column("row").to_numpy()[owner]
        return pa.Table.from_arrays([pa.array(rows), pa.array(at + first), pa.array(at + last + length)], ["row", "begin", "end"])

    groups = F.pmod(F.xxhash64("key"), F.lit(few.count() // GROUP_SPANS + 1)).alias("g")
    compared = few.select("*", groups).groupBy("g").applyInArrow(compare, "row long, begin long, end long")

    @releasing
    def strings(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = texts_of(part.column("body"))
                number = part.column("number").to_numpy().astype(np.int64)
                owner = np.repeat(np.arange(len(number)), number)
                start = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
                hashes = span_hashes(texts.data, texts.offsets[owner] + start, np.full(len(owner), length))
                rows = [part.column(c).take(pa.array(owner)) for c in ("row", "span", "times", "first")]
                yield pa.RecordBatch.from_arrays([*rows, pa.array(start), pa.array(signed(hashes))], ["row", "span", "times", "first", "start", "string"])

    single = many.mapInArrow(strings, "row long, span long, times long, first int, start long, string long")
    counted = single.groupBy("string").agg(F.count_distinct("span", "start").alias("n")).where("n > 1").select("string")
    loose = single.where("times = 1").join(counted, "string").select(
        "row", (F.col("first") + F.col("start")).alias("begin"), (F.col("first") + F.col("start") + length).alias("end")
    )
    copies = distinct.where("times > 1").select("key", "span")
    full = spans.join(copies, ["key", "span"]).select(
        "row", F.col("first").cast("long").alias("begin"), (F.col("first") + F.col("number") - 1 + length).cast("long").alias("end")
    )
    return full.unionAll(compared).unionAll(loose)


def remove_repeated(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, as_text: bool = False
) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans (maximal removed runs) and kept (the remaining bytes).

    With ``as_text`` kept is a string; characters that lost some of their bytes are dropped.
    """
    results = ("n_bytes", "n_removed", "n_spans", "kept")
    fields = [f for f in docs.schema.fields if f.name not in results]
    row = F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`"))
    named = docs.select(*(F.col(f"`{f.name}`").alias(f"c{k}") for k, f in enumerate(fields)), row.alias("row"), F.col(f"`{text}`").alias("text"))
    ranges = settled(
        docs.sparkSession,
        lambda: repeated_spans(named, length).groupBy("row").agg(F.collect_set(F.struct("begin", "end")).alias("ranges")),
    )
    both = named.join(ranges, "row", "left").drop("row")

    @releasing
    def cut(batches):
        for batch in batches:
            for at, texts in row_slices(batch.column("text")):
                part = batch.slice(at, len(texts))
                lists = part.column("ranges")
                flat = pa.RecordBatch.from_struct_array(lists.flatten()) if len(lists.flatten()) else None
                change = np.zeros(texts.size + 1, dtype=np.int32)
                if flat is not None:
                    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
                    base = texts.offsets[np.repeat(np.arange(len(texts)), counts)]
                    np.add.at(change, base + flat.column("begin").to_numpy(), 1)
                    np.add.at(change, base + flat.column("end").to_numpy(), -1)
                gone = np.cumsum(change[:-1]) > 0
                sums = np.concatenate([[0], np.cumsum(gone)])
                removed = sums[texts.offsets[1:]] - sums[texts.offsets[:-1]]
                begins = gone.copy()
                begins[1:] &= ~gone[:-1]
                inner = texts.offsets[:-1][np.diff(texts.offsets) > 0]
                begins[inner] = gone[inner]
                sums = np.concatenate([[0], np.cumsum(begins)])
                runs = sums[texts.offsets[1:]] - sums[texts.offsets[:-1]]
                kept = texts.data[: texts.size][~gone]
                sizes = np.diff(texts.offsets)
                ends = np.concatenate([[0], np.cumsum(sizes - removed)]).astype(np.int32)
                left = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(kept.tobytes())])
                if as_text:
                    left = pa.array([x.decode("utf-8", "ignore") for x in left.to_pylist()], pa.string())
                columns = [part.column(f"c{k}") for k in range(len(fields))]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(sizes), pa.array(removed), pa.array(runs), left],
                    [*(f"c{k}" for k in range(len(fields))), *results],
                )

    schema = T.StructType(
        [
            *(T.StructField(f"c{k}", f.dataType) for k, f in enumerate(fields)),
            *(T.StructField(c, T.LongType()) for c in results[:3]),
            T.StructField("kept", T.StringType() if as_text else T.BinaryType()),
        ]
    )
    return both.mapInArrow(cut, schema).toDF(*(f.name for f in fields), *results)
