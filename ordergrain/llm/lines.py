"""Removal of repeated runs of lines, found by winnowing.

Lines with a character other than white space count; the others are kept as they are and ignored.
A run of ``window`` counting lines is deleted when the same lines stand earlier in the corpus, in
the order of document id and line; longer repeats are deleted whole, as they consist of such runs.
With ``alone`` a line of at least that many characters is a run by itself, whatever its neighbours.

Winnowing over line hashes: of every ``window`` neighbouring lines the one with the least hash (of
equal ones the last) is the fingerprint, so two equal runs have the same line as theirs. Only
fingerprints are stored, about 2 of ``window`` + 1 lines, with the lines next to them as far as
their windows reach. Positions whose fingerprint is found once go. The others are joined with the first
position that has the same fingerprint in the same run, and each match is extended line by line
both ways; the later side is deleted. The first position is a minimum by run, so a passage that is
in every document costs one row a position, and no pairs are made.

Defined results: a null text stays null and an empty one empty; texts of any length are handled
whole; rows that are equal in id and text count as one and keep or lose the same lines; different texts
with one id are documents of their own; a null id comes before all others; an empty table gives an
empty table; other columns are kept, except that ``n_lines`` and ``n_removed`` are replaced. Lines
are compared by 64-bit hash, rows told apart by id and two 64-bit hashes.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordergrain.llm.storage import settled, stored
from ordergrain.llm.textbytes import releasing

WINDOW = 2
COUNTING = r"[^\x09-\x0D\x20]"


def text_row(key: str, text: str) -> Column:
    """Two hashes of a row's id and text, 128 bits together."""
    key, text = f"`{key}`", f"`{text}`"
    return F.struct(F.xxhash64(key, text).alias("a"), F.xxhash64(text, key).alias("b"))


def _counts(line: str) -> bool:
    return bool(line.strip(" \t\n\x0b\f\r"))


def _equal_lines(other: str, compare: str, window: int, k: int = 1) -> str:
    """SQL: how many lines next to line i of h, one by one and ``window`` - 1 at most, have a hash that compares so."""
    if k >= window:
        return "0"
    return f"IF(get(h, i {other} {k}).h {compare} h[i].h, 1 + {_equal_lines(other, compare, window, k + 1)}, 0)"


def fingerprints(docs: DataFrame, window: int = WINDOW, alone: int | None = None) -> DataFrame:
    """The winnowed lines of the texts: id, row, line, print, long, and the lines before and after in their windows.

    ``docs`` has id, row (a value that tells texts of an id apart) and text; ``line`` numbers the counting
    lines from 0. Lines that are runs by themselves are there too, marked ``long``.
    """
    long = "false" if alone is None or window == 1 else f"char_length(x) >= {alone}"
    hashed = docs.where("text IS NOT NULL").select(
        "id",
        "row",
        F.expr(
            f"transform(filter(split(text, '\\n', -1), x -> x RLIKE r'{COUNTING}'),"
            f" x -> named_struct('h', xxhash64(x), 'long', {long}))"
        ).alias("h"),
    )
    reach = (
        "transform(h, (x, i) -> named_struct('i', i, 'x', x,"
        f" 'back', {_equal_lines('-', '>=', window)}, 'ahead', {_equal_lines('+', '>', window)}))"
    )
    chosen = f"filter({reach}, r -> r.back + r.ahead >= {window - 1} OR r.x.long)"
    found = (
        f"transform({chosen}, r -> named_struct('line', CAST(r.i AS bigint), 'print', r.x.h, 'long', r.x.long,"
        " 'before', reverse(slice(h, r.i - r.back + 1, r.back).h), 'after', slice(h, r.i + 2, r.ahead).h))"
    )
    return hashed.select("id", "row", F.inline(F.expr(found)))


def _shared(here: str, there: str) -> str:
    """SQL: the number of leading elements in which two arrays agree."""
    return (
        f"aggregate(zip_with({here}, {there}, (x, y) -> coalesce(x = y, false)), named_struct('n', 0L, 'on', true),"
        " (s, e) -> named_struct('n', IF(s.on AND e, s.n + 1L, s.n), 'on', s.on AND e), s -> s.n)"
    )


def repeated_runs(docs: DataFrame, window: int = WINDOW, alone: int | None = None) -> DataFrame:
    """Deleted runs: id, row, the number (from 0) of the first line of each among the counting lines, and its lines.

    ``docs`` has id, row (a value that tells texts of an id apart) and text.
    """
    prints = stored(fingerprints(docs, window, alone))
    # Both sides of a join are stored tables: only then is a hot print split among tasks.
    repeated = stored(prints.groupBy("print").agg(F.count("*").alias("n")).where("n > 1").select("print"))
    # A window is named by the lines of it that come before the fingerprint and all its other lines.
    windows = (
        f"transform(filter(sequence(0, {window - 1}), o -> o <= size(before) AND {window - 1} - o <= size(after)),"
        f" o -> named_struct('lead', o, 'others', concat(slice(before, 1, o), slice(after, 1, {window - 1} - o))))"
    )
    single = "IF(long, array(named_struct('lead', 0, 'others', CAST(array() AS array<bigint>))), array())"
    runs = prints.join(repeated, "print").withColumn("w", F.explode(F.expr(f"concat({windows}, {single})")))
    runs = runs.select("id", "row", "line", "print", "before", "after", "w.lead", "w.others")
    name = ["print", "lead", "others"]
    position = F.struct("id", "row", "line", "before", "after")
    firsts = runs.groupBy(*name).agg(F.min(position).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    firsts = stored(firsts)
    # Sorted joins whatever the size, so that shuffles grow with the input and do not set in where a broadcast ends.
    later = runs.join(firsts.hint("merge"), name).where(
        F.struct("id", "row", "line") > F.struct("first.id", "first.row", "first.line")
    )
    grown = later.select(
        "id", "row", "line", F.expr(_shared("before", "first.before")).alias("back"), F.expr(_shared("after", "first.after")).alias("ahead")
    )
    whole = F.col("back") + F.col("ahead") + 1 >= window
    return grown.select(
        "id",
        "row",
        F.when(whole, F.col("line") - F.col("back")).otherwise(F.col("line")).alias("line"),
        F.when(whole, F.col("back") + F.col("ahead") + 1).otherwise(1).alias("size"),
    ).distinct()


def remove_repeated_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, alone: int | None = None
) -> DataFrame:
    """``docs`` without later repeats of runs of lines, with n_lines (all lines before) and n_removed."""
    results = ("n_lines", "n_removed")
    fields = [f for f in docs.schema.fields if f.name not in results]
    id_, row = F.col(f"`{key}`").alias("id"), text_row(key, text).alias("row")
    plain = docs.select(id_, row, F.col(f"`{text}`").alias("text"))
    gone = settled(
        docs.sparkSession,
        lambda: repeated_runs(plain, window, alone).groupBy("id", "row").agg(F.collect_list(F.struct("line", "size")).alias("gone")),
    )
    gone = gone.select(F.col("id").alias("gone_id"), F.col("row").alias("gone_row"), "gone")
    named = docs.select(*(F.col(f"`{f.name}`").alias(f"c{k}") for k, f in enumerate(fields)), id_, row)
    place = f"c{[f.name for f in fields].index(text)}"

    @releasing
    def cut(batches):
        for batch in batches:
            kept, before, removed = [], [], []
            for value, starts in zip(batch.column(place).to_pylist(), batch.column("gone").to_pylist()):
                lines = [] if value is None else value.split("\n")
                before.append(len(lines))
                if not starts:
                    kept.append(value)
                    removed.append(0)
                    continue
                dead = {s["line"] + k for s in starts for k in range(s["size"])}
                left, turn = [], -1
                for line in lines:
                    turn += _counts(line)
                    if turn not in dead or not _counts(line):
                        left.append(line)
                kept.append("\n".join(left))
                removed.append(len(lines) - len(left))
            columns = [batch.column(f"c{k}") if f"c{k}" != place else pa.array(kept, pa.string()) for k in range(len(fields))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(before, pa.int64()), pa.array(removed, pa.int64())],
                [*(f"c{k}" for k in range(len(fields))), *results],
            )

    schema = T.StructType(
        [*(T.StructField(f"c{k}", f.dataType) for k, f in enumerate(fields)), *(T.StructField(c, T.LongType()) for c in results)]
    )
    same = F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("row") == F.col("gone_row"))
    both = named.join(gone.hint("merge"), same, "left").drop("id", "row", "gone_id", "gone_row")
    return both.mapInArrow(cut, schema).toDF(*(f.name for f in fields), *results)
