"""Fill-in-the-middle examples from texts, as one pipeline of Arrow kernels.

1. A text is split at its line feeds into a list of units (lines with their line feed). The lists of
   a batch are flattened; parent indices say which text a unit belongs to, ordinals which place it has.
2. Two cuts per text, drawn from a digest of its key, give every unit the role prefix, middle or suffix.
3. The units of a role are filtered, rebuilt into one list per text and joined; ``binary_join`` puts the
   joined pieces and their marks together. No text and no unit is handled by itself.

Four draws are the first 8-digit groups, as unsigned integers, of the hex SHA-256 of ``<seed>:<key>``.
With n units the cuts are the first two draws modulo n + 1, the smaller one first. A text is left plain if
it is empty, holds one of the marks, or its third draw modulo 100 reaches ``rate``. Otherwise it is ``spm``
(suffix, prefix, middle) where the fourth draw modulo 100 is below ``spm_share``, else ``psm``.

Since only texts without marks are cut, an output splits at its marks into exactly its pieces, which
:func:`restored` puts back in order.

Defined results: a null text is an empty one; a null key draws like an empty one; every row is handled by
itself, so repeated rows give repeated rows; pieces may be empty; a text of any length is handled whole, in
slices of rows with about ``SLICE_BYTES`` (a longer text stands alone); other columns are left out; an
empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordergrain.llm.textbytes import releasing

SEED, RATE, SPM_SHARE = 7, 100, 50
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SLICE_BYTES = 1 << 22
_LIST, _TEXT = pa.large_list(pa.large_string()), pa.large_string()


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``limit`` bytes of text, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(first, last - first)
        first = last


def units_of(texts: pa.LargeStringArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The units of all texts, with the text and the place in it that each has."""
    parts = pc.split_pattern(texts, "\n").cast(_LIST)
    parent = pc.list_parent_indices(parts)
    offsets = parts.offsets
    ordinal = pc.subtract(pa.array(np.arange(len(parent))), pc.take(offsets, parent))
    last = pc.equal(ordinal, pc.subtract(pc.take(pc.list_value_length(parts), parent), 1))
    units = pc.binary_join_element_wise(pc.list_flatten(parts), pc.if_else(last, "", "\n").cast(_TEXT), pa.scalar("", _TEXT))
    real = pc.greater(pc.binary_length(units), 0)  # nothing follows the last line feed
    return units.filter(real), parent.filter(real).to_numpy(), ordinal.filter(real).to_numpy()


def joined(units: pa.Array, parent: np.ndarray, chosen: np.ndarray, rows: int) -> pa.Array:
    """The chosen units of each of ``rows`` texts, joined."""
    counts = np.bincount(parent[chosen], minlength=rows)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), units.filter(pa.array(chosen)))
    return pc.binary_join(lists, pa.scalar("", _TEXT))


def transformed(texts: pa.Array, draws: list[np.ndarray], rate: int, spm_share: int) -> list[pa.Array]:
    """Number of units, form, code points of prefix and middle, and output, for each text."""
    texts, rows = texts.cast(_TEXT).fill_null(""), len(texts)
    units, parent, ordinal = units_of(texts)
    number = np.bincount(parent, minlength=rows)
    one, other = draws[0] % (number + 1), draws[1] % (number + 1)
    low, high = np.minimum(one, other)[parent], np.maximum(one, other)[parent]
    prefix = joined(units, parent, ordinal < low, rows)
    middle = joined(units, parent, (ordinal >= low) & (ordinal < high), rows)
    suffix = joined(units, parent, ordinal >= high, rows)

    marked = pc.match_substring(texts, PREFIX)
    for mark in (SUFFIX, MIDDLE):
        marked = pc.or_(marked, pc.match_substring(texts, mark))
    plain = pc.or_(marked, pa.array((number == 0) | (draws[2] % 100 >= rate)))
    spm = pa.array(draws[3] % 100 < spm_share)
    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))

    p, s, m, none = (pa.scalar(mark, _TEXT) for mark in (PREFIX, SUFFIX, MIDDLE, ""))
    as_psm = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, none)
    as_spm = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, none)
    output = pc.if_else(plain, texts, pc.if_else(spm, as_spm, as_psm))
    lengths = [pc.if_else(plain, pa.scalar(None, pa.int64()), pc.utf8_length(x).cast(pa.int64())) for x in (prefix, middle)]
    return [pa.array(number, pa.int64()), form.cast(pa.string()), *lengths, output]


def fill_in_middle(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    seed: int = SEED,
    rate: int = RATE,
    spm_share: int = SPM_SHARE,
) -> DataFrame:
    """Per row: key, n (units), form (plain, psm or spm), prefix_chars, middle_chars (null if plain), output."""
    name = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), name), 256)
    draws = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k}") for k in range(4)]
    rows = docs.select(F.col(f"`{key}`").alias("key"), *draws, F.col(f"`{text}`").alias("text"))

    @releasing
    def transform(batches):
        for batch in batches:
            for some in slices(batch, "text"):
                columns = transformed(some.column("text"), [some.column(f"h{k}").to_numpy() for k in range(4)], rate, spm_share)
                columns[-1] = columns[-1].cast(pa.string())
                yield pa.RecordBatch.from_arrays([some.column("key"), *columns], names)

    names = ["key", "n", "form", "prefix_chars", "middle_chars", "output"]
    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    return rows.mapInArrow(transform, schema).withColumnRenamed("key", key)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output was made of, from the output and its form alone."""
    pieces = F.split(F.col(f"`{output}`"), "|".join((PREFIX, SUFFIX, MIDDLE)), -1)
    order = {"psm": (1, 3, 2), "spm": (2, 3, 1)}
    whole = F.col(f"`{output}`")
    for shape, places in order.items():
        whole = F.when(F.col(f"`{form}`") == shape, F.concat(*(pieces[k] for k in places))).otherwise(whole)
    return whole
