"""Vectorised views of many texts at once: bytes, words, and 64-bit hashes of byte spans.

Texts are taken from Arrow columns as UTF-8 bytes. Hashes are functions of the bytes alone, so
they agree between tasks, executors and runs.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache, wraps
from inspect import isgeneratorfunction, signature

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PAD = 8
SLICE_BYTES = 1 << 20
_U = np.uint64
_M1, _M2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.ones(256, dtype=bool)
_IN_WORD[[0x20, *range(0x09, 0x0E)]] = False


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], int] | None:
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def release_memory() -> None:
    """Gives freed memory back to the system; else a reused Python worker keeps its largest task's."""
    pa.default_memory_pool().release_unused()
    trim = _trim()
    if trim:
        trim(0)


def releasing(function: Callable) -> Callable:
    """``function`` over batches or groups, after which the worker gives its freed memory back."""

    @wraps(function)
    def over_batches(batches):
        try:
            yield from function(batches)
        finally:
            release_memory()

    @wraps(function)
    def over_group(table):
        try:
            return function(table)
        finally:
            release_memory()

    @wraps(function)
    def over_two_groups(left, right):
        try:
            return function(left, right)
        finally:
            release_memory()

    if isgeneratorfunction(function):
        return over_batches
    # Spark looks at the number of arguments.
    return over_group if len(signature(function).parameters) == 1 else over_two_groups


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    values = (values ^ (values >> _U(30))) * _M1
    values = (values ^ (values >> _U(27))) * _M2
    return values ^ (values >> _U(31))


def combine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Order-dependent hash of two hashes."""
    return mix(left * _U(0x9E3779B97F4A7C15) + right)


@dataclass(frozen=True)
class Texts:
    """Consecutive rows of a column: ``data`` ends in padding, row i is ``data[offsets[i]:offsets[i+1]]``."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @property
    def size(self) -> int:
        return int(self.offsets[-1])

    def row(self, i: int) -> np.ndarray:
        return self.data[self.offsets[i] : self.offsets[i + 1]]


def texts_of(column: pa.Array | pa.ChunkedArray) -> Texts:
    """The rows of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    binary = column.cast(pa.large_binary()).fill_null(b"")
    if not len(binary):
        return Texts(np.zeros(PAD, np.uint8), np.zeros(1, np.int64))
    _, ends, data = binary.buffers()
    offsets = np.frombuffer(ends, np.int64)[binary.offset : binary.offset + len(binary) + 1]
    body = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return Texts(np.concatenate([body, np.zeros(PAD, np.uint8)]), offsets - offsets[0])


def texts_from(values: list[bytes]) -> Texts:
    return texts_of(pa.array(values, pa.large_binary()))


def row_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, Texts]]:
    """First row and texts of runs of rows with about ``limit`` bytes; a longer row stands alone."""
    sizes = column.cast(pa.large_binary()).fill_null(b"")
    lengths = pc.binary_length(sizes).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    first = 0
    while first < len(column):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield first, texts_of(sizes.slice(first, last - first))
        first = last


def words_at(data: np.ndarray) -> np.ndarray:
    """The little-endian 64-bit word that starts at each byte, as a view."""
    return np.ndarray(shape=(len(data) - PAD + 1,), dtype="<u8", buffer=data, strides=(1,))


def span_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of ``data[start:start + length]`` for many spans of any length."""
    load = words_at(data)
    hashes = mix(lengths.astype(np.uint64) + _U(seed + 1))
    block, active = 0, np.flatnonzero(lengths > 0)
    while len(active):
        left = lengths[active] - block
        hashes[active] = mix(hashes[active] ^ (load[starts[active] + block] & _KEEP[np.minimum(left, 8)]))
        block += 8
        active = active[left > 8]
    return hashes


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A copy with A-Z lower-cased."""
    return _LOWER[data]


@dataclass(frozen=True)
class Words:
    """The words of all rows: row i has the words ``first[i]`` to ``first[i + 1]``."""

    hashes: np.ndarray
    first: np.ndarray

    def count(self) -> np.ndarray:
        return np.diff(self.first)


def words_of(texts: Texts, lower: bool = True) -> tuple[Words, np.ndarray, np.ndarray]:
    """Hashes, starts and lengths of the runs of bytes outside ``[\\x20\\x09-\\x0D]``, lower-cased A-Z."""
    data = lower_ascii(texts.data) if lower else texts.data
    size = texts.size
    edges = np.zeros(size + 1, dtype=np.int8)
    inside = _IN_WORD[data[:size]]
    edges[1:size] = inside[1:].view(np.int8) - inside[:-1].view(np.int8)
    if size:
        edges[0], edges[size] = inside[0], -int(inside[-1])
    cuts = texts.offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < size)]
    cuts = cuts[inside[cuts] & inside[cuts - 1]]
    begins, stops = edges == 1, edges == -1
    begins[cuts] = stops[cuts] = True
    starts = np.flatnonzero(begins)
    lengths = np.flatnonzero(stops) - starts
    first = np.searchsorted(starts, texts.offsets)
    return Words(span_hashes(data, starts, lengths), first), starts, lengths


def row_of(first: np.ndarray) -> np.ndarray:
    """The row of each item when row i has the items ``first[i]`` to ``first[i + 1]``."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices ``starts[i], starts[i] + 1, ...`` of ``counts[i]`` items each, one after the other."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)


def signed(values: np.ndarray) -> np.ndarray:
    """Unsigned hashes as the signed 64-bit integers that Spark stores."""
    return values.astype(np.uint64, copy=False).view(np.int64)
