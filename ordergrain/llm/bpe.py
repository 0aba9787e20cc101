"""Byte-level BPE encoding and decoding with a contiguous rank array per short word.

A word keeps its part boundaries and the merge ranks of adjacent parts in two contiguous arrays.
The smallest rank is searched by a scan, its boundary is deleted and the ranks on both sides are
refreshed, until no adjacent pair has a rank. Words of equal length stand in the rows of one
matrix, so a scan, a deletion and a refresh serve all of them at once. Words over ``SHORT`` bytes
use a heap over the same ranks, because repeated scans are quadratic.

Defined results: a null text is encoded as the empty text, an empty text has no tokens, texts of
any length are encoded whole, repeated rows are encoded each, other columns are kept as they are,
an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ordergrain.llm.textbytes import Texts, mix, ragged, releasing, row_slices, span_hashes, texts_from

SHORT = 64
CACHE_SLOTS = 1 << 20
CACHE_IDS = 1 << 22
LARGEST_FILE = 64 << 20
_NONE = np.int32(2**31 - 1)
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)

# The characters with the property White_Space, and the endings that the split
# pattern of byte-level BPE takes together with an apostrophe.
WHITE_SPACE = {
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005,
    0x2006, 0x2007, 0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
}
ENDINGS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")


def character_class(code: int) -> int:
    if code in WHITE_SPACE:
        return _SPACE
    return {"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(chr(code))[0], _OTHER)


@lru_cache(maxsize=1 << 16)
def _cached_class(code: int) -> int:
    return character_class(code)


_ASCII = np.array([character_class(c) if c < 128 else _OTHER for c in range(256)], dtype=np.uint8)


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def classes(data: np.ndarray, size: int) -> np.ndarray:
    """The character class at every byte; all bytes of a character have its class."""
    found = _ASCII[data[:size]]
    lead = np.flatnonzero(data[:size] >= 0xC0)
    if len(lead):
        first = data[lead].astype(np.int32)
        extra = 1 + (first >= 0xE0) + (first >= 0xF0)
        codes = first & (0x3F >> extra)
        for k in (1, 2, 3):
            more = extra >= k
            codes[more] = (codes[more] << 6) | (data[lead[more] + k] & 0x3F)
        distinct, which = np.unique(codes, return_inverse=True)
        kinds = np.array([_cached_class(int(c)) for c in distinct], dtype=np.uint8)[which]
        for k in range(4):
            more = extra >= k
            found[lead[more] + k] = kinds[more]
    return found


def word_starts(texts: Texts, cuts: np.ndarray) -> np.ndarray:
    """Where the words of the byte-level split pattern start. ``cuts``: positions no word crosses."""
    data, size = texts.data, texts.size
    if not size:
        return np.zeros(0, np.int64)
    kind = classes(data, size)
    starts = np.empty(size + 1, dtype=bool)
    starts[0] = starts[size] = True
    np.not_equal(kind[1:], kind[:-1], out=starts[1:size])
    starts[cuts] = True
    runs = np.flatnonzero(starts)
    hard = np.zeros(size + 1, dtype=bool)
    hard[cuts] = hard[0] = hard[size] = True

    # The last white space before other characters joins them if it is a blank, else stands alone.
    begin, end = runs[:-1], runs[1:]
    spaces = (kind[begin] == _SPACE) & ~hard[end]
    begin, end = begin[spaces], end[spaces]
    last = end - 1
    while len(late := np.flatnonzero((data[last] & 0xC0) == 0x80)):
        last[late] -= 1
    starts[last] = True
    blank = data[last] == 0x20
    starts[end[blank]] = False

    # An apostrophe takes one of the fixed endings with it unless a blank precedes it.
    marks = np.flatnonzero(data[: size - 1] == 0x27)
    marks = marks[starts[marks] & starts[marks + 1] & ~hard[marks + 1]]
    for ending in ENDINGS:
        n = len(ending)
        fits = marks[marks + n < size] if n < size else marks[:0]
        for k, byte in enumerate(ending):
            fits = fits[data[fits + 1 + k] == byte]
        for k in range(1, n):
            fits = fits[~hard[fits + 1 + k]]
        starts[fits + 1] = False
        starts[fits + 1 + n] = True
        marks = np.setdiff1d(marks, fits, assume_unique=True)
    return np.flatnonzero(starts[:size])


def _slot(keys: np.ndarray, size: int) -> np.ndarray:
    shift = np.uint64(65 - size.bit_length())
    return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> shift).astype(np.int64)


class Encoder:
    """One vocabulary: pair ranks as sorted arrays, token bytes as one pool."""

    def __init__(self, source: bytes) -> None:
        spec = json.loads(source)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        plain = model["type"] == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
        odd = [model.get(k) for k in ("continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")]
        added = spec["added_tokens"]
        if not plain or any(odd) or spec["normalizer"] or any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in added):
            raise ValueError("Only plain byte-level BPE files are supported")
        alphabet, vocab = byte_alphabet(), model["vocab"]
        spelled = {i: bytes(alphabet[c] for c in token) for token, i in vocab.items()}
        self.added = {a["content"].encode(): a["id"] for a in added}
        spelled |= {i: text for text, i in self.added.items()}
        sizes = np.array([len(spelled.get(i, b"")) for i in range(max(spelled) + 1)], dtype=np.int64)
        self.token_size, self.token_start = sizes, np.cumsum(sizes) - sizes
        self.token_bytes = np.frombuffer(b"".join(spelled.get(i, b"") for i in range(len(sizes))), np.uint8)
        self.byte_id = np.zeros(256, dtype=np.int32)
        for char, byte in alphabet.items():
            self.byte_id[byte] = vocab[char]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in merges], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        keep = np.concatenate([[True], keys[order][1:] != keys[order][:-1]]) if len(keys) else np.zeros(0, bool)
        self.pair_keys, self.pair_ranks = keys[order][keep], order[keep].astype(np.int32)
        self._fill_slots()
        every = np.repeat(self.byte_id, 256), np.tile(self.byte_id, 256)
        self._byte_rank = self.ranks(*every)
        self.merged = np.array([vocab[a + b] for a, b in merges], dtype=np.int32)
        self._specials = re.compile(b"|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.forget()

    def forget(self) -> None:
        """Empties the cache of encoded words."""
        self._keys = np.zeros(CACHE_SLOTS, dtype=np.uint64)
        self._place = np.zeros((CACHE_SLOTS, 2), dtype=np.int32)
        self._pool, self._used = np.zeros(1 << 16, dtype=np.int32), 0

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge ranks of pairs of tokens, ``_NONE`` where the pair is never merged."""
        keys = (left.astype(np.int64) << 32) | right
        slots = _slot(keys, len(self._slot_key))
        found = self._slot_rank[slots]
        seen = self._slot_key[slots]
        open_ = np.flatnonzero((seen != keys) & (seen != -1))
        found[seen != keys] = _NONE
        while len(open_):
            slots[open_] = (slots[open_] + 1) & (len(self._slot_key) - 1)
            seen = self._slot_key[slots[open_]]
            hit = seen == keys[open_]
            found[open_[hit]] = self._slot_rank[slots[open_[hit]]]
            open_ = open_[~hit & (seen != -1)]
        return found

    def _fill_slots(self) -> None:
        """A table with open addressing over the pair keys, at most an eighth full."""
        size = 1 << max(4, (8 * len(self.pair_keys) - 1).bit_length())
        self._slot_key, self._slot_rank = np.full(size, -1, np.int64), np.full(size, _NONE, np.int32)
        left, slots = np.arange(len(self.pair_keys)), _slot(self.pair_keys, size)
        while len(left):
            free = left[self._slot_key[slots[left]] == -1]
            self._slot_key[slots[free]] = self.pair_keys[free]
            self._slot_rank[slots[free]] = self.pair_ranks[free]
            left = left[self._slot_key[slots[left]] != self.pair_keys[left]]
            slots[left] = (slots[left] + 1) & (size - 1)

    def encode_equal(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of the rows of a byte matrix: flat, row after row, and the number in each row."""
        rows, width = words.shape
        tokens = np.zeros((rows, width), dtype=np.int32)
        counts = np.ones(rows, dtype=np.int64)
        parts, row = self.byte_id[words], np.arange(rows)
        rank = self._byte_rank[(words[:, :-1].astype(np.int32) << 8) | words[:, 1:]]
        while len(row):
            n = parts.shape[1]
            here = np.arange(len(row))
            best = rank.argmin(axis=1) if n > 1 else np.zeros(len(row), np.int64)
            low = rank[here, best] if n > 1 else np.full(len(row), _NONE)
            done = low == _NONE
            tokens[row[done], :n], counts[row[done]] = parts[done], n
            going = ~done
            parts, rank, row, best, low = parts[going], rank[going], row[going], best[going], low[going]
            if not len(row):
                break
            here = np.arange(len(row))
            parts[here, best] = self.merged[low]
            column = np.arange(n - 1)
            parts = np.take_along_axis(parts, column + (column > best[:, None]), axis=1)
            column = np.arange(n - 2)
            rank = np.take_along_axis(rank, column + (column >= best[:, None]), axis=1)
            left = here[best > 0]
            rank[left, best[left] - 1] = self.ranks(parts[left, best[left] - 1], parts[left, best[left]])
            right = here[best < n - 2]
            rank[right, best[right]] = self.ranks(parts[right, best[right]], parts[right, best[right] + 1])
        return tokens[np.arange(width) < counts[:, None]], counts

    def encode_long(self, word: np.ndarray) -> list[int]:
        """Tokens of one long word: the same merges, found with a heap over linked parts."""
        parts = self.byte_id[word].tolist()
        n = len(parts)
        ranks = self.ranks(np.array(parts[:-1]), np.array(parts[1:])).tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i, r in enumerate(ranks) if r != _NONE]
        heapq.heapify(heap)
        ranks.append(int(_NONE))
        rank_of = dict(zip(self.pair_keys.tolist(), self.pair_ranks.tolist())) if heap else {}
        while heap:
            r, i = heapq.heappop(heap)
            if ranks[i] != r:
                continue
            j = after[i]
            parts[i], after[i], ranks[j] = int(self.merged[r]), after[j], -1
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0:
                    ranks[k] = rank_of.get((parts[k] << 32) | parts[after[k]], int(_NONE)) if after[k] < n else int(_NONE)
                    if ranks[k] != _NONE:
                        heapq.heappush(heap, (ranks[k], k))
        found, i = [], 0
        while i < n:
            found.append(parts[i])
            i = after[i]
        return found

    def _encode_words(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of distinct words, flat, and the number of each."""
        counts = np.zeros(len(starts), dtype=np.int64)
        which, pieces = [], []
        for size in np.unique(np.minimum(sizes, SHORT + 1)):
            if size <= SHORT:
                rows = np.flatnonzero(sizes == size)
                flat, counts[rows] = self.encode_equal(data[starts[rows][:, None] + np.arange(size)])
                which.append(rows)
                pieces.append(flat)
            else:
                for row in np.flatnonzero(sizes > SHORT):
                    ids = self.encode_long(data[starts[row] : starts[row] + sizes[row]])
                    counts[row] = len(ids)
                    which.append(np.array([row]))
                    pieces.append(np.array(ids, dtype=np.int32))
        ends = np.cumsum(counts)
        out = np.zeros(int(ends[-1]), dtype=np.int32)
        for rows, flat in zip(which, pieces):
            out[ragged((ends - counts)[rows], counts[rows])] = flat
        return out, counts

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all rows, flat, and where each row starts in them (one more than rows)."""
        data, size = texts.data, texts.size
        cuts, special = texts.offsets, {}
        if self._specials:
            found = [(m.start(), m.end(), self.added[m.group()]) for i, m in self._special_matches(texts)]
            special = {a: token for a, _, token in found}
            cuts = np.concatenate([cuts, np.array([x for a, b, _ in found for x in (a, b)], dtype=np.int64)])
        starts = word_starts(texts, cuts)
        if special:
            inside = np.zeros(size + 1, dtype=bool)
            for a, b, _ in found:
                inside[a + 1 : b] = True
            starts = starts[~inside[starts]]
        sizes = np.diff(np.append(starts, size))
        keys = span_hashes(data, starts, sizes)
        slots = (mix(keys) & np.uint64(CACHE_SLOTS - 1)).astype(np.int64)
        if self._used > CACHE_IDS:
            self.forget()
        missing = np.flatnonzero(self._keys[slots] != keys)
        place = self._place[slots]
        if len(missing):
            _, one, back = np.unique(keys[missing], return_index=True, return_inverse=True)
            one = missing[one]
            ids, counts = self._encode_words(data, starts[one], sizes[one])
            begin = np.cumsum(counts) - counts + self._used
            if self._used + len(ids) > len(self._pool):
                self._pool = np.concatenate([self._pool[: self._used], np.zeros(self._used + 2 * len(ids), np.int32)])
            self._pool[self._used : self._used + len(ids)] = ids
            self._used += len(ids)
            fresh = np.stack([begin, counts], axis=1).astype(np.int32)
            place[missing] = fresh[back]
            self._keys[slots[one]] = keys[one]
            self._place[slots[one]] = fresh
        counts = place[:, 1].astype(np.int64)
        ids = self._pool[ragged(place[:, 0].astype(np.int64), counts)]
        ends = np.concatenate([[0], np.cumsum(counts)])
        if special:
            ids, ends = self._put_specials(ids, ends, starts, special)
        return ids, ends[np.searchsorted(starts, texts.offsets)]

    def _special_matches(self, texts: Texts):
        body = texts.data.tobytes()[: texts.size]
        if self._specials.search(body):
            for i in range(len(texts)):
                a, b = int(texts.offsets[i]), int(texts.offsets[i + 1])
                for m in self._specials.finditer(body, a, b):
                    yield i, m

    @staticmethod
    def _put_specials(ids, ends, starts, special) -> tuple[np.ndarray, np.ndarray]:
        """Replaces the tokens of the words that are special tokens by the one token they are."""
        at = np.searchsorted(starts, np.array(sorted(special)))
        counts = np.diff(ends)
        keep = np.ones(len(ids), dtype=bool)
        for k, word in enumerate(at):
            keep[ends[word] + 1 : ends[word + 1]] = False
            ids[ends[word]] = special[int(starts[word])]
        counts[at] = 1
        return ids[keep], np.concatenate([[0], np.cumsum(counts)])

    def decode(self, ids: np.ndarray, first: np.ndarray) -> list[bytes]:
        """UTF-8 bytes of each row's tokens; malformed sequences become the replacement character."""
        sizes = self.token_size[ids]
        body = self.token_bytes[ragged(self.token_start[ids], sizes)].tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[first].tolist()
        return [body[a:b].decode("utf-8", "replace").encode() for a, b in zip(ends[:-1], ends[1:])]


@lru_cache(maxsize=2)
def _encoder(source: bytes) -> Encoder:
    return Encoder(source)


class Vocabulary:
    """A vocabulary file, read on the driver and sent to the executors; ``LARGEST_FILE`` bounds it."""

    def __init__(self, spark, path: str) -> None:
        if Path(path).stat().st_size > LARGEST_FILE:
            raise ValueError(f"{path} is over {LARGEST_FILE} bytes")
        self._sent = spark.sparkContext.broadcast(Path(path).read_bytes())

    def encoder(self) -> Encoder:
        return _encoder(self._sent.value)


def _token_lists(ids: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids.astype(np.int32)))


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with a column ``ids`` (array of int) that holds the tokens of ``text``."""
    vocabulary = Vocabulary(docs.sparkSession, path)

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocabulary.encoder()
        for batch in batches:
            for at, texts in row_slices(batch.column(text)):
                rows = batch.slice(at, len(texts))
                kept = [c for c in rows.schema.names if c != ids]
                lists = _token_lists(*encoder.encode(texts))
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in kept), lists], [*kept, ids])
        encoder.forget()

    fields = [f for f in docs.schema.fields if f.name != ids]
    return docs.select(*(f"`{f.name}`" for f in fields)).mapInArrow(
        run, T.StructType([*fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])
    )


def decode(docs: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``docs`` with a column ``text`` that holds the text of the tokens in ``ids``; null gives empty text."""
    vocabulary = Vocabulary(docs.sparkSession, path)

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocabulary.encoder()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = batch.slice(at, 500)
                lists = [x or [] for x in rows.column(ids).to_pylist()]
                first = np.cumsum([0, *map(len, lists)])
                flat = np.array([i for x in lists for i in x], dtype=np.int64)
                found = pa.array([x.decode() for x in encoder.decode(flat, first)], pa.string())
                kept = [c for c in rows.schema.names if c != text]
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in kept), found], [*kept, text])

    fields = [f for f in docs.schema.fields if f.name != text]
    return docs.select(*(f"`{f.name}`" for f in fields)).mapInArrow(
        run, T.StructType([*fields, T.StructField(text, T.StringType())])
    )


def round_trips(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: number of tokens and SHA-256 of the tokens and of the text decoded from them.

    One pass over the texts; the tokens never leave the task that made them.
    """
    vocabulary = Vocabulary(docs.sparkSession, path)

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocabulary.encoder()
        for batch in batches:
            for at, texts in row_slices(batch.column("text")):
                ids, first = encoder.encode(texts)
                little, ends = ids.astype("<u4").tobytes(), (first * 4).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").slice(at, len(texts)),
                        pa.array(np.diff(first)),
                        pa.array([hashlib.sha256(little[a:b]).hexdigest() for a, b in zip(ends[:-1], ends[1:])]),
                        pa.array([hashlib.sha256(x).hexdigest() for x in encoder.decode(ids, first)]),
                    ],
                    [key, "n_tokens", "ids_sha256", "decoded_sha256"],
                )
        encoder.forget()

    kind = docs.schema[key].dataType
    schema = T.StructType(
        [
            T.StructField(key, kind),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )
    return docs.selectExpr(f"`{key}` AS key", f"`{text}` AS text").mapInArrow(run, schema)


def encode_text(encoder: Encoder, value: str) -> list[int]:
    """Tokens of one text, for tests and small uses."""
    return encoder.encode(texts_from([value.encode()]))[0].tolist()
