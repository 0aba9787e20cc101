from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ordergrain.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def filled(runs, sequences, capacity):
    """Fill of every sequence; asserts that the places are gapless and the matching holds."""
    items = defaultdict(list)
    for run in runs:
        for k in range(run.count):
            place, turn = divmod(k, run.each)
            items[run.sequence + place].append((run.offset + turn * run.length, run.length))
    assert set(items) == set(range(sequences))
    for content in items.values():
        end = 0
        for offset, length in sorted(content):
            assert offset == end
            end += length
        assert end <= capacity
        assert sum(3 * length > capacity for _, length in content) <= 2
    return items


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 50)), st.integers(60, 90))
def test_plan(counts, capacity):
    runs, sequences = packing.plan(counts, capacity)
    filled(runs, sequences, capacity)
    ranks = defaultdict(list)
    for run in runs:
        ranks[run.length] += range(run.rank, run.rank + run.count)
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(v)) for k, v in counts.items()}


def test_plan_size_does_not_depend_on_the_number_of_items():
    counts = {length: 1_000_003 * (1 + length % 7) for length in range(1, 1025)}
    runs, sequences = packing.plan(counts, 1024)
    assert len(runs) < 20_000
    assert sequences <= 1.001 * sum(k * v for k, v in counts.items()) / 1024 + 1


def test_pack_documents(documents, awkward):
    library = Tokenizer.from_file(PATH)
    rows = packing.pack_documents(documents(awkward), PATH).collect()
    found, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        found[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        sequences[r.sequence_id].append((r.offset, r.length))
    expected = defaultdict(list)
    for key, text in awkward:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        head = (len(ids) - 1) % 1024 + 1
        starts = [0, *range(head, len(ids), 1024)]
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            expected[key].append((k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in expected.items()}
    for content in sequences.values():
        ends = np.cumsum([0, *(length for _, length in sorted(content))])
        assert [offset for offset, _ in sorted(content)] == ends[:-1].tolist() and ends[-1] <= 1024
    assert len(sequences) <= sum(r.length for r in rows) / 1024 + 3


def test_hot_length_is_split(spark, monkeypatch):
    monkeypatch.setattr(packing, "ROWS_PER_SALT", 100)
    items = spark.range(5000).selectExpr("id AS doc_id", "if(id % 3 = 0, 300L, 1 + id % 200) AS length")
    rows = packing.pack(items, 1024, ["doc_id"]).collect()
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for content in sequences.values():
        ends = np.cumsum([0, *(length for _, length in sorted(content))])
        assert [offset for offset, _ in sorted(content)] == ends[:-1].tolist() and ends[-1] <= 1024
    assert len(rows) == 5000 and len(sequences) <= 1.01 * sum(r.length for r in rows) / 1024 + 1


def test_empty_table(documents):
    assert packing.pack_documents(documents([]), PATH).collect() == []
