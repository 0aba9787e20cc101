from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import prose
from ordergrain.llm import storage, substrings
from ordergrain.llm.suffixes import suffix_array


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffix_array(symbols):
    assert suffix_array(np.array(symbols, dtype=np.int64)).tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:])


@pytest.mark.parametrize("pattern", ["a" * 50, "ab" * 30, "abcab" * 12, "zyx" * 20, "abacabadabacaba" * 4])
def test_suffix_array_of_periodic_sequences(pattern):
    symbols = [ord(c) for c in pattern]
    assert suffix_array(np.array(symbols)).tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def brute(texts, length=400):
    """Kept bytes, removed bytes and runs of every text."""
    counts = Counter(b[k : k + length] for b in texts for k in range(len(b) - length + 1))
    for b in texts:
        gone = np.zeros(len(b) + 1, dtype=bool)
        for k in range(len(b) - length + 1):
            if counts[b[k : k + length]] > 1:
                gone[k : k + length] = True
        runs = int((gone[1:] & ~gone[:-1]).sum()) + int(gone[0])
        yield bytes(x for x, g in zip(b, gone) if not g), int(gone.sum()), runs


def check(documents, rows):
    found = substrings.remove_repeated(documents(rows)).collect()
    expected = [
        (key, hashlib.sha256(kept).hexdigest(), removed, runs)
        for (key, _), (kept, removed, runs) in zip(rows, brute([(t or "").encode() for _, t in rows]))
    ]
    got = [(r.doc_id, hashlib.sha256(bytes(r.kept)).hexdigest(), r.n_removed, r.n_spans) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    return found


def mixed(seed, number):
    """Texts that share passages of lengths around the limit in different surroundings."""
    chosen = random.Random(seed)
    passages = [prose(k, 20 + 15 * k) for k in range(12)] + ["é" * 250, "ab" * 300]
    for k in range(number):
        parts = [prose(100 + seed + 50 * k + j, chosen.randrange(5, 60)) for j in range(3)]
        extra = [chosen.choice(passages)[chosen.randrange(0, 60) :] for _ in range(2)]
        yield k, "\n".join([parts[0], extra[0], parts[1], extra[1], parts[2]])


def test_shared_passages(documents):
    assert sum(r.n_removed for r in check(documents, list(mixed(1, 60)))) > 0


def test_limits_are_exact(documents):
    text = prose(3, 500)
    rows = [(k, prose(40 + k, 90) + text[1000 : 1000 + 397 + k] + prose(60 + k, 90)) for k in range(8)]
    rows.append((20, prose(90, 50) + text[:2000]))
    check(documents, rows)


def test_many_spans_of_one_anchor(documents, monkeypatch):
    monkeypatch.setattr(substrings, "GROUP_SPANS", 10)
    monkeypatch.setattr(substrings.repeated_spans, "__defaults__", (400, 3))
    check(documents, list(mixed(2, 40)))


def test_slices(documents, monkeypatch):
    monkeypatch.setattr(substrings, "LONGEST", 1000)
    check(documents, list(mixed(3, 25)))


def test_awkward_rows(documents, awkward):
    check(documents, [(k, t) for k, t in awkward if len(t or "") < 40_000] + [(30, "y" * 399), (31, "z" * 400), (32, "w" * 401)])


def test_very_long_copies(documents, awkward):
    long = [(k, t) for k, t in awkward if len(t or "") > 40_000]
    assert all(r.n_removed == r.n_bytes and r.n_spans == 1 for r in substrings.remove_repeated(documents(long)).collect())


def test_text_keeps_whole_characters(documents):
    shared = prose(5, 120)
    rows = [(1, "é" + shared + "ß end"), (2, "è" + shared + "à fin"), (3, None)]
    found = {r.doc_id: r.kept for r in substrings.remove_repeated(documents(rows), as_text=True).collect()}
    assert found[1].endswith(" end") and found[2].endswith(" fin") and found[3] == "" and "�" not in found[1] + found[2]


def test_empty_table(documents):
    assert substrings.remove_repeated(documents([])).collect() == []


def test_only_the_ranges_stay_stored(spark, documents):
    storage.drop_stored(spark)
    rows = list(mixed(4, 30))
    check(documents, rows)
    assert storage.drop_stored(spark) == 1


def test_spans_of_anchors_that_occur_once_are_left_out(documents, monkeypatch):
    moved = []
    monkeypatch.setattr(substrings, "settled", lambda spark, build: moved.append(build()) or moved[-1])
    shared = prose(7, 100)
    check(documents, [(1, prose(300, 900)), (2, prose(301, 60) + shared), (3, shared + prose(302, 60))])
    assert 0 < moved[0].count() < 60  # of some 160 spans
