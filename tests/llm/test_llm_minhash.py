from __future__ import annotations

import random
import re

import numpy as np
import pytest

from conftest import prose
from ordergrain.llm import graph, minhash
from ordergrain.llm.textbytes import texts_from

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sets_of(rows):
    for key, text in rows:
        words = WORD.findall((text or "").translate(LOWER))
        grams = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}
        yield key, grams


def brute(rows):
    usable = [(k, s) for k, s in sets_of(rows) if k is not None and s]
    links = {k: set() for k, _ in usable}
    for i, (a, x) in enumerate(usable):
        for b, y in usable[i + 1 :]:
            if 100 * len(x & y) >= 85 * len(x | y):
                links[a].add(b)
                links[b].add(a)
    component = {}
    for start in sorted(links):
        stack = [start]
        while stack:
            k = stack.pop()
            if k not in component:
                component[k] = start
                stack += links[k]
    return component


def edited(text, seed, edits):
    words, chosen = text.split(" "), random.Random(seed)
    for _ in range(edits):
        words[chosen.randrange(len(words))] = f"new{chosen.randrange(10**6)}"
    return " ".join(words)


def check(documents, rows):
    found = minhash.near_duplicates(documents(rows)).collect()
    assert len(found) == len(rows)
    sizes, component = {}, brute(rows)
    for key, grams in sets_of(rows):
        sizes.setdefault(key, []).append(len(grams))
    for r in found:
        expected = component.get(r.doc_id, r.doc_id)
        assert r.n_shingles in sizes[r.doc_id]
        assert (r.component_id, r.kept) == (expected, r.doc_id is None or r.doc_id == expected), r


def test_near_copies(documents):
    rows = []
    for base in range(25):
        text = prose(1000 + base, 40 + 20 * base)
        rows += [(len(rows) + k, edited(text, 31 * base + k, k)) for k in range(6)]
    check(documents, rows)


def test_chain_of_copies(documents):
    """Neighbours link, distant members do not: the group is found through all of them."""
    words = prose(7, 400).split(" ")
    rows = [(k, " ".join(words[6 * k : 6 * k + 120])) for k in range(40)]
    check(documents, rows)


def test_large_group_in_chunks(documents, monkeypatch):
    monkeypatch.setattr(minhash, "CHUNK", 8)
    monkeypatch.setattr(minhash, "GROUP_ROWS", 32)
    text = prose(8, 150)
    rows = [(k, edited(text, k, 2 + k % 3)) for k in range(70)] + [(100 + k, prose(50 + k, 90)) for k in range(20)]
    check(documents, rows)


def test_awkward_rows(documents, awkward):
    check(documents, awkward)


def test_short_sets_and_ties(documents):
    texts = ["a", "a", "A", "a b", "b a", "a b c d", "a b c d e", "a b c d e f g", "g f e d c b a", " ".join("abcdefghij")]
    check(documents, list(enumerate([*texts, " ".join("abcdefghijk"), " ".join("abcdefghijkl")])))


def test_estimates():
    random_ = np.random.default_rng(2)
    for shared, own in ((900, 50), (500, 250), (0, 400)):
        pool = random_.integers(0, 2**63, shared + 2 * own).astype(np.uint64)
        left, right = pool[: shared + own], np.concatenate([pool[:shared], pool[shared + own :]])
        rows = np.concatenate([np.zeros(len(left), int), np.ones(len(right), int)])
        found = minhash.registers(rows, np.concatenate([left, right]), 2)
        estimate, used = minhash.estimates(found[:1], found[1:], np.array([len(left)]), np.array([len(right)]))
        truth = shared / (shared + 2 * own)
        assert abs(estimate[0] - truth) < 5 * np.sqrt(max(truth * (1 - truth), 0.01) / used[0])


def test_shingles_of_rows():
    rows, _ = minhash.shingles(texts_from([b"", b"a b c d e f", b"A b C d e f a b c d e", b"one two", b" "]))
    assert np.bincount(rows, minlength=5).tolist() == [0, 2, 6, 1, 0]


def test_empty_table(documents):
    assert minhash.near_duplicates(documents([])).collect() == []


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    chosen = random.Random(3)
    edges = {
        "path": [(k, k + 1) for k in range(60)],
        "star": [(500, k) for k in range(100)],
        "random": [(chosen.randrange(300), chosen.randrange(300)) for _ in range(200)],
        "none": [],
    }[shape]
    found = graph.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    parent = {}

    def root(k):
        while parent.setdefault(k, k) != k:
            k = parent[k]
        return k

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    assert {r.id: r.component for r in found} == {k: root(k) for k in list(parent) if root(k) != k}


def test_different_texts_of_one_id(documents):
    a, b = prose(71, 80), prose(72, 80)
    check(documents, [(1, a), (1, b), (2, b + " more"), (3, a + " more"), (4, prose(73, 80)), (None, a)])


def test_repeated_ids_against_brute_force(documents):
    chosen, rows = random.Random(5), []
    for base in range(12):
        text = prose(500 + base, 60)
        rows += [(chosen.randrange(30), edited(text, 31 * base + k, k)) for k in range(4)]
    rows += [(3, None), (3, ""), (rows[0][0], rows[0][1]), (100, rows[0][1])]
    check(documents, rows)
