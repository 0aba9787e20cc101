"""Stages of the pipeline that have to do the whole job on their own."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import prose
from ordergrain.llm import substrings

FOLDER = "unused"


def test_one_whole_copy_of_repeated_rows_reaches_packing(spark, documents):
    twice, nameless, shared = prose(1, 200), prose(2, 200), prose(3, 200)
    rows = [(1, twice), (1, twice), (None, nameless), (None, nameless), (2, shared), (None, shared)]
    rows += [(3, prose(4, 200)), (3, prose(5, 200)), (4, None), (None, None), (5, "")]
    docs = documents(rows, clashing=False)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    expected = Counter({(1, twice): 1, (None, nameless): 1, (2, shared): 1, **{r: 1 for r in rows[6:]}})
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == expected
    cut = corpus_pipeline.drop_repeated_strings(spark, kept, FOLDER)
    assert Counter((r.doc_id, r.text) for r in cut.collect()) == expected
    packed = corpus_pipeline.pack_sequences(spark, cut, FOLDER)
    assert packed.where("doc_id = 1").selectExpr("sum(length)").first() == packed.where("doc_id = 1").selectExpr("max(length)").first()


def test_no_document_is_lost_to_a_hash_collision(spark, documents, monkeypatch):
    first, second, third = (prose(k, 120) for k in (21, 22, 23))
    rows = [(1, first), (2, second), (2, second), (3, first + " more"), (4, second + " more"), (5, third)]
    clash = F.when(F.col("doc_id") <= 2, F.lit(77)).otherwise(F.xxhash64("doc_id", "text")).cast("long")
    monkeypatch.setattr(corpus_pipeline, "_hashes", lambda: (clash, F.xxhash64("text", "doc_id")))
    kept = corpus_pipeline.drop_near_duplicates(spark, documents(rows), FOLDER).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(1, first), (2, second), (5, third)]


def _shingles(text):
    words = text.split()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def test_near_duplicates_from_a_similarity_of_080_on(spark, documents):
    chosen, texts = random.Random(8), []
    for group in range(40):
        words = [f"w{chosen.randrange(10**6)}" for _ in range(300)]
        texts.append(" ".join(words))
        for place in chosen.sample(range(0, 300, 10), 3 + group % 8):  # similarities of 0.74 to 0.9
            words[place] = f"w{chosen.randrange(10**6)}"
        texts.append(" ".join(words))
    sets = [_shingles(text) for text in texts]
    root = list(range(len(texts)))
    shares = []
    for b in range(len(texts)):
        for a in range(b):
            share = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
            shares.append(share)
            if share >= 0.8:
                root = [root[a] if r == root[b] else r for r in root]
    assert any(0.8 <= s < 0.85 for s in shares) and any(0.7 < s < 0.8 for s in shares)
    docs = documents(list(enumerate(texts)), clashing=False)
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, FOLDER).collect()}
    assert kept == {k for k, r in enumerate(root) if k == r}


def _words(chosen, number):
    return " ".join("".join(chosen.choices("abcdefghijklmnop", k=chosen.randrange(3, 7))) for _ in range(number))


def test_repeated_passages_of_over_50_words_go(spark, documents):
    chosen, rows, left = random.Random(51), [], {}
    for words in range(51, 66):
        passage = _words(chosen, words)
        assert 200 <= len(passage) < 400
        for copy in range(2):
            head, tail, key = _words(chosen, 80), _words(chosen, 80), 2 * words + copy
            rows.append((key, f"{head}{copy}.{passage}.{copy}{tail}"))
            left[key] = f"{head}{copy}{copy}{tail}"
    found = corpus_pipeline.drop_repeated_strings(spark, documents(rows, clashing=False), FOLDER).collect()
    assert {r.doc_id: r.text for r in found} == left


@pytest.mark.parametrize("length", [40, 100, 200, 250, 400])
def test_substrings_of_other_lengths_against_brute_force(spark, documents, length):
    chosen = random.Random(length)
    pool = ["".join(chosen.choices("ab", k=chosen.randrange(length // 3, 2 * length))) for _ in range(12)]
    texts = ["".join(chosen.choice(pool)[chosen.randrange(9) :] for _ in range(chosen.randrange(8))) for _ in range(25)]
    places = Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
    expected = {}
    for key, t in enumerate(texts):
        gone = {k + n for k in range(len(t) - length + 1) if places[t[k : k + length]] > 1 for n in range(length)}
        expected[key] = "".join(c for n, c in enumerate(t) if n not in gone)
    found = substrings.remove_repeated(documents(list(enumerate(texts))).select("doc_id", "text"), length=length, as_text=True)
    assert {r.doc_id: r.kept for r in found.collect()} == expected


def test_long_repeated_lines_go_whatever_their_neighbours(spark, documents):
    notice, short = "All rights reserved by the owner of this page", "Read more about this"
    rows = [(k, f"first {k}\n{notice}\nmiddle {k}\n{short}\nlast {k}") for k in range(50)]
    rows.append((50, f"{notice}\n\n{notice}\n{short}\n{notice}"))
    found = corpus_pipeline.drop_repeated_lines(spark, documents(rows, clashing=False), FOLDER).collect()
    expected = {k: text if k == 0 else text.replace(f"{notice}\n", "") for k, text in rows[:50]}
    assert {r.doc_id: r.text for r in found} == expected | {50: f"\n{short}"}
