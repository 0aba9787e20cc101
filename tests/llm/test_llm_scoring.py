from __future__ import annotations

import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from conftest import prose
from ordergrain.llm import scoring

TRAINING = "coalesce(crc32(cast(doc_id AS string)), 0) % 5 != 1"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(rows, order):
    """The same model with dictionaries, by its recursive definition."""
    texts = [WORD.findall((t or "").translate(LOWER)) for _, t in rows]
    held = [zlib.crc32(b"" if k is None else str(k).encode()) % 5 == 1 for k, _ in rows]
    counts = Counter()
    for words, out in zip(texts, held):
        sequence = ["<begin>", *words, "<end>"]
        if not out:
            for n in range(1, order + 1):
                counts.update(tuple(sequence[i : i + n]) for i in range(len(sequence) - n + 1))
    single = {g: c for g, c in counts.items() if len(g) == 1 and g != ("<begin>",)}
    total, distinct = sum(single.values()), len(single)

    def p(gram):
        if len(gram) == 1:
            return (single.get(gram, 0) + 0.5) / (total + 0.5 * (distinct + 1))
        context = counts.get(gram[:-1], 0)
        if not context:
            return p(gram[1:])
        backoff = 1 - (1 - scoring.LEAST_BACKOFF) * context / (context + scoring.TRUST)
        return (1 - backoff) * counts.get(gram, 0) / context + backoff * p(gram[1:])

    for (key, _), words, out in zip(rows, texts, held):
        sequence = ["<begin>", *words, "<end>"]
        score = sum(math.log10(p(tuple(sequence[max(0, i - order + 1) : i + 1]))) for i in range(1, len(sequence)))
        tokens = [(w,) for w in sequence[1:]]
        yield key, out, len(tokens), sum(t in single for t in tokens), total, sum(math.log10(p(t)) for t in tokens), score


@pytest.mark.parametrize("order", [1, 2, 3])
def test_against_the_definition(documents, awkward, monkeypatch, order):
    monkeypatch.setattr(scoring, "BLOCK_BYTES", 100_000)
    monkeypatch.setattr(scoring, "RANGE_ENTRIES", 10_000)
    rows = [*awkward, *((k, prose(k, 60 + k)) for k in range(20, 80))]
    found = scoring.score(documents(rows), TRAINING, order=order).collect()
    expected = list(plain(rows, order))
    order_of = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert len(found) == len(expected)
    for a, b in zip(sorted(map(tuple, found), key=order_of), sorted(expected, key=order_of)):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5]) and a[6] == pytest.approx(b[6])


def test_probabilities_sum_to_one():
    """Over all words that can follow a known context, the end and the unknown word included."""
    known = [(0, "a b c a b d"), (2, "a c c b"), (5, "d a b")]
    logs = [next(plain_with(known, text))[0] for text in ("a", "a a", "a b", "a c", "a d", "a unknown")]
    assert sum(10**x for x in logs) == pytest.approx(1)


def plain_with(known, text):
    """Log-probability of the last word of ``text`` (or of the end after it) given the one before."""
    words = text.split()
    counts = Counter()
    for _, line in known:
        sequence = ["<begin>", *line.split(), "<end>"]
        counts.update((w,) for w in sequence)
        counts.update(zip(sequence, sequence[1:]))
    single = {g: c for g, c in counts.items() if len(g) == 1 and g != ("<begin>",)}
    total, distinct = sum(single.values()), len(single)
    context, last = ("a", "<end>") if len(words) == 1 else words
    c = counts[(context,)]
    backoff = 1 - (1 - scoring.LEAST_BACKOFF) * c / (c + scoring.TRUST)
    low = (single.get((last,), 0) + 0.5) / (total + 0.5 * (distinct + 1))
    yield (math.log10((1 - backoff) * counts[(context, last)] / c + backoff * low),)


def test_squeeze():
    for values in ([], [0, 0], [1, 255, 256, 2**63, 2**64 - 1], list(range(1000))):
        assert scoring.unsqueeze(scoring.squeeze(np.array(values, np.uint64))).tolist() == values


def test_held_out_copies_score_better_than_unigrams(documents):
    rows = [(k, prose(k % 40, 200)) for k in range(120)]
    found = scoring.score(documents(rows), TRAINING).where("held_out").collect()
    assert found and all(r.score > r.base_score for r in found)


def test_empty_tables(documents):
    assert scoring.score(documents([]), TRAINING).collect() == []
    row = scoring.score(documents([(1, "a b")]), "false").first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens, row.score) == (True, 3, 0, 0, 0.0)


def test_traversal_costs_less_than_the_counts():
    """No step by token in Python: finding the n-grams takes longer than walking all texts."""
    rows = pa.chunked_array([pa.array([prose(k % 500, 600) for k in range(2000)])])
    before = time.process_time()
    grams = scoring.Grams(rows, 2)
    found = time.process_time() - before
    totals = [grams.counts(n, np.arange(len(rows)) % 2 == 0) for n in (1, 2)]
    before = time.process_time()
    scores = scoring.Automaton(grams, totals, int(totals[0].sum()), int((totals[0] > 0).sum())).scores(grams)
    assert len(scores) == len(rows)
    assert time.process_time() - before < found
