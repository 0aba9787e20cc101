"""Log-probabilities of texts under an n-gram model held as a weighted backoff automaton.

Model. With c() counts of the training texts and p1 add-half smoothed unigrams,

    p(w | h) = (1 - b(h)) c(h w) / c(h) + b(h) p(w | h without its first word),
    b(h) = 1 - (1 - ``LEAST_BACKOFF``) c(h) / (c(h) + ``TRUST``),

which sums to one over the vocabulary and one unknown word. In the automaton every context seen in
training is a state, every seen n-gram an arc that carries its smoothed probability, and a state
without an arc for the next word is left by its failure arc, which carries b(h) and leads to the
state of the shorter context. A text is scored by one traversal from left to right.

Distribution. The counts are never in one place. Documents are dealt into blocks of about
``BLOCK_BYTES``; a block asks for the counts of its distinct n-grams, as sorted 64-bit hashes, and
gives its own. Counts meet by hash range, so a frequent n-gram is one entry per block. The answers
come back in the order of the question, and a block builds the part of the automaton that its own
documents can reach.

Defined results: null and empty texts are the end token alone; texts of any length are scored
whole; repeated rows count and are scored each; a null id counts as the empty text when the
training part is chosen; other columns are left out; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordergrain.llm.storage import stored
from ordergrain.llm.textbytes import combine, ragged, releasing, texts_of, words_of

ORDER = 2
LEAST_BACKOFF, TRUST = 0.35, 20.0
BLOCK_BYTES = 8 << 20
RANGE_ENTRIES = 1 << 21
# Hashes that stand for the end and the beginning of a text.
END, BEGIN = np.uint64(0xE4D0E4D0E4D0E4D1), np.uint64(0xB361B361B361B363)


def squeeze(values: np.ndarray) -> bytes:
    """Non-negative integers as byte planes, without the planes that are all zero."""
    values = np.ascontiguousarray(values, dtype="<u8")
    width = (int(values.max()).bit_length() + 7) // 8 if len(values) else 0
    planes = values.view(np.uint8).reshape(-1, 8)[:, :width].T
    return len(values).to_bytes(4, "little") + planes.tobytes()


def unsqueeze(data: bytes) -> np.ndarray:
    number = int.from_bytes(data[:4], "little")
    values = np.zeros((number, 8), np.uint8)
    if number:
        planes = np.frombuffer(data, np.uint8, offset=4).reshape(-1, number)
        values[:, : len(planes)] = planes.T
    return values.reshape(-1).view("<u8")


class Grams:
    """The tokens of some documents and, for n = 1 to ``order``, their distinct n-grams.

    Document i has the token positions ``first[i]`` to ``first[i + 1]``, the first of which holds
    the beginning mark. ``which[n - 1][t]`` is the place of the n-gram ending at t in the sorted
    ``keys[n - 1]``, or -1 where it would start before the document.
    """

    def __init__(self, column: pa.ChunkedArray, order: int) -> None:
        words, _, _ = words_of(texts_of(column))
        counts = words.count()
        self.first = np.concatenate([[0], np.cumsum(counts + 2)])
        tokens = np.full(int(self.first[-1]), END, dtype=np.uint64)
        tokens[self.first[:-1]] = BEGIN
        tokens[ragged(self.first[:-1] + 1, counts)] = words.hashes
        self.place = np.arange(len(tokens)) - np.repeat(self.first[:-1], counts + 2)
        self.keys, self.which, gram = [], [], tokens
        for n in range(1, order + 1):
            if n > 1:
                gram = np.concatenate([gram[:1], combine(gram[:-1], tokens[1:])])
            inside = self.place >= n - 1
            distinct, back = np.unique(gram[inside], return_inverse=True)
            which = np.full(len(tokens), -1, dtype=np.int64)
            which[inside] = back
            self.keys.append(distinct)
            self.which.append(which)

    def counts(self, n: int, training: np.ndarray) -> np.ndarray:
        """How often each distinct n-gram occurs in the documents marked as training."""
        used = np.repeat(training, np.diff(self.first)) & (self.place >= n - 1)
        return np.bincount(self.which[n - 1][used], minlength=len(self.keys[n - 1]))


def _dealt(docs: DataFrame, key: str, text: str, training: str, blocks: int) -> DataFrame:
    block = F.pmod(F.xxhash64(key, text), F.lit(blocks))
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.expr(training).alias("training"), block.alias("block"))


def corpus_counts(dealt: DataFrame, order: int, bits: int) -> DataFrame:
    """For every block, order and hash range the training counts of the block's distinct n-grams.

    ``totals`` follows the sorted hashes of the block. Rows with block -1 have the number of
    training tokens and of distinct training words of a range instead.
    """

    @releasing
    def ask(group: pa.Table) -> pa.Table:
        grams = Grams(group.column("text"), order)
        training = group.column("training").to_numpy()
        block = group.column("block")[0].as_py()
        rows = []
        for n in range(1, order + 1):
            keys, counts = grams.keys[n - 1], grams.counts(n, training)
            part = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
            for r in np.unique(part):
                a, b = np.searchsorted(part, [r, r + 1])
                own = keys[a:b]
                rows.append((n, int(r), block, int(own[0]).to_bytes(8, "little") + squeeze(np.diff(own)), squeeze(counts[a:b])))
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), asked)], asked_names)

    @releasing
    def answer(group: pa.Table) -> pa.Table:
        n, part = group.column("n")[0].as_py(), group.column("part")[0].as_py()
        lists = []
        for data in group.column("keys").to_pylist():
            steps = unsqueeze(data[8:])
            lists.append(np.cumsum(np.concatenate([np.frombuffer(data[:8], "<u8"), steps]), dtype=np.uint64))
        counts = np.concatenate([unsqueeze(x) for x in group.column("counts").to_pylist()]).astype(np.int64)
        ends = np.cumsum([len(x) for x in lists])
        distinct, back = np.unique(np.concatenate(lists), return_inverse=True)
        totals = np.bincount(back, weights=counts, minlength=len(distinct)).astype(np.int64)
        found = totals[back].astype(np.uint64)
        words = (totals > 0) & (distinct != BEGIN) if n == 1 else np.zeros(len(distinct), bool)
        blocks = group.column("block").to_pylist()
        rows = [(n, part, b, squeeze(x), 0, 0) for b, x in zip(blocks, np.split(found, ends[:-1]))]
        rows.append((n, part, -1, None, int(totals[words].sum()), int(words.sum())))
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), told)], told_names)

    asked = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
    asked_names = ["n", "part", "block", "keys", "counts"]
    told = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
    told_names = ["n", "part", "block", "totals", "tokens", "words"]
    questions = dealt.groupBy("block").applyInArrow(ask, "n int, part long, block long, keys binary, counts binary")
    return questions.groupBy("n", "part").applyInArrow(
        answer, "n int, part long, block long, totals binary, tokens long, words long"
    )


class Automaton:
    """The part of the backoff automaton that the n-grams of some documents reach.

    The state of a context is its place among the block's distinct n-grams of its length, state 0 of length 0 the
    empty one. ``log[n - 1]`` and ``seen[n - 1]`` are the arcs by n-gram: from the state of its first n - 1 words
    with its last word. Every word has an arc from the empty context, the unknown word's if it has no count.
    ``fail_log[n - 1]`` has the failure arcs of the contexts of n words; it is 0 for what is no state.
    """

    def __init__(self, grams: Grams, totals: list[np.ndarray], tokens: int, words: int) -> None:
        probability = (totals[0] + 0.5) / (tokens + 0.5 * (words + 1))
        self.log, self.fail_log = [np.log10(probability)], []
        self.seen = [np.ones(len(totals[0]), bool), *(counts > 0 for counts in totals[1:])]
        for n in range(2, len(totals) + 1):
            which, shorter = grams.which[n - 1], grams.which[n - 2]
            inside = np.flatnonzero(which >= 0)
            at = np.zeros(len(totals[n - 1]), dtype=np.int64)  # an occurrence of each distinct n-gram
            at[which[inside]] = inside
            prefix, suffix = shorter[at - 1], shorter[at]
            context = totals[n - 2][prefix].astype(float)
            backoff = 1 - (1 - LEAST_BACKOFF) * context / (context + TRUST)
            failure = np.zeros(len(totals[n - 2]))
            failure[prefix] = np.log10(backoff)
            share = totals[n - 1] / np.maximum(context, 1)
            probability = np.where(context > 0, (1 - backoff) * share + backoff * probability[suffix], probability[suffix])
            self.fail_log.append(failure)
            self.log.append(np.log10(probability))

    def scores(self, grams: Grams) -> list[float]:
        """For each document the sum of the log10 probabilities on the path of its tokens after the beginning mark.

        The state before a token is the longest seen context, so all tokens look for their arc at once: first from
        contexts of order - 1 words, then, over the failure arcs of those that have none, from shorter ones.
        """
        order = len(self.log)
        steps = np.zeros((len(grams.place), order))  # the failure arcs of each token, then its arc
        waiting = grams.place > 0
        for n in range(order, 0, -1):
            which = grams.which[n - 1]
            here = np.flatnonzero(waiting & (which >= 0))
            found = self.seen[n - 1][which[here]]
            taken, lost = here[found], here[~found]
            steps[taken, order - 1] = self.log[n - 1][which[taken]]
            waiting[taken] = False
            if len(lost):
                steps[lost, order - n] = self.fail_log[n - 2][grams.which[n - 2][lost - 1]]
        # Added up in the order of the path; a plain sum would group the numbers.
        ends = grams.first.tolist()
        return [float(np.add.accumulate(steps[a:b].reshape(-1))[-1]) for a, b in zip(ends, ends[1:])]


def score(docs: DataFrame, training: str, key: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """Scores of all documents under the model of those for which ``training`` (SQL) holds.

    Columns: key, held_out, n_tokens (words and the end), n_known, train_tokens, base_score (log10
    under the smoothed unigrams), score (log10 under the model).
    """
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    blocks = size // BLOCK_BYTES + 1
    bits = (size // (4 * RANGE_ENTRIES)).bit_length()
    dealt = _dealt(docs, key, text, training, blocks)
    counts = stored(corpus_counts(dealt, order, bits))
    tokens, words = counts.agg(F.sum("tokens"), F.sum("words")).first()
    tokens, words = tokens or 0, words or 0

    @releasing
    def run(documents: pa.Table, answers: pa.Table) -> pa.Table:
        grams = Grams(documents.column("text"), order)
        found = sorted(zip(*(answers.column(c).to_pylist() for c in ("n", "part", "totals"))))
        totals = [
            np.concatenate([unsqueeze(x) for m, _, x in found if m == n]).astype(np.int64) for n in range(1, order + 1)
        ]
        automaton = Automaton(grams, totals, tokens, words)
        symbols, first = grams.which[0], grams.first
        real = grams.place > 0
        ends = first[1:] - np.arange(1, len(first))
        base = np.add.reduceat(automaton.log[0][symbols[real]], np.concatenate([[0], ends[:-1]]))
        known = np.add.reduceat((totals[0][symbols[real]] > 0).astype(np.int64), np.concatenate([[0], ends[:-1]]))
        scores = automaton.scores(grams)
        held_out = ~documents.column("training").to_numpy()
        number = len(scores)
        return pa.Table.from_arrays(
            [
                documents.column("key"),
                pa.array(held_out),
                pa.array(np.diff(first) - 1),
                pa.array(known),
                pa.array(np.full(number, tokens)),
                pa.array(base),
                pa.array(scores, pa.float64()),
            ],
            [key, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    schema = T.StructType(
        [
            T.StructField(key, docs.schema[key].dataType),
            T.StructField("held_out", T.BooleanType()),
            *(T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")),
            *(T.StructField(c, T.DoubleType()) for c in ("base_score", "score")),
        ]
    )
    answers = counts.where("block >= 0").select("block", "n", "part", "totals")
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)
