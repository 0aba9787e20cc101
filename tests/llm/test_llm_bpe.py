from __future__ import annotations

import hashlib
import os

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
from tokenizers import Tokenizer  # noqa: E402

from ordergrain.llm import bpe
from ordergrain.llm.textbytes import texts_from

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = bpe.Encoder(open(PATH, "rb").read())
PIECES = st.sampled_from(
    ["a", "s", "re", "'", "'s", "'ll", "'ve", " ", "  ", "\n", "\r\n", "\t", " é", "12", "٣", "!?", "%%%", "日本",
     "　", " ", "\x85", "\x1c", "x" * 70, "😀", "́", "<|endoftext|>", "<|endof", "The", " the"]
)


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(PIECES, st.text(max_size=5)), max_size=25).map("".join))
def test_same_tokens_as_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    found = bpe.encode_text(ENCODER, text)
    assert found == library(text)
    assert ENCODER.decode(np.array(found, dtype=np.int64), np.array([0, len(found)])) == [text.encode()]


def test_rows_stay_apart():
    texts = ["don", "'t", "  ", " a", "", "'", "s"]
    ids, first = ENCODER.encode(texts_from([t.encode() for t in texts]))
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])] == [library(t) for t in texts]


def test_long_words():
    for word in ("ab" * 5000, "é" * 3000, "%" * 4000, "abcdefgh" * 999):
        assert bpe.encode_text(ENCODER, word) == library(word)


def test_malformed_tokens_decode_like_the_library():
    for ids in ([165], [230, 165], [128, 50256, 99]):
        assert ENCODER.decode(np.array(ids), np.array([0, len(ids)]))[0].decode() == LIBRARY.decode(ids, skip_special_tokens=False)


def test_unsupported_files_are_refused():
    with pytest.raises(ValueError):
        bpe.Encoder(open(public_tokenizers.path("word_bpe_49k.json"), "rb").read())


def test_round_trips(documents, awkward):
    rows = bpe.round_trips(documents(awkward), PATH).collect()
    assert len(rows) == len(awkward)
    expected = []
    for key, text in awkward:
        ids = library(text or "")
        sums = (np.array(ids, "<u4").tobytes(), LIBRARY.decode(ids, skip_special_tokens=False).encode())
        expected.append((key, len(ids), *(hashlib.sha256(x).hexdigest() for x in sums)))
    assert sorted(map(tuple, rows), key=repr) == sorted(expected, key=repr)


def test_encode_and_decode_keep_other_columns(documents, awkward):
    docs = documents(awkward)
    both = bpe.decode(bpe.encode(docs, PATH).drop("text"), PATH)
    assert set(docs.columns) | {"ids"} == set(both.columns)
    assert sorted(((r.doc_id, r.text) for r in both.collect()), key=repr) == sorted(((k, t or "") for k, t in awkward), key=repr)


def test_empty_table(documents):
    assert bpe.round_trips(documents([]), PATH).collect() == []
    assert bpe.encode(documents([]), PATH).collect() == []
