"""Operator 1 against the sentencepiece library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from lodestar.llm import pieces

from . import cases

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(pieces.read_model(PATH), memo=200)  # a small memo: generations change often


def ids(model, text):
    return np.frombuffer(model.encode(text), "<i4").tolist()


def test_random_texts_encode_and_decode_as_the_library_does(model, library):
    rng = random.Random(1)
    letters = [*"abcdeinrst  \n.,_'\"0123▁éßñ漢😀\t\x00-AB()<>/²*", "  ", "   ", "the", " of", "ing", "\n\n"]
    vocabulary = [p.replace("▁", " ") for p in model.ids]
    for i in range(3000):
        parts = letters if i % 2 else vocabulary
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40 if i % 2 else 8)))
        want = library.encode(text)
        assert ids(model, text) == want, text
        assert model.decode(np.array(want, "i4")) == library.decode(want), text


def test_any_ids_decode_as_the_library_does(model, library):
    rng = random.Random(2)
    for _ in range(1500):
        some = [rng.randrange(32000) if rng.random() < 0.5 else rng.randrange(259) for _ in range(rng.randint(0, 12))]
        assert model.decode(np.array(some, "i4")) == library.decode(some), some


def test_pair_check_agrees_with_merging(model):
    rng = random.Random(3)
    vocabulary = [p for p in model.ids if model.merge(p) == [p] and "▁▁" not in p]
    for _ in range(5000):
        a, b = rng.choice(vocabulary), rng.choice(vocabulary)
        if not a.endswith("▁"):
            assert model._check_pair((a, b)) == (model.merge(a + b) == [a, b]), (a, b)


@pytest.mark.parametrize("text", ["a" * 30_000, " " * 4000 + "x", "ab " * 10_000, "\n" * 3000])
def test_very_long_texts(model, library, text):
    assert ids(model, text) == library.encode(text)


def digests(spark, docs):
    return pieces.digests(pieces.decode(pieces.encode(docs, PATH), PATH)).collect()


def test_query_rows(spark, library):
    want = []
    for key, text in cases.edge_texts():
        found = library.encode(text or "")
        want.append((key, len(found), hashlib.sha256(",".join(map(str, found)).encode()).hexdigest(),
                     hashlib.sha256(library.decode(found).encode()).hexdigest()))
    order = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, digests(spark, cases.edge(spark))), key=order) == sorted(want, key=order)


def test_empty_table(spark):
    assert digests(spark, cases.empty(spark)) == []
