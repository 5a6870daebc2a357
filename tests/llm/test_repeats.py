"""Operator 3 against brute force over all windows."""

import random
from collections import Counter

import pytest

from lodestar.llm import repeats

from . import cases


def plain(rows, width):
    """(key, words, removed flags) of every document."""
    split = [(key, cases.words(text)) for key, text in rows]
    seen = Counter(tuple(w[i:i + width]) for _, w in split for i in range(len(w) - width + 1))
    out = []
    for key, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i:i + width])] > 1:
                gone[i:i + width] = [True] * width
        out.append((key, w, gone))
    return out


def check(spark, docs, rows, width, seed):
    want = [(k is None, k or 0, len(w), sum(g), " ".join(x for x, y in zip(w, g) if not y)) for k, w, g in plain(rows, width)]
    found = repeats.remove(docs, width=width, seed=seed).collect()
    got = [(r["row"]["doc_id"] is None, r["row"]["doc_id"] or 0, r["n_words"], r["n_removed"], r["kept"]) for r in found]
    assert sorted(got) == sorted(want)
    assert all(sum(r["spans"][1::2]) == r["n_removed"] for r in found)


def test_edge_documents(spark):
    check(spark, cases.edge(spark), cases.edge_texts(), 35, 12)


@pytest.mark.parametrize(("width", "seed", "alphabet"), [(6, 2, 3), (8, 3, 2), (5, 5, 4), (7, 1, 2)])
def test_small_alphabets_are_full_of_repeats_and_overlaps(spark, width, seed, alphabet):
    rng = random.Random(width)
    rows = [(i, " ".join(rng.choice("abcd"[:alphabet]) for _ in range(rng.randint(0, 40)))) for i in range(60)]
    check(spark, cases.frame(spark, rows).repartition(4), rows, width, seed)


def test_one_passage_in_every_document(spark):
    rng = random.Random(9)
    passage = cases.sentence(rng, 50)
    rows = [(i, f"{cases.sentence(rng, rng.randint(1, 30))} {passage}\n{cases.sentence(rng, rng.randint(1, 30))}") for i in range(300)]
    check(spark, cases.frame(spark, rows).repartition(6), rows, 35, 12)


def test_empty_table(spark):
    assert repeats.remove(cases.empty(spark)).collect() == []
    assert repeats.cleaned(cases.empty(spark)).collect() == []


def test_cleaned_rows(spark):
    docs = cases.edge(spark)
    found = repeats.cleaned(docs)
    assert found.columns == docs.columns
    want = []
    for (key, text), (_, w, gone) in zip(cases.edge_texts(), plain(cases.edge_texts(), 35)):
        if not w or not all(gone):
            new = " ".join(x for x, g in zip(w, gone) if not g) if any(gone) else text
            want.append((key is None, key or 0, new is None, new or "", None if new is None else len(new)))
    got = [(r["doc_id"] is None, r["doc_id"] or 0, r["text"] is None, r["text"] or "", r["n_chars"]) for r in found.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
