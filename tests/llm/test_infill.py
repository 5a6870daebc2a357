"""Operator 11: fill-in-middle by block rotation, against a plain version."""

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestar.llm import infill, queries

from .cases import SCHEMA, edge, empty, frame

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(key, text, seed=42, rate=50, spm=80):
    text = text or ""
    tokens = TOKEN.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(tokens)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@given(st.binary(max_size=60), st.data())
def test_three_reversals_exchange_two_blocks(body, data):
    start = data.draw(st.integers(0, len(body)))
    end = data.draw(st.integers(start, len(body)))
    middle = data.draw(st.integers(start, end))
    buffer = bytearray(body)
    infill.rotate(buffer, start, middle, end)
    assert bytes(buffer) == body[:start] + body[middle:end] + body[start:middle] + body[end:]


@settings(max_examples=200)
@given(st.text(alphabet="ab<>PSM é漢 \t\n", max_size=40), st.data())
def test_restore_inverts_every_form(text, data):
    body = text.encode()
    if any(s in body for s in infill.SENTINELS):
        return
    cuts = sorted(data.draw(st.tuples(st.integers(0, len(body)), st.integers(0, len(body)))))
    for form in ("plain", "spm", "psm"):
        out = infill.rearranged(body, form, *cuts)
        p, m, s = body[:cuts[0]], body[cuts[0]:cuts[1]], body[cuts[1]:]
        assert bytes(out) == {"plain": body, "psm": b"<P>" + p + b"<S>" + s + b"<M>" + m,
                              "spm": b"<S>" + s + b"<P>" + p + b"<M>" + m}[form]
        assert bytes(infill.restored(bytes(out), form)) == body


@pytest.mark.parametrize("rate,spm", [(50, 80), (100, 0), (100, 100), (0, 50)])
def test_edge_documents_equal_the_plain_version(spark, rate, spm):
    docs = edge(spark)
    done = infill.restore(infill.transform(docs, rate=rate, spm=spm))
    assert set(docs.columns) < set(done.columns)
    rows = done.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == plain(r["doc_id"], r["text"], rate=rate, spm=spm)
        assert r["restored"] == (r["text"] or "")


def test_texts_with_sentinels_and_white_space_only(spark):
    rng = random.Random(3)
    texts = ["<P>", "a <S> b", "x<M>", "<P", "P> <", " ", "\t\n", "a", " a", "a ", "   x", "\x1c\x85 y"]
    rows = [(i, t * rng.choice((1, 3))) for i, t in enumerate(texts * 8)]
    for r in infill.restore(infill.transform(frame(spark, rows))).collect():
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == plain(r["doc_id"], r["text"])
        assert r["restored"] == r["text"]


def test_clashing_and_extra_columns(spark):
    docs = spark.createDataFrame([(1, "one two three", "old", 7)], "doc_id long, text string, form string, `odd name` int")
    row = infill.transform(docs, rate=100).collect()[0]
    assert row["odd name"] == 7 and row["form"] in ("psm", "spm") and row["text"] == "one two three"


def test_empty_table(spark):
    assert infill.restore(infill.transform(empty(spark))).count() == 0
    assert "form" not in SCHEMA


def test_query_restores_every_document(spark, tmp_path):
    path = str(tmp_path / "t")
    edge(spark).write.parquet(f"{path}/documents.parquet")
    texts = {}
    for r in edge(spark).collect():
        texts.setdefault(r["doc_id"], set()).add(hashlib.sha256((r["text"] or "").encode()).hexdigest())
    for r in queries.op11_fill_in_middle(spark, path).collect():
        assert r["restored_sha256"] in texts[r["doc_id"]]
