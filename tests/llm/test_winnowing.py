"""Operator 12: winnowing, against a plain rolling version."""

import hashlib
import random

import pytest
import regex
from pyspark.sql import functions as F

from lodestar.llm import queries, winnowing

from .cases import edge, empty, frame, sentence

PRIME, BASE = winnowing.PRIME, winnowing.BASE
LETTER = r"[0-9A-Za-z\xAA-෿Ⴀ-᎟Ḁ-῿가-힣]"
UNIT = regex.compile(rf"(?<!{LETTER}){LETTER}{{1,32}}+(?!{LETTER})|[^\t-\r ]")


def codes(spark, texts):
    """xxhash64 of every unit, from Spark, by unit."""
    units = sorted({u for t in texts for u in UNIT.findall(t or "")})
    rows = spark.createDataFrame([(u,) for u in units], "u string").select("u", F.xxhash64("u").alias("h")).collect()
    return {r["u"]: r["h"] % PRIME for r in rows}


def plain(text, code, k=5, window=8):
    """[(position, hash)] by a rolling hash and a scan of every window."""
    seq = [code[u] for u in UNIT.findall(text or "")]
    if not seq:
        return []
    if len(seq) < k:
        h = 0
        for c in seq:
            h = (h * BASE + c) % PRIME
        return [(0, h)]
    h, hashes, top = 0, [], pow(BASE, k - 1, PRIME)
    for i, c in enumerate(seq):
        if i >= k:
            h = (h - seq[i - k] * top) % PRIME
        h = (h * BASE + c) % PRIME
        if i >= k - 1:
            hashes.append(h)
    chosen = []
    for s in range(max(1, len(hashes) - window + 1)):
        part = hashes[s:s + window]
        at = s + max(i for i, x in enumerate(part) if x == min(part))
        if not chosen or chosen[-1][0] != at:
            chosen.append((at, hashes[at]))
    return chosen


def like(a, b):
    a, b = {h for _, h in a}, {h for _, h in b}
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("k,window", [(5, 8), (1, 1), (2, 3), (4, 4), (7, 5), (8, 16)])
def test_fingerprints_equal_the_rolling_version(spark, k, window):
    docs = edge(spark).where("length(text) < 20000 OR text IS NULL")
    rows = winnowing.with_fingerprint(docs, "text", "print", k, window).collect()
    code = codes(spark, [r["text"] for r in rows])
    assert rows and set(docs.columns) < set(rows[0].asDict())
    for r in rows:
        assert [tuple(e) for e in r["print"]] == plain(r["text"], code, k, window), r["text"]


def test_shared_passages_leave_a_common_hash(spark):
    rng = random.Random(1)
    k, window = 5, 8
    rows = []
    for i in range(60):  # texts share exactly window + k - 1 words with their partner, at other places
        passage = " ".join(f"p{rng.randrange(10**6)}" for _ in range(window + k - 1))
        for side in range(2):
            left, right = (" ".join(f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(30))) for _ in range(2))
            rows.append((2 * i + side, f"{left} {passage} {right}"))
    got = {r["doc_id"]: {e["hash"] for e in r["print"]}
           for r in winnowing.with_fingerprint(frame(spark, rows), "text", "print", k, window).collect()}
    assert all(got[2 * i] & got[2 * i + 1] for i in range(60))


def test_units_of_unspaced_scripts_and_long_runs(spark):
    rows = [(1, "漢字かな"), (2, "x" * 40), (3, "Straße don't"), (4, " \t　 ")]
    docs = winnowing.with_fingerprint(frame(spark, rows), "text", "print", 1, 1)
    got = {r["doc_id"]: len(r["print"]) for r in docs.collect()}
    assert got[1] == 4 and got[2] == 40 and got[3] == 4


@pytest.mark.parametrize("ranges", [1, 3, 50])
def test_against_the_next_document(spark, ranges):
    rng = random.Random(2)
    base = sentence(rng, 120)
    rows = [(i * 7, sentence(rng, rng.randrange(0, 150))) for i in range(40)] + [(3, base), (4, base), (100_000, None), (-5, "")]
    code = None
    order = sorted(rows)
    texts = [t or "" for _, t in order]
    edited = []
    for i, t in enumerate(texts):
        half = len(t) // 2
        edited.append(t[:len(t) - half] + texts[(i + 1) % len(texts)][:half])
    code = codes(spark, texts + edited)
    got = {r["doc_id"]: r for r in winnowing.against_next(frame(spark, rows).repartition(4), ranges=ranges).collect()}
    assert len(got) == len(rows)
    for i, (key, _) in enumerate(order):
        r = got[key]
        own, new, other = (plain(t, code) for t in (texts[i], edited[i], texts[(i + 1) % len(texts)]))
        assert r["n_chars"] == len(texts[i]) and r["edited"] == edited[i]
        assert [tuple(e) for e in r["fingerprint"]] == own and [tuple(e) for e in r["edited_fingerprint"]] == new
        assert r["near_edited"] == like(own, new) and r["near_next"] == like(own, other)
    assert got[3]["near_next"] == 1.0 and got[3]["fingerprint"] == got[4]["fingerprint"]


def test_null_and_repeated_keys_lose_no_row(spark):
    docs = edge(spark)
    rows = winnowing.against_next(docs, ranges=5).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r["doc_id"]) for r in docs.collect())
    same = frame(spark, [(1, "the same row again")] * 50)
    assert winnowing.against_next(same, ranges=4).where("near_next = 1.0").count() == 50


def test_one_row_follows_itself_and_no_row_gives_none(spark):
    row = winnowing.against_next(frame(spark, [(9, "abcdefgh")])).collect()[0]
    assert row["edited"] == "abcdabcd" and row["near_next"] == 1.0
    assert winnowing.against_next(empty(spark)).count() == 0


def test_query(spark, tmp_path):
    path = str(tmp_path / "t")
    docs = frame(spark, [(i, t) for i, t in enumerate(["a b c d e f", "", None, "a b c d e f", "Ünï 漢字 x"])])
    docs.write.parquet(f"{path}/documents.parquet")
    rows = {r["doc_id"]: r for r in queries.op12_winnowed_fingerprints(spark, path).collect()}
    assert rows[0]["fingerprint"] == rows[3]["fingerprint"] and rows[1]["fingerprint"] == ""
    texts = ["a b c d e f", "", "", "a b c d e f", "Ünï 漢字 x"]
    for i, t in enumerate(texts):
        half = len(t) // 2
        new = t[:len(t) - half] + texts[(i + 1) % 5][:half]
        assert rows[i]["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
    plan = queries.op12_winnowed_fingerprints(spark, path)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
