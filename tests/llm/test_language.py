"""Operator 9: code lengths, predictions and what they may depend on."""

import math
import random
import unicodedata

from lodestar.llm import language

from . import cases


def corpus(spark, n=200):
    rng = random.Random(1)
    kinds = {"aa": ["the", "and", "thing", "ward", "oth"], "bb": ["une", "les", "quoi", "eaux", "être"], "cc": ["der", "ung", "schön", "keit"]}
    rows = []
    for i in range(n):
        lang = rng.choice(list(kinds))
        text = " ".join("".join(rng.choices(kinds[lang], k=rng.randint(1, 2))) for _ in range(rng.randint(3, 60)))
        rows.append((i, text.capitalize(), None if i % 17 == 0 else lang, lang))
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string, truth string")


def test_held_out_accuracy_and_independence_of_labels(spark):
    rows, docs = corpus(spark)
    found = {r["doc_id"]: r for r in language.identify(docs.drop("truth")).collect()}
    assert len(found) == len(rows)
    for key, _, _, truth in rows:
        assert found[key]["held_out"] == (cases.crc(key) % 4 == 2)
        assert found[key]["lang_pred"] == truth and 0 <= found[key]["score"] <= 1
    # held-out labels change nothing
    other = spark.createDataFrame([(k, t, "zz" if cases.crc(k) % 4 == 2 else lang) for k, t, lang, _ in rows], "doc_id long, text string, lang string")
    again = {r["doc_id"]: r for r in language.identify(other).collect()}
    assert all(again[k]["lang_pred"] == r["lang_pred"] and math.isclose(again[k]["score"], r["score"]) for k, r in found.items())


def test_code_lengths_are_those_of_ppm_with_exclusion():
    trees = language.ContextTrees({"x": {b" a": 1, b" ab": 3, b" abc": 2, b" a ": 1}}, 4)
    tree = trees._trees[0]
    # after " a": b seen 3 times, space once, two kinds
    assert math.isclose(trees.bits(tree, b" a", ord("b")), -math.log2(3 / 6))
    # after " a": c escapes from two kinds; after "a" nothing is left; then the empty context without b and space
    escaped = -math.log2(2 / 6)
    rest = tree[b""]
    left = {s: n for s, n in rest.items() if s not in (ord("b"), ord(" "))}
    assert math.isclose(trees.bits(tree, b" a", ord("c")), escaped - math.log2(left[ord("c")] / (sum(left.values()) + len(left))))
    # the code lengths of all bytes are those of a law: no more than 1 in sum
    for context in (b"", b" ", b" a", b"zz"):
        assert sum(2 ** -trees.bits(tree, context, s) for s in range(256)) <= 1 + 1e-9


def test_edge_documents_and_empty_tables(spark):
    found = language.identify(cases.edge(spark)).collect()
    assert len(found) == len(cases.edge_texts())
    for r, (_, text) in zip(sorted(found, key=lambda r: str(r["doc_id"])), sorted(cases.edge_texts(), key=lambda r: str(r[0]))):
        assert (r["doc_id"] == 18) <= (r["lang_pred"] == "und")
    und = {r["doc_id"] for r in found if r["lang_pred"] == "und"}
    assert und == {4, 5, 6, 18}
    assert language.identify(cases.empty(spark)).collect() == []
    unlabelled = cases.edge(spark).drop("lang").selectExpr("*", "cast(null as string) lang")
    assert {r["lang_pred"] for r in language.identify(unlabelled).collect()} == {"und"}


def test_languages_of_long_texts_only_are_learned(spark):
    rng = random.Random(3)
    kinds = {"aa": ["the", "and", "thing", "ward", "oth"], "bb": ["une", "les", "quoi", "eaux", "être"]}
    rows = []
    for i in range(60):
        lang = "aa" if i % 2 else "bb"
        words = ["".join(rng.choices(kinds[lang], k=2)) for _ in range(9000 if lang == "bb" else 30)]
        rows.append((i, " ".join(words), lang))
    assert all((len(t.encode()) > 50_000) == (lang == "bb") for _, t, lang in rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    truth = {k: lang for k, _, lang in rows}
    assert all(r["lang_pred"] == truth[r["doc_id"]] for r in language.identify(docs).collect())
    books = docs.where("lang = 'bb'")
    assert sorted(r["doc_id"] for r in language.identified(books).collect()) == [k for k in truth if truth[k] == "bb"]
    # the bounds hold in number and in bytes, and never leave a language without a document
    whole, some = (sum(language.train(books, **o)["bb"].values()) for o in ({}, {"most_bytes": 1_000_000}))
    assert 0 < some < 0.7 * whole
    same = docs.selectExpr("cast(null as long) doc_id", "text", "lang")
    assert set(language.train(same, per_language=0, most_bytes=0)) == {"aa", "bb"}


def test_combining_marks_belong_to_words():
    assert language.words_of("हिन्दी में ภาษาไทยที่ e\u0301te\u0301 \u0301 12") == ["हिन्दी", "में", "ภาษาไทยที่", "e\u0301te\u0301"]
    assert language.words_of("\u0301\u0301 12") == []
    assert set(language.MARKS) == {c for c in map(chr, range(0x110000)) if unicodedata.category(c) in ("Mn", "Mc")}


def test_identified_keeps_rows_whole(spark):
    rows, docs = corpus(spark, 120)
    kept = language.identified(docs.union(spark.createDataFrame([(900, None, "aa", "aa"), (901, "12 34", "aa", "aa")], docs.schema)))
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == sorted(rows)
