"""The pipeline's stages against a brute-force version, and the guard around the subpackage."""

import random
from collections import defaultdict

import corpus_pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from . import cases
from .test_minhash import plain as plain_classes
from .test_packing import check_sequences
from .test_repeats import plain as plain_repeats


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    stems = {"aa": ["the", "and", "thing", "ward"], "bb": ["une", "les", "quoi", "eaux"]}
    text = lambda lang, n: " ".join("".join(rng.choices(stems[lang], k=3)) + f"{rng.choice('qxz')}" for _ in range(n))
    passage = text("aa", 50)
    rows = []
    for i in range(60):
        lang = "aa" if i % 2 else "bb"
        body = text(lang, rng.randint(20, 200))
        rows.append((i, f"{body} {passage}" if i % 9 == 0 else body, lang))
    near = rows[4][1].split()
    near[3] = "changed"
    rows += [(60, rows[7][1], "aa"), (61, rows[7][1], "aa"), (62, " ".join(near), "bb"), (63, None, "aa"), (64, "", "aa"),
             (65, "12 %% 34", None), (66, text("aa", 3000), None)]
    return rows


def test_run_equals_brute_force(spark, corpus, tmp_path):
    docs = spark.createDataFrame([(d, t, lang, "s", None if t is None else len(t)) for d, t, lang in corpus],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    rows = [(d, t) for d, t, _ in corpus if t and any(map(str.isalpha, t))]
    classes = defaultdict(list)
    for key, name, _ in plain_classes(rows):
        classes[name].append(key)
    rows = [(d, t) for d, t in rows if d in {min(v) for v in classes.values()}]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for (key, text), (_, words, gone) in zip(rows, plain_repeats(rows, 35)):
        if not all(gone):
            text = " ".join(w for w, g in zip(words, gone) if not g) if any(gone) else text
            size = len(tokenizer.encode(text, add_special_tokens=False).ids) + 1
            first = size % 2048 or 2048
            want += [(key, n, a, b - a) for n, (a, b) in enumerate(zip([0, *range(first, size, 2048)], [*range(first, size + 1, 2048)]))]
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"]) for r in got) == sorted(want)
    check_sequences(got, 2048)


def test_stages_keep_the_columns_of_documents(spark):
    docs = cases.edge(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for _, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs, "").columns == docs.columns
        nothing = step(spark, docs.limit(0), "")
        assert nothing.columns == docs.columns and nothing.collect() == []


def test_every_operator_has_one_query(spark):
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()
