"""Operator 9: language identification by prediction by partial matching.

Each language has a tree of byte contexts up to ``order`` bytes long.  A text
is coded word by word (a word: a run of letters and their combining marks,
lower-cased, with a space on either side); the context of a byte starts at
the space before its word.  The code length of a byte is that of PPM, method C
with exclusion: the longest known context gives the byte's probability or an
escape probability, after which the next shorter context is asked without the
bytes already excluded, down to a uniform law over the bytes left.  Statistics are frozen after
training, so a word costs the same in every text and word costs are kept in a
bounded memo.  The language with the shortest code wins; the score is its
posterior probability under equal priors.

Training reads labelled rows only.  Of each language it draws, by a hash of
the key and whatever their length, documents of an expected number of at most
``per_language`` and of at most ``most_bytes`` bytes in sum, but an expected
``FEW`` if there are as many, and always one.  A drawn document is read whole.
Scoring reads every whole text.

Defined cases: a null text or one without letters is ``und`` with score 0;
ties go to the smaller language name; rows with a null language train
nothing; with no training rows at all every text is ``und``; equal texts get
equal answers; only the key, text and (for training) language columns are read.
"""

from __future__ import annotations

import math
import re
import struct
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import TwoGenerationCache, crc_of_id, hold, release, salt
from .pieces import slices

UNDETERMINED = "und"
FEW = 8
#: Combining marks (categories Mn and Mc), of which none lies outside these two stretches.
MARKS = "".join(c for c in map(chr, [*range(0x300, 0x20000), *range(0xE0100, 0xE01F0)]) if unicodedata.category(c) in ("Mn", "Mc"))
_LETTERS = re.compile(r"[^\W\d_]+")  # the same words, faster, where no character is as high as a mark
_HIGH = re.compile("[\u0300-\U0010ffff]")
_WORD = re.compile(rf"[^\W\d_]+(?:[{MARKS}]+[^\W\d_]*)*")


def words_of(text: str | None) -> list[str]:
    """The lower-cased runs of letters and their marks in a text; empty if it holds no letter."""
    text = (text or "").lower()
    words = (_WORD if _HIGH.search(text) else _LETTERS).findall(text)
    return words if any(any(map(str.isalpha, w)) for w in words) else []


def grams(word: str, order: int):
    """(context, byte) of each coded byte of a word, as one byte string."""
    data = b" " + word.encode("utf-8", "replace") + b" "
    for i in range(1, len(data)):
        yield data[max(0, i - order):i + 1]


class ContextTrees:
    """Frozen PPM statistics of several languages."""

    def __init__(self, counts: dict[str, dict[bytes, int]], order: int):
        self.order = order
        self.languages = sorted(counts)
        self._trees = []
        for language in self.languages:
            tree: dict[bytes, dict[int, int]] = defaultdict(dict)
            for gram, n in counts[language].items():
                context, symbol = gram[:-1], gram[-1]
                for start in range(len(context) + 1):
                    node = tree[context[start:]]
                    node[symbol] = node.get(symbol, 0) + n
            self._trees.append(dict(tree))
        self._grams = TwoGenerationCache(self._gram_bits, 100_000)
        self.words = TwoGenerationCache(self._word_bits, 150_000)
        self._pack = struct.Struct(f"<{len(self.languages)}d")

    def bits(self, tree: dict, context: bytes, symbol: int) -> float:
        """The exact code length of ``symbol`` after ``context``."""
        total_bits, excluded = 0.0, set()
        for start in range(len(context) + 1):
            node = tree.get(context[start:])
            if node is None:
                continue
            left = [n for s, n in node.items() if s not in excluded]
            if not left:
                continue
            total, kinds = sum(left), len(left)
            if symbol in node and symbol not in excluded:
                return total_bits - math.log2(node[symbol] / (total + kinds))
            total_bits -= math.log2(kinds / (total + kinds))
            excluded.update(node)
        return total_bits + math.log2(256 - len(excluded))

    def _gram_bits(self, gram: bytes) -> tuple[float, ...]:
        return tuple(self.bits(tree, gram[:-1], gram[-1]) for tree in self._trees)

    def _word_bits(self, word: str) -> bytes:
        known = self._grams
        return self._pack.pack(*map(sum, zip(*[known[g] for g in grams(word, self.order)])))

    def code_lengths(self, text: str | None) -> np.ndarray | None:
        """Bits of the whole text under each language; None if it has no letters."""
        words = words_of(text)
        if not words or not self.languages:
            return None
        rows = b"".join(map(self.words.__getitem__, words))
        return np.frombuffer(rows, "<f8").reshape(len(words), -1).sum(axis=0)

    def predict(self, text: str | None) -> tuple[str, float]:
        bits = self.code_lengths(text)
        if bits is None:
            return UNDETERMINED, 0.0
        odds = np.exp2(np.maximum(bits.min() - bits, -1000.0))
        best = int(bits.argmin())
        return self.languages[best], float(odds[best] / odds.sum())


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
          order: int = 4, per_language: int = 2000, most_bytes: int = 100_000_000) -> dict[str, dict[bytes, int]]:
    """Byte-context counts of each language from a bounded sample of ``docs``.

    The counts brought to the driver are bounded by the sample, not by ``docs``.
    """
    rows = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").cast("string").alias("t"),
                       F.col(f"`{lang}`").cast("string").alias("l"))
    rows = rows.where(F.col("t").isNotNull() & F.col("l").isNotNull())
    draw = F.pmod(F.xxhash64(F.lit("language sample"), F.col("k")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sizes = rows.groupBy("l").agg(F.count("*").alias("n"), F.sum(F.octet_length("t")).alias("bytes"), F.min(draw).alias("least")).collect()
    if not sizes:
        return {}
    share = {r["l"]: max(min(per_language / r["n"], most_bytes / max(1, r["bytes"])), FEW / r["n"]) for r in sizes}
    limit = F.create_map(*[x for r in sizes for x in (F.lit(r["l"]), F.lit(max(share[r["l"]], math.nextafter(r["least"], 2))))])
    sample = rows.where(draw < limit[F.col("l")]).select("l", "t")

    def count(batches):
        release()
        for batch in batches:
            found: dict[str, Counter] = defaultdict(Counter)
            for lo, hi in slices(batch.column(1)):
                for name, body in zip(batch.column(0)[lo:hi].to_pylist(), batch.column(1)[lo:hi].to_pylist()):
                    for word, n in Counter(words_of(body)).items():
                        for gram in grams(word, order):
                            found[name][gram] += n
            for name, grams_of in found.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(grams_of)), pa.array(list(grams_of), pa.binary()),
                     pa.array(list(grams_of.values()), pa.int64())], ["l", "g", "n"])

    counted = sample.mapInArrow(count, "l string, g binary, n long").groupBy("l", "g").agg(F.sum("n").alias("n"))
    counts: dict[str, dict[bytes, int]] = defaultdict(dict)
    for r in counted.collect():
        counts[r["l"]][bytes(r["g"])] = r["n"]
    return dict(counts)


def predict(docs: DataFrame, counts: dict[str, dict[bytes, int]], order: int = 4,
            key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs``' own columns plus lang_pred and score, from the counts of ``train``.

    Result columns replace columns of the same name."""
    model = docs.sparkSession.sparkContext.broadcast((salt(), counts))
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    source = docs.select(*[F.col(f"`{c}`") for c in kept])
    at = kept.index(text)

    def run(batches):
        name, held = model.value
        trees = hold("context trees", name, lambda: ContextTrees(held, order))
        for batch in batches:
            for lo, hi in slices(batch.column(at)):
                found = [trees.predict(t) for t in batch.column(at)[lo:hi].to_pylist()]
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                    [*kept, "lang_pred", "score"])

    schema = T.StructType([*source.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    return source.mapInArrow(run, schema)


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", **options) -> DataFrame:
    """(key, held_out, lang_pred, score) of every document; learns from the rows whose
    crc32(key) mod 4 is not 2."""
    held_out = crc_of_id(F.col(f"`{key}`")) % 4 == 2
    counts = train(docs.where(~held_out), key, text, lang, **options)
    rows = docs.select(F.col(f"`{key}`").alias(key), held_out.alias("held_out"), F.col(f"`{text}`").cast("string").alias(text))
    return predict(rows, counts, options.get("order", 4), key, text).select(key, "held_out", "lang_pred", "score")


def identified(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
               least: float = 0.5, **options) -> DataFrame:
    """The rows of ``docs`` whose language can be told: not ``und`` and a score of ``least`` or more."""
    held_out = crc_of_id(F.col(f"`{key}`")) % 4 == 2
    counts = train(docs.where(~held_out), key, text, lang, **options)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    found = predict(rows, counts, options.get("order", 4), text="text")
    return found.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least)).select("row.*")
