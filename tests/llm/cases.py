"""Documents and vectors with every awkward case, and plain versions of shared rules."""

from __future__ import annotations

import random
import re
import zlib

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "uid long, node string, size int, key string, ids string, `row` int, seed int, score string, piece string")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sentence(rng: random.Random, words: int, vocabulary: int = 4000) -> str:
    return " ".join(f"w{rng.randrange(vocabulary):x}{'.' if rng.random() < 0.1 else ''}" for _ in range(words))


def edge_texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(5)
    base, passage = sentence(rng, 220), sentence(rng, 60)
    near = base.split()
    near[100] = "changed"
    giant = sentence(rng, 25_000)
    rows = [
        (1, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, " \t\n "), (7, "one two three"),
        (8, "one two three"), (9, giant), (10, sentence(rng, 80) + " " + passage + "\n" + sentence(rng, 30)),
        (11, passage + "\t\t" + sentence(rng, 90)), (12, "x" * 5000), (13, "Ünï cödé — 漢字 かな 😀 \x00 a b don't 's"),
        (14, " ".join(["again and again"] * 60)), (15, "     spaced    out  \n\n\n text   "), (None, "a text without an id"),
        (16, sentence(rng, 34)), (17, sentence(rng, 35)), (17, sentence(rng, 40)), (18, "1234 %%% !!"), (19, "<|endoftext|> <s> ▁▁ <0x0A>"),
        (1, base), (20, "tie tie tie tie tie tie tie"),
    ]
    return rows


def frame(spark, rows, languages=("aa", "bb")):
    out = [(d, t, None if d is None or d % 5 == 0 else languages[d % len(languages)], None if d == 3 else f"s{d}",
            None if t is None else len(t), 7, "n", 1, "k", "i", 2, 3, "sc", "p") for d, t in rows]
    return spark.createDataFrame(out, SCHEMA)


def edge(spark):
    return frame(spark, edge_texts()).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def crc(value) -> int:
    return zlib.crc32(("" if value is None else str(value)).encode())


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")
