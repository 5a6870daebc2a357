"""Byte-level BPE ids of whole texts, word by word through a bounded memo.

The pre-token pattern splits a text into words that are encoded on their own,
so the ids of a text are the ids of its words in order.  A word is encoded
once and then kept in a memo.
``encode`` gives texts with characters beyond the Latin blocks (where the two
regular expression engines' character tables might differ) or with the text of
a special token to the library whole.  ``pattern`` splits texts with any
characters: its letters, numbers and spaces are read off the library's own
pre-tokenizer.
"""

from __future__ import annotations

import json
import os
import re
import struct
import sys
import unicodedata
from itertools import groupby

from .common import TwoGenerationCache, hold

# The letters and numbers among the Latin code points up to U+024F.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
NUMBERS = "0-9²³¹¼-¾"
PRE_TOKEN = re.compile(
    rf"'(?:[stmd]|re|ve|ll)| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^\s{LETTERS}{NUMBERS}]+|\s+(?!\S)|\s+")
BEYOND = re.compile("[^\t-\r\x20-\x7e\xa0-ɏ]")


def _ranges(chars: list[str]) -> str:
    """The inside of a character class that holds ``chars``."""
    out = []
    for _, run in groupby(enumerate(sorted(set(map(ord, chars)))), lambda x: x[1] - x[0]):
        points = [p for _, p in run]
        out.append(f"\\U{points[0]:08x}-\\U{points[-1]:08x}")
    return "".join(out)


def pattern_of(pre_tokenizer) -> re.Pattern:
    """PRE_TOKEN for texts with any characters, by the pre-tokenizer's own character tables.

    Characters of one presumed kind are split as one text; a piece of it holds one kind,
    which is told by what it stays together with."""
    count = lambda text: len(pre_tokenizer.pre_tokenize_str(text))
    presumed: dict[str, list[str]] = {"L": [], "N": [], "Z": [], "": []}
    for c in map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]):
        kind = "Z" if c.isspace() else unicodedata.category(c)[0]
        presumed[kind if kind in presumed else ""].append(c)
    found: dict[str, list[str]] = {"a": [], "1": [], "!": [], " ": []}
    for kind, chars in presumed.items():
        for lo in range(0, len(chars), 4096):
            text = "".join(chars[lo:lo + 4096])
            pieces = chars if kind == "Z" else [text[i:j] for _, (i, j) in pre_tokenizer.pre_tokenize_str(text)]
            for piece in pieces:
                found[next((k for k in "a1!" if count(k + piece) == 1), " ")].extend(piece)
    letters, numbers, spaces = (_ranges(found[k]) for k in "a1 ")
    return re.compile(
        rf"'(?:[stmd]|re|ve|ll)| ?[{letters}]+| ?[{numbers}]+| ?[^{spaces}{letters}{numbers}]+"
        rf"|[{spaces}]+(?![^{spaces}])|[{spaces}]+")


def ranks_of(definition: str) -> dict[bytes, int] | None:
    """The vocabulary as byte strings with their ids, if the ids of merged tokens are in merge
    order (then merging by lowest id is merging by first rule); else None."""
    model = json.loads(definition)["model"]
    vocabulary = model["vocab"]
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
    hidden = [b for b in range(256) if b not in shown]
    letters = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    rules = [rule.split(" ") if isinstance(rule, str) else rule for rule in model["merges"]]
    if len(vocabulary) != 256 + len(rules) or any(vocabulary[a + b] != 256 + i for i, (a, b) in enumerate(rules)):
        return None
    return {bytes(letters[c] for c in token): number for token, number in vocabulary.items()}


class WordBPE:
    """``encode`` gives the ids of a text as little-endian unsigned 32-bit integers.

    A word's ids come from tiktoken with the definition's own vocabulary, which is several
    times faster for single words and gives the same ids; other vocabularies, very long
    words and texts taken whole go through the tokenizers library."""

    def __init__(self, definition: str, memo: int = 200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self._specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.longest_special = max(map(len, self._specials), default=0)
        self._any: re.Pattern | None = None
        self._memo = TwoGenerationCache(self._of_word, memo)
        ranks = ranks_of(definition)
        self._words = ranks and tiktoken.Encoding("words", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})

    @staticmethod
    def _pack(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def _one(self, text: str) -> bytes:
        return self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _of_word(self, word: str) -> bytes:
        if not self._words or len(word) > 1000:
            return self._one(word)
        return self._pack(self._words.encode_ordinary(word))

    def plain(self, text: str) -> bool:
        """Whether the text may be split here rather than by the library."""
        latin = BEYOND.search(text) is None
        return latin and not any(special in text for special in self._specials)

    def special(self, text: str) -> bool:
        """Whether the text holds the text of a special token."""
        return any(special in text for special in self._specials)

    def latin(self, text: str) -> bool:
        return BEYOND.search(text) is None

    def pattern(self, latin: bool) -> re.Pattern:
        """What splits a text without special tokens into its pre-tokens."""
        if latin:
            return PRE_TOKEN
        if self._any is None:  # made when the first such text comes
            self._any = pattern_of(self.tokenizer.pre_tokenizer)
        return self._any

    def sizes(self, text: str) -> tuple[int, int]:
        """(tokens, pre-tokens) of any text, by the library; a special token is one of each."""
        encoding = self.tokenizer.encode(text, add_special_tokens=False)
        return len(encoding.ids), len(set(encoding.word_ids))

    def word(self, word: str) -> bytes:
        """The ids of one pre-token."""
        return self._memo[word]

    def words(self, texts: list[str | None]) -> list[list[str] | None]:
        """The pre-tokens of each text (None: to be encoded whole)."""
        return [PRE_TOKEN.findall(t) if self.plain(t) else None for t in (x or "" for x in texts)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        known = self._memo.__getitem__
        return [self._one(text) if words is None else b"".join(map(known, words))
                for text, words in zip(texts, self.words(texts))]


def tokenizer_of(definition: str) -> WordBPE:
    """One tokenizer per worker process."""
    return hold("byte-level BPE", definition, lambda: WordBPE(definition))


def read_definition(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()
