"""Operator 5: token counts that follow edits, by segment trees over pre-tokens.

A document's tree has its pre-tokens (length in characters, number of tokens)
in leaf blocks and the sums of both in the nodes above.  An edit replaces a
stretch of characters.  Pre-tokens are matched from left to right and look at
most one character past their successor's first, so

* everything up to the last pre-token boundary at least two characters before
  the edit stays as it is (the boundary context on the left);
* from there the edited text is split again, until a new boundary past the
  edit meets an old one; from then on nothing differs (context on the right).

Only the pre-tokens between the two are encoded again.  They replace the old
ones in their leaf block and the sums on its path to the root are updated.

A tree is stored as a binary value next to its document, so edits that arrive
later need the text, the tree and the edits, and no full encoding.

Defined cases: a null text counts as empty; edits are (start, stop, text) in
characters of the text before any edit; they are clipped to the text, applied
from the last to the first, and one that reaches into the next one is cut
short there; null edits are none.  A text that holds the text of a special
token is one leaf: it is encoded by the library whole, again after each edit,
and all its pre-tokens count as encoded then.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import PRE_TOKEN, WordBPE, read_definition, tokenizer_of
from .pieces import slices

EDIT = "array<struct<start:int,stop:int,text:string>>"
BLOCK = 32


class CountTree:
    """Segment tree over blocks of pre-tokens; node i has the children 2i and 2i + 1."""

    def __init__(self, lengths: np.ndarray, counts: np.ndarray):
        blocks = max(1, -(-len(lengths) // BLOCK))
        self.lengths = [lengths[i * BLOCK:(i + 1) * BLOCK].tolist() for i in range(blocks)]
        self.counts = [counts[i * BLOCK:(i + 1) * BLOCK].tolist() for i in range(blocks)]
        self.width = 1 << (blocks - 1).bit_length()
        self.chars = [0] * (2 * self.width)
        self.tokens = [0] * (2 * self.width)
        for b in range(blocks):
            self.chars[self.width + b] = sum(self.lengths[b])
            self.tokens[self.width + b] = sum(self.counts[b])
        for i in range(self.width - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def before(self, place: int) -> tuple[int, int, int]:
        """(block, index in it, start) of the last pre-token that starts at or before ``place``."""
        i, start = 1, 0
        while i < self.width:
            i *= 2
            if place - start >= self.chars[i] and self.chars[i + 1]:
                start += self.chars[i]
                i += 1
        block = i - self.width
        sizes = self.lengths[block] if block < len(self.lengths) else []
        for index, size in enumerate(sizes):
            if start + size > place or index == len(sizes) - 1:
                return block, index, start
            start += size
        return block, 0, start

    def replace(self, block: int, index: int, removed: int, lengths: list[int], counts: list[int]) -> None:
        """Put new pre-tokens in the place of ``removed`` ones from (block, index) on."""
        first = True
        while removed or first:
            have = len(self.lengths[block]) - index
            take = min(removed, have)
            self.lengths[block][index:index + take] = lengths if first else []
            self.counts[block][index:index + take] = counts if first else []
            i = self.width + block
            self.chars[i], self.tokens[i] = sum(self.lengths[block]), sum(self.counts[block])
            while i > 1:
                i //= 2
                self._sum(i)
            removed -= take
            first, block, index = False, block + 1, 0

    def sizes_from(self, block: int, index: int):
        """Lengths of the pre-tokens from (block, index) on."""
        for b in range(block, len(self.lengths)):
            yield from self.lengths[b][index:] if b == block else self.lengths[b]

    def edit(self, text: str, start: int, stop: int, new: str, tokens_of: Callable[[str], int],
             pattern: re.Pattern = PRE_TOKEN) -> tuple[str, int]:
        """Apply one edit to ``text`` and its tree; the edited text and how many pre-tokens were encoded."""
        edited = text[:start] + new + text[stop:]
        shift = len(new) - (stop - start)
        block, index, at = self.before(max(0, start - 2))
        old_sizes = self.sizes_from(block, index)
        old_end, removed = at, 0
        lengths, counts = [], []
        past = start + len(new)
        place = at
        while place < len(edited):
            size = pattern.match(edited, place).end() - place
            lengths.append(size)
            counts.append(tokens_of(edited[place:place + size]))
            place += size
            if place >= past:
                while old_end < place - shift:
                    old_end += next(old_sizes)
                    removed += 1
                if old_end == place - shift:
                    break
        else:
            removed += sum(1 for _ in old_sizes)
        self.replace(block, index, removed, lengths, counts)
        return edited, len(lengths)

    def to_bytes(self) -> bytes:
        parts = []
        for column in (self.lengths, self.counts):
            values = np.array([x for b in column for x in b], np.int64)
            kind = next(k for k in ("<u1", "<u2", "<u4") if not len(values) or values.max() <= np.iinfo(k).max)
            parts.append(kind[1:].encode() + len(values).to_bytes(8, "little") + values.astype(kind).tobytes())
        return b"".join(parts)

    @staticmethod
    def from_bytes(data: bytes) -> CountTree:
        columns, at = [], 0
        for _ in range(2):
            kind, size = "<" + data[at:at + 2].decode(), int.from_bytes(data[at + 2:at + 10], "little")
            end = at + 10 + size * int(kind[2])
            columns.append(np.frombuffer(data[at + 10:end], kind).astype(np.int64))
            at = end
        return CountTree(*columns)


def _tokens(tokenizer: WordBPE, word: str) -> int:
    return len(tokenizer.word(word)) // 4


def _tree(tokenizer: WordBPE, text: str) -> tuple[CountTree, int]:
    """The tree of a text's pre-tokens and their number; with a special token's text it is one leaf."""
    if tokenizer.special(text):
        tokens, words = tokenizer.sizes(text)
        return CountTree(np.array([len(text)]), np.array([tokens])), words
    words = tokenizer.pattern(tokenizer.latin(text)).findall(text)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    counts = np.fromiter((_tokens(tokenizer, w) for w in words), np.int64, len(words))
    return CountTree(lengths, counts), len(words)


def build(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", edits: str | None = None) -> DataFrame:
    """(key, text, n_tokens, n_pretokens, tree) of every document, and its column ``edits`` if named."""
    definition = docs.sparkSession.sparkContext.broadcast(read_definition(tokenizer_path))

    def run(batches):
        tokenizer = tokenizer_of(definition.value)
        for batch in batches:
            for lo, hi in slices(batch.column(1), 2_000_000):
                texts = batch.column(1)[lo:hi].to_pylist()
                trees, totals, leaves = [], [], []
                for body in texts:
                    tree, words = _tree(tokenizer, body or "")
                    trees.append(tree.to_bytes())
                    totals.append(tree.total)
                    leaves.append(words)
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(totals, pa.int64()), pa.array(leaves, pa.int64()),
                     pa.array(trees, pa.binary()), *part.columns[2:]], names)

    source = docs.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").cast("string").alias("text"),
                         *([F.col(f"`{edits}`").cast(EDIT).alias("edits")] if edits else []))
    names = [key, "text", "n_tokens", "n_pretokens", "tree", *(["edits"] if edits else [])]
    schema = T.StructType([
        *source.schema.fields[:2], T.StructField("n_tokens", T.LongType()), T.StructField("n_pretokens", T.LongType()),
        T.StructField("tree", T.BinaryType()), *source.schema.fields[2:]])
    return source.mapInArrow(run, schema)


def apply_edits(trees: DataFrame, tokenizer_path: str, key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, n_pretokens, n_edits, n_tokens_edited, n_reencoded, edited, tree) of the
    rows of ``build`` with a column ``edits``: counts, text and tree after the edits."""
    definition = trees.sparkSession.sparkContext.broadcast(read_definition(tokenizer_path))

    def run(batches):
        tokenizer = tokenizer_of(definition.value)
        tokens_of = lambda word: _tokens(tokenizer, word)
        longest = tokenizer.longest_special
        for batch in batches:
            for lo, hi in slices(batch.column(1), 2_000_000):
                part = batch.slice(lo, hi - lo)
                out: list[tuple] = []
                for body, total, stored, edits in zip(*(part.column(i).to_pylist() for i in (1, 2, 4, 5))):
                    body = body or ""
                    if not edits:
                        out.append((0, total, 0, body, stored))
                        continue
                    tree, done, before = CountTree.from_bytes(stored), 0, len(body)
                    whole = tokenizer.special(body)
                    latin = tokenizer.latin(body)
                    for e in sorted(edits, key=lambda e: (e["start"], e["stop"]), reverse=True):
                        start = min(max(0, e["start"]), before)
                        stop = max(start, min(e["stop"], before))
                        new = e["text"] or ""
                        around = body[max(0, start - longest):start] + new + body[stop:stop + longest]
                        if not whole and not tokenizer.special(around):
                            latin = latin and tokenizer.latin(new)
                            body, count = tree.edit(body, start, stop, new, tokens_of, tokenizer.pattern(latin))
                        else:
                            body = body[:start] + new + body[stop:]
                            tree, count = _tree(tokenizer, body)
                            whole = tokenizer.special(body)
                            latin = tokenizer.latin(body)
                        done, before = done + count, start
                    out.append((len(edits), tree.total, done, body, tree.to_bytes()))
                columns = list(zip(*out)) if out else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), part.column(3), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                     pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.string()), pa.array(columns[4], pa.binary())],
                    [key, "n_tokens", "n_pretokens", "n_edits", "n_tokens_edited", "n_reencoded", "edited", "tree"])

    source = trees.select(key, "text", "n_tokens", "n_pretokens", "tree", "edits")
    kind = source.schema[key].dataType.simpleString()
    return source.mapInArrow(run, f"`{key}` {kind}, n_tokens long, n_pretokens long, n_edits long, n_tokens_edited long, "
                                  "n_reencoded long, edited string, tree binary")


#: What the redaction edits look for, and what they put there.
REDACTIONS = {
    "[email]": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "[secret]": r"\b[0-9A-Fa-f]{32,}\b",
    "[address]": r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b",
    "[number]": r"\+?[0-9][0-9 ()-]{7,}[0-9]",
}


def with_redactions(docs: DataFrame, text: str = "text", patterns: dict[str, str] | None = None) -> DataFrame:
    """``docs`` (key, text) plus ``edits``: one edit per match of a pattern, none overlapping."""
    patterns = patterns or REDACTIONS
    tags = list(patterns)
    source = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != "edits"])
    names = [*source.columns, "edits"]
    at = names.index(text)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("text", pa.string())]))

    def run(batches):
        any_of = re.compile("|".join(f"({p})" for p in patterns.values()))
        for batch in batches:
            for lo, hi in slices(batch.column(at), 2_000_000):
                part = batch.slice(lo, hi - lo)
                found = [[(m.start(), m.end(), tags[m.lastindex - 1]) for m in any_of.finditer(t or "")]
                         for t in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(
                    [[dict(zip(("start", "stop", "text"), e)) for e in row] for row in found], kind)], names)

    schema = T.StructType([*source.schema.fields, *T.StructType.fromDDL(f"edits {EDIT}").fields])
    return source.mapInArrow(run, schema)
