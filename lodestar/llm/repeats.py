"""Operator 3: removal of repeated passages with repeated-phrase automata.

A window is ``width`` consecutive words of one document.  Every word covered
by a window whose word sequence also starts anywhere else is removed.

1. Seeds.  In each window the run of ``seed`` words with the smallest hash is
   its seed (rightmost among equals): equal windows have equal seeds at equal
   offsets.  Neighbouring windows mostly share theirs, so only about one word
   in twelve gives a row.  A window can recur only if its seed does.
2. Confirmation.  Where a recurring seed always stands in the same stretch of
   words, all windows around it recur.  Where the stretches differ, each
   window is named by 128 bits of hash and counted; those met twice recur.
3. Automata.  Documents are streamed in shards of bounded size.  Each shard
   compiles an Aho-Corasick automaton of the confirmed phrases that its
   documents hold (windows that cover each recurring passage, as sequences of
   whole words) and runs every document of the shard through it; the
   occurrences found are the words to remove.

Rows are counted with map-side sums and joined back to a side that is unique
per key, so a passage found in a third of all documents is split over tasks.
Texts travel at most once, and only those with unsettled windows.

Defined cases: null texts have no words; a document shorter than a window
loses nothing; equal documents of at least ``width`` words lose all words;
an empty table gives an empty result.  Only the key and text columns are read.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.operators.sizing import join_small

from .common import release, stage
from .words import WORD_BASES, U, Words, ranges, split, text_slices, windows

NODE = ["node", "size"]  # a text's name: 64 bits of hash, and its length
#: Letters an automaton's alphabet may use (code points without the surrogates).
ALPHABET = 1_100_000


def _named(docs: DataFrame, key: str, text: str) -> DataFrame:
    body = F.col(f"`{text}`").cast("string")
    return docs.select(F.col(f"`{key}`").alias("key"), body.alias("text"),
                       F.xxhash64(body).alias("node"), F.octet_length(body).alias("size"))


def _least(values: np.ndarray, span: int) -> np.ndarray:
    """Position of the smallest of values[i:i + span] for each i (rightmost among equals)."""
    at = np.arange(len(values))
    low = values
    done = 1
    while done < span:
        step = min(done, span - done)
        right = low[step:]
        left = low[:len(right)]
        take = right <= left
        at = np.where(take, at[step:], at[:len(right)])
        low = np.where(take, right, left)
        done += step
    return at


def seeds_of(words: Words, width: int, seed: int) -> tuple[np.ndarray, ...]:
    """(seed hash, stretch hash, text number, first window within the text, windows) of each
    stretch: the neighbouring windows of a text that share a seed."""
    hashes = words.hashes(0)
    none = np.zeros(0, np.int64)
    if len(hashes) < width:
        return none.astype(U), none.astype(U), none, none, none
    n = len(hashes)
    runs = ranges(hashes, np.arange(n - seed + 1), np.arange(seed, n + 1), WORD_BASES[0])
    chosen = _least(runs, width - seed + 1)  # one entry per window, also across texts
    text = words.texts_of_words()
    whole = text[:n - width + 1] == text[width - 1:]
    start = np.flatnonzero(whole)
    chosen = chosen[start]
    new = np.ones(len(start), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (text[start[1:]] != text[start[:-1]])
    heads = np.flatnonzero(new)
    count = np.diff(np.append(heads, len(start)))
    at, place = start[heads], chosen[heads]
    stretch = ranges(words.hashes(1), at, at + count + width - 1, WORD_BASES[1]) + (place - at).astype(U)
    owner = text[at]
    return runs[place], stretch, owner, at - words.first[owner], count


def find_seeds(named: DataFrame, width: int, seed: int) -> DataFrame:
    def run(batches):
        release()
        for batch in batches:
            column = batch.column(0)
            for lo, hi in text_slices(column):
                fp, stretch, owner, at, count = seeds_of(split(column[lo:hi]), width, seed)
                rows = pa.array(owner + lo)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fp.view(np.int64)), pa.array(stretch.view(np.int64)), batch.column(1).take(rows),
                     batch.column(2).take(rows), pa.array(at.astype("i4")), pa.array(count.astype("i4"))],
                    ["seed", "stretch", "node", "size", "at", "n"])

    return named.select("text", "node", "size").where("text is not null").mapInArrow(
        run, "seed long, stretch long, node long, size int, at int, n int")


def name_windows(unsettled: DataFrame, width: int) -> DataFrame:
    """128-bit names of the listed windows; ``unsettled``: (text, node, size, at_n)."""
    def run(batches):
        release()
        for batch in batches:
            column = batch.column(0)
            for lo, hi in text_slices(column):
                words = split(column[lo:hi])
                where, names = windows(words, words.hashes(0), width, 0)
                _, more = windows(words, words.hashes(1), width, 1)
                slot = np.full(len(words.start) + 1, -1)
                slot[where] = np.arange(len(where))
                picked, owner, index = [], [], []
                for i, listed in enumerate(batch.column(3)[lo:hi].to_pylist()):
                    at = np.concatenate([np.arange(x["at"], x["at"] + x["n"]) for x in listed])
                    picked.append(slot[words.first[i] + at])
                    owner.append(np.full(len(at), lo + i))
                    index.append(at)
                picked, owner, index = np.concatenate(picked), np.concatenate(owner), np.concatenate(index)
                rows = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[picked].view(np.int64)), pa.array(more[picked].view(np.int64)),
                     batch.column(1).take(rows), batch.column(2).take(rows), pa.array(index.astype("i4"))],
                    ["a", "b", "node", "size", "at"])

    return unsettled.select("text", "node", "size", "at_n").mapInArrow(run, "a long, b long, node long, size int, at int")


def _merge(plan: DataFrame) -> DataFrame:
    """(node, size, runs): the confirmed windows of a text as sorted (first, last) pairs of 32-bit integers."""
    def run(batches):
        for batch in batches:
            out = []
            for listed in batch.column(2).to_pylist():
                merged: list[list[int]] = []
                for at, n in sorted((x["at"], x["n"]) for x in listed):
                    if merged and at <= merged[-1][1] + 1:
                        merged[-1][1] = max(merged[-1][1], at + n - 1)
                    else:
                        merged.append([at, at + n - 1])
                out.append(np.array(merged, "<i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], [*NODE, "runs"])

    by_text = plan.groupBy(*NODE).agg(F.collect_set(F.struct("at", "n")).alias("at_n"))
    return by_text.mapInArrow(run, "node long, size int, runs binary")


def recurring(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 35, seed: int = 12) -> DataFrame:
    """(node, size, runs): the recurring windows of every text that has any."""
    named = _named(docs, key, text)
    seeds = stage(find_seeds(named, width, seed), "seeds")
    again = seeds.groupBy("seed").agg(F.count("*").alias("c"), F.min("stretch").alias("lo"), F.max("stretch").alias("hi")).where("c > 1")
    hits = stage(seeds.join(again.select("seed", (F.col("lo") != F.col("hi")).alias("open")), "seed").select(
        *NODE, "at", "n", "open"), "recurring-seeds")
    unsettled = hits.where("open").groupBy(*NODE).agg(F.collect_set(F.struct("at", "n")).alias("at_n"))
    nodes = hits.where("open").select(*NODE).distinct()
    texts = join_small(named, nodes, NODE, "left_semi")
    listed = stage(name_windows(texts.join(unsettled, NODE), width), "windows")
    twice = listed.groupBy("a", "b").agg(F.count("*").alias("c")).where("c > 1").select("a", "b")
    found = listed.join(twice, ["a", "b"]).select(*NODE, "at", F.lit(1).alias("n"))
    return _merge(hits.where("not open").select(*NODE, "at", "n").union(found))


def _letters(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """A number per distinct word of the shard, and its letter (code point)."""
    _, numbers = np.unique(words.hashes(0), return_inverse=True)
    letters = numbers % ALPHABET + 1
    return numbers, np.where(letters >= 0xD800, letters + 0x800, letters).astype("<u4")


def covered(words: Words, runs: list[bytes | None], width: int) -> np.ndarray:
    """Which words of a shard an occurrence of one of its recurring phrases covers."""
    n = len(words.start)
    starts: list[np.ndarray] = []
    for i, packed in enumerate(runs):
        if packed:
            for first, last in np.frombuffer(packed, "<i4").reshape(-1, 2):
                starts.append(words.first[i] + np.append(np.arange(first, last, width), last))
    if not starts:
        return np.zeros(n, bool)
    numbers, letters = _letters(words)
    automaton = ahocorasick.Automaton()
    spelled = letters.tobytes().decode("utf-32-le")
    for at in np.unique(np.concatenate(starts)).tolist():
        automaton.add_word(spelled[at:at + width], at)
    automaton.make_automaton()
    change = np.zeros(n + 1, np.int32)
    large = len(words.start) and numbers.max() >= ALPHABET
    bounds = words.first.tolist()
    for i in range(len(runs)):
        lo, hi = bounds[i], bounds[i + 1]
        if hi - lo < width:
            continue
        for end, at in automaton.iter(spelled, lo, hi):
            first = end - width + 1
            if first < lo or large and not np.array_equal(numbers[first:first + width], numbers[at:at + width]):
                continue
            change[first] += 1
            change[end + 1] -= 1
    return np.cumsum(change[:-1]) > 0


def join_kept(words: Words, removed: np.ndarray) -> pa.Array:
    """Each text's kept words joined by one space."""
    keep = np.flatnonzero(~removed)
    owner = words.texts_of_words()[keep]
    length = words.end[keep] - words.start[keep] + 1  # with the space behind it
    final = np.ones(len(keep), bool)
    final[:-1] = owner[1:] != owner[:-1]
    length[final] -= 1
    ends = np.cumsum(length)
    source = np.repeat(words.start[keep] - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)
    out = words.data[np.minimum(source, len(words.data) - 1)] if len(source) else np.zeros(0, np.uint8)
    out[ends[~final] - 1] = 0x20
    sizes = np.bincount(owner, weights=length, minlength=len(words.first) - 1).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype("<i4")
    return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(offsets.tobytes()), pa.py_buffer(out.tobytes()))


def remove(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 35, seed: int = 12) -> DataFrame:
    """One row per document: all columns of ``docs`` as struct ``row``, n_words, n_removed,
    kept (its kept words joined by one space) and spans ([first word, words, ...] removed)."""
    runs = recurring(docs, key, text, width, seed)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.col(f"`{text}`").cast("string").alias("text"))
    whole = whole.select("row", "text", F.xxhash64("text").alias("node"), F.octet_length("text").alias("size"))
    planned = join_small(whole, runs, NODE, "left").select("row", "text", "runs")

    def run(batches):
        release()
        for batch in batches:
            column = batch.column(1)
            for lo, hi in text_slices(column):
                words = split(column[lo:hi])
                removed = covered(words, batch.column(2)[lo:hi].to_pylist(), width)
                owner = words.texts_of_words()
                lost = np.bincount(owner, weights=removed, minlength=hi - lo).astype(np.int64)
                spans: list[list[int]] = [[] for _ in range(hi - lo)]
                edge = np.ones(len(removed), bool)
                edge[1:] = (removed[1:] != removed[:-1]) | (owner[1:] != owner[:-1])
                heads = np.flatnonzero(edge)
                for at, size in zip(heads.tolist(), np.diff(np.append(heads, len(removed))).tolist()):
                    if removed[at]:
                        spans[owner[at]] += [at - int(words.first[owner[at]]), size]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], pa.array(np.diff(words.first)), pa.array(lost), join_kept(words, removed),
                     pa.array(spans, pa.list_(pa.int32()))], ["row", "n_words", "n_removed", "kept", "spans"])

    row = planned.schema["row"].dataType.simpleString()
    return planned.mapInArrow(run, f"row {row}, n_words long, n_removed long, kept string, spans array<int>")


def cleaned(docs: DataFrame, key: str = "doc_id", text: str = "text", chars: str = "n_chars", **options) -> DataFrame:
    """The rows of ``docs`` without their repeated passages, columns as before.

    A document that loses words has its kept words, joined by one space, as its text (and
    their number of characters in ``chars``, if there is such a column); others are
    unchanged.  Documents that had words and keep none go."""
    cut = remove(docs, key, text, **options)
    left = cut.where("n_words = 0 or n_removed < n_words")
    columns = []
    for name in docs.columns:
        new = {text: F.col("kept"), chars: F.length("kept").cast(docs.schema[name].dataType) if name == chars else None}.get(name)
        old = F.col(f"row.`{name}`")
        columns.append(old.alias(name) if new is None else F.when(F.col("n_removed") > 0, new).otherwise(old).alias(name))
    return left.select(*columns)
