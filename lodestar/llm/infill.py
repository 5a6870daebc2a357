"""Operator 11: fill-in-middle transformation by block rotation in place.

A text is cut after two numbers of tokens into prefix, middle and suffix; a token
is a word with the white space before it, or white space at the end.  The three
sentinels are inserted into a bytearray, which then reads prefix-middle-suffix,
and two neighbouring segments change places by three reversals: of the first
segment, of the second, and of both together.  ``psm`` exchanges middle and
suffix, ``spm`` exchanges prefix-and-middle with the suffix.  ``restore`` finds
the sentinels, rotates the segments back by the same three reversals, and deletes
the sentinels, from nothing but output and form.

Everything is decided by the key: ``sha256(seed:key)`` gives the two cuts, whether
a text is transformed at all (``rate`` per cent) and whether as ``spm`` (``spm``
per cent of these).  So a retried task gives the same rows.

The work runs in one pass over Arrow batches without a shuffle; a batch is taken
in slices of about 400 KB of text, longer texts alone.

Defined cases: a null text counts as empty; an empty text and one that holds a
sentinel's text stay ``plain``, their cut lengths are null; a null key is drawn
from the empty key.  Extra columns are passed through by ``transform`` unless they
bear the name of a column it adds, which it replaces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import words
from .common import release

#: The sentinels of prefix, suffix and middle.
SENTINELS = (b"<P>", b"<S>", b"<M>")
ADDED = {"n": "long", "form": "string", "prefix_chars": "long", "middle_chars": "long", "output": "string"}


def rotate(buffer: bytearray, start: int, middle: int, end: int) -> None:
    """Exchange buffer[start:middle] and buffer[middle:end] in place by three reversals."""
    for lo, hi in ((start, middle), (middle, end), (start, end)):
        view = np.frombuffer(buffer, np.uint8)[lo:hi]
        half = len(view) // 2
        left = view[:half].copy()
        view[:half] = view[::-1][:half]
        view[len(view) - half:] = left[::-1]


def draws(key: object, seed: int) -> list[int]:
    """The first four groups of eight hexadecimal digits of sha256("seed:key")."""
    text = f"{seed}:{'' if key is None else key}"
    digest = hashlib.sha256(text.encode()).digest()
    return [int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12)]


def cut(text: bytes, ends: np.ndarray, draw: list[int], rate: int, spm: int) -> tuple[str, int, int]:
    """(form, byte where the middle starts, byte where it ends) of a text whose tokens end at ``ends``."""
    if not text or any(s in text for s in SENTINELS) or draw[2] % 100 >= rate:
        return "plain", 0, 0
    n = len(ends)
    first, last = sorted((draw[0] % (n + 1), draw[1] % (n + 1)))
    at = lambda tokens: int(ends[tokens - 1]) if tokens else 0
    return ("spm" if draw[3] % 100 < spm else "psm"), at(first), at(last)


def rearranged(text: bytes, form: str, first: int, last: int) -> bytearray:
    """The output of a text that is cut at the bytes ``first`` and ``last``."""
    buffer = bytearray(text)
    if form == "plain":
        return buffer
    prefix, suffix, middle = SENTINELS
    buffer[last:last] = suffix  # from the back, so that the earlier cuts stay where they are
    buffer[first:first] = middle
    buffer[0:0] = prefix
    first, last = first + len(prefix), last + len(prefix) + len(middle)
    rotate(buffer, 0 if form == "spm" else first, last, len(buffer))
    return buffer


def restored(output: bytes, form: str) -> bytearray:
    """The text from its output and form."""
    buffer = bytearray(output)
    if form == "plain":
        return buffer
    prefix, suffix, middle = SENTINELS
    start = 0 if form == "spm" else buffer.index(suffix)
    second = buffer.index(prefix) if form == "spm" else buffer.index(middle)
    rotate(buffer, start, second, len(buffer))  # the sentinels now read prefix, middle, suffix
    last, first = buffer.index(suffix), buffer.index(middle)
    del buffer[last:last + len(suffix)]
    del buffer[first:first + len(middle)]
    del buffer[:len(prefix)]
    return buffer


def _slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    release()
    for batch in batches:
        for lo, hi in words.text_slices(batch.column(column)):
            yield batch.slice(lo, hi - lo)


def _with_columns(batch: pa.RecordBatch, added: dict[str, pa.Array]) -> pa.RecordBatch:
    kept = {n: batch.column(n) for n in batch.schema.names if n not in added}
    return pa.RecordBatch.from_pydict({**kept, **added})


def token_ends(texts: pa.Array) -> list[np.ndarray]:
    """For each text the byte positions at which its tokens end."""
    found = words.split(texts)
    sizes = [len(t) for t in texts.cast(pa.large_binary()).to_pylist()]
    out, offset = [], 0
    for i, size in enumerate(sizes):
        ends = found.end[found.first[i]:found.first[i + 1]] - offset
        if size and (not len(ends) or ends[-1] < size):
            ends = np.append(ends, size)  # white space at the end is a token
        out.append(ends)
        offset += size
    return out


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 42, rate: int = 50,
              spm: int = 80) -> DataFrame:
    """``docs`` with n (tokens), form, prefix_chars, middle_chars (code points) and output."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, text):
            bodies = batch.column(text).fill_null("")
            rows = []
            for body, ident, ends in zip(bodies.cast(pa.large_binary()).to_pylist(), batch.column(key).to_pylist(),
                                         token_ends(bodies), strict=True):
                form, first, last = cut(body, ends, draws(ident, seed), rate, spm)
                plain = form == "plain"
                rows.append((len(ends), form, None if plain else len(body[:first].decode()),
                             None if plain else len(body[first:last].decode()),
                             rearranged(body, form, first, last).decode()))
            types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield _with_columns(batch, {name: pa.array(values, kind) for name, values, kind
                                        in zip(ADDED, zip(*rows), types, strict=True)})

    kept = [f for f in docs.schema.fields if f.name not in ADDED]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"{n} {t}" for n, t in ADDED.items()])
    return docs.mapInArrow(run, schema)


def restore(done: DataFrame, output: str = "output", form: str = "form", name: str = "restored") -> DataFrame:
    """``done`` with the texts rebuilt from ``output`` and ``form`` (null where output is)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, output):
            bodies = batch.column(output).cast(pa.large_binary()).to_pylist()
            back = [None if body is None else restored(body, kind).decode()
                    for body, kind in zip(bodies, batch.column(form).to_pylist(), strict=True)]
            yield _with_columns(batch, {name: pa.array(back, pa.string())})

    kept = [f for f in done.schema.fields if f.name != name]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"`{name}` string"])
    return done.mapInArrow(run, schema)
