"""Operator 1: exact SentencePiece (merge-type) encoding and decoding.

A BPE piece model merges, again and again, the adjacent pair whose joined
text has the best score (leftmost among equals).  The same ids come out of a
search from left to right:

* an Aho-Corasick automaton over all pieces gives the longest piece that
  starts at each position;
* a piece may follow another only if *re-merging* the two pieces' joined text
  gives back exactly those two (adjacent-token compatibility);
* a position from which no continuation exists is cleared in a bitfield, the
  last piece is taken back and the next shorter piece is tried, so no
  position fails twice.

Characters of no piece stay alone and become their UTF-8 byte pieces.  Runs of
two or more word marks hold pieces of equal score, for which the pairwise rule
does not hold; such chunks are re-merged as a whole.

A text is first cut where no piece crosses (before a word mark, around line
feeds, between letters and punctuation marks that share no piece); the cuts
are derived from the loaded pieces.  Chunks are encoded once and kept in a
bounded memo.  Texts are handled whole, whatever their length.

Defined cases: a null text counts as empty (no ids, decoded text empty); equal
texts give equal ids; an empty table gives an empty result.  Only the key and
text columns are read.
"""

from __future__ import annotations

import heapq
import math
import re
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import TwoGenerationCache, hold

MARK = "▁"
# Types of pieces in the public model format.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: Text of the unknown piece when decoded (the model format's default).
UNKNOWN_SURFACE = " ⁇ "
LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
MARKS = ".,;:!?%&$#*()\"/"


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of one protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        shift = value = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield tag >> 3, data[at:at + size]
            at += size


class PieceModel:
    """Encoder and decoder of one model file's bytes."""

    def __init__(self, model: bytes, memo: int = 250_000):
        self.pieces: list[str] = []
        self.types: list[int] = []
        scores: list[float] = []
        normalizer: dict = {}
        trainer: dict = {}
        for number, value in _fields(model):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode("utf-8"))
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.types.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = dict(_fields(value))
        if (trainer.get(3) != 2 or normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(3, 1)
                or set(self.types) - {NORMAL, UNKNOWN, CONTROL, BYTE}):
            raise ValueError("only BPE models with the identity normaliser, a dummy prefix and no user-defined pieces")
        self.ids = {p: i for i, p in enumerate(self.pieces) if self.types[i] == NORMAL}
        self.score = {p: scores[i] for p, i in self.ids.items()}
        self.byte_ids = [0] * 256
        for i, kind in enumerate(self.types):
            if kind == BYTE:
                self.byte_ids[int(self.pieces[i][3:5], 16)] = i
        self.unknown = self.types.index(UNKNOWN)
        self._halves = TwoGenerationCache(self._halves_of, 70_000)
        self._compatible = TwoGenerationCache(self._check_pair, 200_000)
        self._solid = TwoGenerationCache(lambda p: self.merge(p) == [p], 60_000)
        self._chunks = TwoGenerationCache(self._encode_chunk, memo)
        self._build_automaton()
        self._build_cuts()
        self._build_decoder()

    # -- encoding -------------------------------------------------------------

    def _build_automaton(self) -> None:
        self._automaton = ahocorasick.Automaton()
        self._shorter: dict[str, str] = {}
        for piece in self.ids:
            self._automaton.add_word(piece, len(piece))
            for size in range(len(piece) - 1, 0, -1):
                if size == 1 or piece[:size] in self.ids:
                    self._shorter[piece] = piece[:size]
                    break
        self._automaton.make_automaton()

    def _build_cuts(self) -> None:
        letter = re.compile(f"[{LATIN}]")
        joined = {pair for p in self.ids for pair in zip(p, p[1:])}
        if any(b == MARK != a for a, b in joined):
            raise ValueError("a piece holds a word mark after another character")
        loose = [c for c in MARKS if not any((a == c and letter.match(b)) or (b == c and letter.match(a)) for a, b in joined)]
        if any("\n" in pair for pair in joined):
            raise ValueError("a piece joins a line feed with another character")
        mark = f"[{re.escape(''.join(loose))}]" if loose else "(?!)"
        self._cut = re.compile(
            f"{MARK}*[{LATIN}]++(?={mark}|[{MARK}\n]|\\Z)|{MARK}*(?:{mark})++(?=[{LATIN}{MARK}\n]|\\Z)"
            f"|\n+|{MARK}*[^{MARK}\n]+|{MARK}+")

    def merge(self, text: str) -> list[str]:
        """Plain merging: join the best-scored adjacent pair until none is a piece."""
        size = len(text)
        parts: list[str] = list(text)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        score = self.score
        heap = []
        for i in range(size - 1):
            s = score.get(text[i:i + 2])
            if s is not None:
                heap.append((-s, i, 2))
        heapq.heapify(heap)
        while heap:
            _, i, joined = heapq.heappop(heap)
            j = after[i]
            if not parts[i] or j >= size or len(parts[i]) + len(parts[j]) != joined:
                continue
            parts[i] += parts[j]
            parts[j] = ""
            after[i] = after[j]
            if after[i] < size:
                before[after[i]] = i
                s = score.get(parts[i] + parts[after[i]])
                if s is not None:
                    heapq.heappush(heap, (-s, i, joined + len(parts[after[i]])))
            if before[i] >= 0:
                s = score.get(parts[before[i]] + parts[i])
                if s is not None:
                    heapq.heappush(heap, (-s, before[i], joined + len(parts[before[i]])))
        return [p for p in parts if p]

    def _halves_of(self, piece: str) -> tuple[str, str] | None:
        """The two parts whose merge finishes ``piece``; None for one character."""
        if len(piece) == 1:
            return None
        cut = self._last_merge(piece)
        return piece[:cut], piece[cut:]

    def _last_merge(self, piece: str) -> int:
        """Where the last of the merges that build ``piece`` joins it."""
        parts = list(piece)
        while len(parts) > 2:
            best = max(range(len(parts) - 1), key=lambda i: (self.score.get(parts[i] + parts[i + 1], -math.inf), -i))
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return len(parts[0])

    def _check_pair(self, pair: tuple[str, str]) -> bool:
        """Whether merging the joined text leaves exactly ``pair``.

        The merges of both pieces are replayed backwards along the boundary: the
        pair breaks up if two parts that met there would have merged before the
        merge that took one of them away.
        """
        left, right = pair
        limit: tuple[float, int] = (math.inf, 0)  # merges at or beyond it came later
        while True:
            joined = self.score.get(left + right)
            if joined is not None and (-joined, 0) < limit:
                return False
            a, b = self._halves[left], self._halves[right]
            if a is None and b is None:
                return True
            # the later merge is taken back first; of equal ones the right-hand one came later
            late_a = -self.score[left] if a else -math.inf
            late_b = -self.score[right] if b else -math.inf
            if late_a > late_b:
                limit, left = (late_a, 0), a[1]
            else:
                limit, right = (late_b, 1), b[0]

    def search(self, text: str) -> list[str]:
        """The pieces of ``text`` by backtracking over longest matches."""
        size = len(text)
        longest = [1] * size  # a character of no piece stands alone
        for end, length in self._automaton.iter(text):
            start = end - length + 1
            if longest[start] < length:
                longest[start] = length
        open_at = bytearray(b"\x01") * (size + 1)
        compatible, solid, shorter = self._compatible, self._solid, self._shorter
        found: list[str] = []
        at = 0
        token = text[:longest[0]] if size else ""
        while token:
            last = found[-1] if found else None
            while True:
                end = at + len(token)
                if open_at[end] and (compatible[last, token] if last is not None else solid[token]):
                    found.append(token)
                    at = end
                    token = text[at:at + longest[at]] if at < size else ""
                    break
                if len(token) > 1:
                    token = shorter[token]
                    continue
                open_at[at] = 0
                token = found.pop()
                at -= len(token)
                break
        return found

    def _encode_chunk(self, chunk: str) -> bytes:
        runs_of_marks = chunk.startswith(MARK * 2)
        out: list[int] = []
        for piece in self.merge(chunk) if runs_of_marks else self.search(chunk):
            number = self.ids.get(piece)
            if number is None:
                out.extend(self.byte_ids[b] for b in piece.encode("utf-8"))
            else:
                out.append(number)
        return struct.pack(f"<{len(out)}i", *out)

    def encode(self, text: str | None) -> bytes:
        """The ids of a whole text as little-endian 32-bit integers."""
        if not text:
            return b""
        chunks = self._cut.findall(MARK + text.replace(" ", MARK))
        return b"".join(map(self._chunks.__getitem__, chunks))

    # -- decoding -------------------------------------------------------------

    def _build_decoder(self) -> None:
        surfaces = []
        for i, kind in enumerate(self.types):
            if kind == BYTE:
                surfaces.append(bytes([int(self.pieces[i][3:5], 16)]))
            elif kind == CONTROL:
                surfaces.append(b"")
            elif kind == UNKNOWN:
                surfaces.append(UNKNOWN_SURFACE.encode("utf-8"))
            else:
                surfaces.append(self.pieces[i].replace(MARK, " ").encode("utf-8"))
        self._surfaces = pa.array(surfaces, pa.large_binary())
        self._is_byte = np.array([k == BYTE for k in self.types])
        self._strips = np.array([k == NORMAL and p.startswith(MARK) for k, p in zip(self.types, self.pieces)])
        self._silent = np.array([k == CONTROL for k in self.types])

    def decode(self, ids: np.ndarray) -> str:
        """The text of one id sequence."""
        if not len(ids):
            return ""
        taken = self._surfaces.take(pa.array(ids, pa.int32()))
        _, offsets, data = taken.buffers()  # the values lie one after the other: the joined text
        first, last = np.frombuffer(offsets, "<i8")[[taken.offset, taken.offset + len(taken)]].tolist()
        raw = data.slice(first, last - first).to_pybytes() if last > first else b""
        first = int(np.argmin(self._silent[ids])) if self._silent[ids[0]] else 0
        if self._strips[ids[first]]:
            raw = raw[1:]
        try:
            return raw.decode("utf-8")
        except UnicodeDecodeError:  # each byte outside a valid character becomes one U+FFFD
            out = []
            while raw:
                try:
                    out.append(raw.decode("utf-8"))
                    break
                except UnicodeDecodeError as bad:
                    out.append(raw[:bad.start].decode("utf-8") + "�")
                    raw = raw[bad.start + 1:]
            return "".join(out)


def _model(data: bytes) -> PieceModel:
    """One model per worker process; its memo lives as long as the model is held."""
    return hold("pieces", data, lambda: PieceModel(data))


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids array<int>): the ids of each whole text.  The model file (its size does
    not depend on the data) is read on the driver and broadcast."""
    model = docs.sparkSession.sparkContext.broadcast(read_model(model_path))

    def run(batches):
        pieces = _model(model.value)
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                parts = [pieces.encode(t) for t in batch.column(1)[lo:hi].to_pylist()]
                ends = np.cumsum([0, *(len(p) // 4 for p in parts)]).astype("i4")
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(parts), "<i4")))
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], ids], [key, "ids"])

    source = docs.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").cast("string").alias(text))
    kind = source.schema[key].dataType.simpleString()
    return source.mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def decode(encoded: DataFrame, model_path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``encoded`` (key, ids) plus ``decoded``: the text of each id sequence."""
    model = encoded.sparkSession.sparkContext.broadcast(read_model(model_path))

    def run(batches):
        pieces = _model(model.value)
        for batch in batches:
            column = batch.column(1)
            texts = []
            for row in range(len(column)):
                value = column[row].values if column[row].is_valid else None
                texts.append("" if value is None else pieces.decode(value.to_numpy(zero_copy_only=False)))
                if sum_of(texts) or row + 1 == len(column):
                    lo = row + 1 - len(texts)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0)[lo:row + 1], column[lo:row + 1], pa.array(texts, pa.string())], [key, ids, "decoded"])
                    texts = []

    source = encoded.select(f"`{key}`", f"`{ids}`")
    kind = source.schema[key].dataType.simpleString()
    return source.mapInArrow(run, f"`{key}` {kind}, `{ids}` array<int>, decoded string")


def sum_of(texts: list[str], most: int = 4_000_000) -> bool:
    """Whether a batch under construction is large enough to be sent on."""
    return len(texts) >= 2_000 or (len(texts) % 64 == 0 or len(texts[-1]) > most // 8) and sum(map(len, texts)) >= most


def slices(column, most: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column holding about ``most`` characters each (one row at least)."""
    sizes = [0 if s is None else s for s in pc.binary_length(column).to_pylist()]
    lo = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield lo, i
            lo, held = i, 0
        held += size
    if lo < len(sizes):
        yield lo, len(sizes)


def digests(decoded: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of the rows of ``decode``."""
    return decoded.select(
        key,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
