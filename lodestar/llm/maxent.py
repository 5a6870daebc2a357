"""Operator 7: language-model scoring with a hashed maximum-entropy model.

Tokens are the words of a text (A-Z lower-cased) and one end, named by 64-bit
hashes.  Every word has a class: the ``SINGLES`` most frequent training tokens
have one each, all other words, known or not, share the rest by their names.

    P(w | h) = P(class(w) | h) * P(w | class(w), h)

*Class softmax.*  Its logits are dense weights of class features, hashed into
rows (the class of the last token, of the one before it as a skip feature, and
both), plus sparse weights of (last word, class) for every word.  The dense
weights are trained by distributed gradient steps over the counts of class
trigrams, whose number depends on the model alone; each word's own weights by
gradient steps in the tasks that hold the word.

*Member softmax.*  A word starts from c + 0.1 (c: its training count; each
shared class also holds 0.1 for a word never seen) and has a weight for every
pair (last word, word) that occurs ``least`` times or more.  A block (last word,
class) shares no weight with any other, so blocks are dealt over the tasks and
each is trained by gradient steps of its own.  The normaliser of a block is that
of its class corrected for the words that have a weight, so it is exact.

Contexts (last words) and words within a class are hashed: a feature's name is one
64-bit number of class (6 bits), context (34) and cell of the class (24).  Words of
one cell share their weights and a cell's mass is the sum of its words', so the law
stays proper; a word never seen takes the weights of its cell, if there are any.

The members of each class and one unseen word per shared class sum to one, and
so do the classes, for any history.  The weights are a table that grows with the
corpus.  The most used of them, of a stated number, are broadcast; a token that
needs others joins them.  A bitmap of fixed size spares the join for names that
surely have no weight; it never hides one that does.

Word counts cover every training token.  The ``common`` most frequent words
are broadcast as hashes and counts (16 bytes each); counts of all other words
are found by a join on the word's hash, summed per document.

Defined cases: a null text counts as empty (its end alone); with no training
rows every word is unknown; equal texts get equal scores; an empty table gives
an empty result.  Only the key and text columns are read.
"""

from __future__ import annotations

import copy
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_of_id, release, stage, with_uid
from .words import U, mix, split, text_slices

SMOOTH = 0.1
END = np.int64(0x0E4D0E4D0E4D0E4D)  # the name of the end token
START = np.int64(0x057A7057A7057A70)  # what stands before a text's first token
CLASSES = 48  # histories use one more, for the start
SINGLES = 24  # classes of one word
SHARED = CLASSES - SINGLES
BUCKETS = 4096  # of 32,768 bits each: the bitmap of weight names, 16 MB
PART = 1_000_000  # training tokens whose pairs, and what is asked of them, make one part
LN10 = math.log(10)


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Names of the tokens of each text, its end after its words, and the texts' first tokens."""
    words = split(pc.fill_null(column, ""))
    data = words.data
    upper = (data >= 65) & (data <= 90)
    words.data = np.where(upper, data + 32, data).astype(np.uint8)
    names = words.hashes().view(np.int64)
    first = words.first + np.arange(len(words.first))
    out = np.full(first[-1], END, np.int64)
    out[np.arange(len(names)) + words.texts_of_words()] = names
    return out, first


def count_tokens(docs: DataFrame) -> DataFrame:
    """(token, n) partial counts per task; ``docs``: (text)."""
    def flush(held):
        if held:
            names, place = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            n = np.bincount(place, weights=np.concatenate([h[1] for h in held])).astype(np.int64)
            return names, n
        return None

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for lo, hi in text_slices(batch.column(0)):
                tokens, _ = tokens_of(batch.column(0)[lo:hi])
                held.append(np.unique(tokens, return_counts=True))
                size += len(held[-1][0])
                if size > 1_500_000:
                    held = [flush(held)]
                    size = len(held[0][0])
                if size > 1_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in flush(held)], ["token", "n"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in flush(held)], ["token", "n"])

    return docs.select("text").mapInArrow(run, "token long, n long")


def packed(values: np.ndarray) -> bytes:
    """64-bit values by byte planes, which the shuffle's compression shortens where they are alike."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpacked(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(8, -1).T).view(np.int64).ravel()


def packed_names(names: np.ndarray) -> bytes:
    """Sorted names as their differences."""
    return packed(np.diff(names.view(U), prepend=U(0)))


def unpacked_names(blob: bytes) -> np.ndarray:
    return np.cumsum(unpacked(blob).view(U), dtype=U).view(np.int64)


def dealt(part: np.ndarray, names: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """(part, packed names, packed columns) of each part, sorted by name."""
    order = np.lexsort((names, part))
    ends = np.flatnonzero(np.append(np.diff(part[order]) != 0, True)) + 1
    for lo, hi in zip(np.append(0, ends[:-1]), ends):
        some = order[lo:hi]
        yield int(part[some[0]]), packed_names(names[some]), *(packed(c[some]) for c in columns)


def find(names: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is among the sorted ``names``, its place there or 0) of each wanted name."""
    if not len(names):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(names, wanted), len(names) - 1)
    found = names[at] == wanted
    return found, np.where(found, at, 0)


class Vocabulary:
    """The common tokens (sorted names and counts), the classes, and each shared class's mass."""

    def __init__(self, rows: list | pa.Table, tokens: int, words: int, shared: dict[int, float]):
        self.tokens, self.words = tokens, words
        self.parts = tokens // PART + 1  # into how many parts names are dealt
        columns = ([rows[c] for c in ("token", "n")] if isinstance(rows, pa.Table)
                   else [np.array([r[c] for r in rows], np.int64) for c in ("token", "n")])
        names, counts = (np.asarray(c) for c in columns)
        top = np.lexsort((names, -counts))[:SINGLES]
        top_names, top_counts = names[top], counts[top]
        order = np.argsort(names)
        self.names, self.counts = names[order], counts[order]
        order = np.argsort(top_names)
        self.single_names, self.single_classes = top_names[order], order
        mass = [shared.get(s, 0.0) + SMOOTH for s in range(SHARED)]
        for token, n in zip(top_names.tolist(), top_counts.tolist()):
            mass[token % SHARED] -= n + SMOOTH
        self.masses = np.array([n + SMOOTH for n in top_counts.tolist()] + [1.0] * (SINGLES - len(top)) + [max(m, SMOOTH) for m in mass])
        self.singles = len(top)

    def classes(self, tokens: np.ndarray) -> np.ndarray:
        single, at = find(self.single_names, tokens)
        out = SINGLES + np.mod(tokens, SHARED)
        out[single] = self.single_classes[at[single]]
        return out

    def count(self, tokens: np.ndarray) -> np.ndarray:
        """Training count of each token, 0 if it is not a common one."""
        found, at = find(self.names, tokens)
        return np.where(found, self.counts[at], 0) if len(self.counts) else np.zeros(len(tokens), np.int64)


def contexts_of(tokens: np.ndarray, classes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The hashed last word of each token: its class and 28 bits of its name."""
    one, cls = np.full(len(tokens), START, np.int64), np.full(len(tokens), CLASSES, np.int64)
    one[1:], cls[1:] = tokens[:-1], classes[:-1]
    one[first[:-1]], cls[first[:-1]] = START, CLASSES
    return (cls << 28) | (mix(one.view(U)) & U((1 << 28) - 1)).view(np.int64)


def cells_of(tokens: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The cell of each token within its class; a class of one word has one."""
    return np.where(classes >= SINGLES, (tokens >> 32) & 0xFFFFFF, 0)


def histories(classes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The class history of each token as one number: the class two back and the one before
    (CLASSES: start)."""
    one, two = np.full(len(classes), CLASSES), np.full(len(classes), CLASSES)
    one[1:], two[2:] = classes[:-1], classes[:-2]
    starts = first[:-1]
    one[starts] = two[starts] = CLASSES
    second = starts + 1
    two[second[second < first[1:]]] = CLASSES
    return two * (CLASSES + 1) + one


def pair_names(contexts: np.ndarray, classes: np.ndarray, cells: np.ndarray) -> np.ndarray:
    return (classes.astype(np.int64) << 58) | (contexts << 24) | cells


def blocks_of(pairs: np.ndarray) -> np.ndarray:
    """Class and context of each pair, as one number."""
    return (pairs.view(U) >> U(24)).view(np.int64)


def block_names(blocks: np.ndarray) -> np.ndarray:
    """The name under which a block's correction is kept; no pair has the class 62."""
    return ((mix(blocks.view(U)) >> U(6)) | U(62 << 58)).view(np.int64)


def features(history: np.ndarray, rows: int) -> np.ndarray:
    """Hashed feature rows of each class history: a bias, last class, skip, and both."""
    two, one = (history // (CLASSES + 1)).astype(U), (history % (CLASSES + 1)).astype(U)
    kinds = [np.zeros(len(history), U), one + U(1000), two + U(2000), one * U(CLASSES + 1) + two + U(1_000_000)]
    return np.stack([(mix(k) % U(rows)).astype(np.int64) for k in kinds], axis=1)


def log_softmax(logits: np.ndarray) -> np.ndarray:
    logits = logits - logits.max(1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(1, keepdims=True))


class Maxent:
    """Dense weights of the class softmax and their gradient."""

    def __init__(self, vocabulary: Vocabulary, rows: int):
        self.rows = rows
        self.weights = np.zeros((rows, CLASSES))
        self.closed = np.arange(CLASSES) < SINGLES
        self.closed[:vocabulary.singles] = False  # a single class without a word cannot occur
        self.weights[features(np.zeros(1, np.int64), rows)[0, 0]] = np.log(vocabulary.masses)

    def single(self) -> Maxent:
        """A copy in single precision, as it is sent to the tasks."""
        out = copy.copy(self)
        out.weights = self.weights.astype("<f4")
        return out

    def logits(self, history: np.ndarray) -> np.ndarray:
        a = self.weights[features(history, self.rows)].sum(1, dtype=float)
        a[:, self.closed] = -np.inf
        return a

    def gradient(self, history: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradient and curvature bound of the log-likelihood of ``counts`` (histories x CLASSES)."""
        p = np.exp(log_softmax(self.logits(history)))
        total = counts.sum(1, keepdims=True)
        out = np.zeros(self.weights.shape), np.zeros(self.weights.shape)
        at = features(history, self.rows)
        for f in range(at.shape[1]):
            np.add.at(out[0], at[:, f], counts - total * p)
            np.add.at(out[1], at[:, f], total * p * (1 - p))
        return out


HISTORY = 63  # stands for the class in the names of class trigrams


def count_contexts(docs: DataFrame, vocabulary) -> DataFrame:
    """(part, names, counts) partial counts per task, by name, of pairs and of class trigrams, packed by
    parts of whole blocks; ``docs``: (text)."""
    def flush(held):
        keys, place = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
        n = np.bincount(place, weights=np.concatenate([h[1] for h in held])).astype(np.int64)
        rows = dealt(np.mod(blocks_of(keys), vocabulary.value.parts), keys, n)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))], ["part", "names", "counts"])

    def run(batches):
        v = vocabulary.value
        total = np.zeros((CLASSES + 1) ** 2 * CLASSES, np.int64)
        held, size = [], 0
        for batch in batches:
            for lo, hi in text_slices(batch.column(0)):
                tokens, first = tokens_of(batch.column(0)[lo:hi])
                classes = v.classes(tokens)
                codes, n = np.unique(histories(classes, first) * CLASSES + classes, return_counts=True)
                total[codes] += n
                keys = pair_names(contexts_of(tokens, classes, first), classes, cells_of(tokens, classes))
                held.append(np.unique(keys, return_counts=True))
                size += len(held[-1][0])
                if size > 2_500_000:
                    yield flush(held)
                    held, size = [], 0
        codes = np.flatnonzero(total)
        if len(codes):
            yield flush([*held, (((codes.astype(U) << U(24)) | U(HISTORY << 58)).view(np.int64), total[codes])])

    return docs.select("text").mapInArrow(run, "part int, names binary, counts binary")


def whole_blocks(batches) -> Iterator[list[np.ndarray]]:
    """The columns of ``batches`` (key first, sorted by it) in runs that end where a block ends."""
    held: list = []
    for batch in batches:
        new = [np.asarray(c) for c in batch.columns]
        if not len(new[0]):
            continue
        block = blocks_of(new[0])
        if held and blocks_of(held[-1][0][-1:])[0] != block[0]:
            yield [np.concatenate(c) for c in zip(*held)]
            held = []
        cut = int(np.flatnonzero(block != block[-1])[-1]) + 1 if block[0] != block[-1] else 0
        if cut:
            yield [np.concatenate(c) for c in zip(*held, [x[:cut] for x in new])]
            held = []
        held.append([x[cut:] for x in new])
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


def tally(counted: DataFrame, least: int) -> DataFrame:
    """(key, n, total): the pairs of shared classes that occur ``least`` times or more, with the count
    of their block; and every block (key: its number, total 0).  One shuffle, by parts of whole blocks."""
    def run(table):
        keys, place = np.unique(np.concatenate([unpacked_names(b) for b in table["names"].to_pylist()]), return_inverse=True)
        n = np.bincount(place, weights=np.concatenate([unpacked(b) for b in table["counts"].to_pylist()])).astype(np.int64)
        block = blocks_of(keys)
        starts = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
        total = np.add.reduceat(n, starts)
        each = np.repeat(total, np.diff(np.append(starts, len(keys))))
        cls = block >> 34
        kept = (n >= least) & (cls >= SINGLES) & (cls != HISTORY)
        return pa.table({"key": np.concatenate([keys[kept], block[starts]]), "n": np.concatenate([n[kept], total]),
                         "total": np.concatenate([each[kept], np.zeros(len(starts), np.int64)])})

    return counted.groupBy("part").applyInArrow(run, "key long, n long, total long")


def fit_classes(trigrams: DataFrame, vocabulary, rows: int, steps: int, parts: int) -> Maxent:
    """Train the dense weights by ``steps`` distributed gradient steps over all class trigrams."""
    spark = trigrams.sparkSession
    counted = stage(trigrams.select("a", "b", "n").repartition(parts, "a"), "histories")
    model = Maxent(vocabulary.value, rows)
    moved = np.zeros_like(model.weights)
    for _ in range(steps):
        held = spark.sparkContext.broadcast(model.single())

        def run(batches, held=held):
            out = None
            for batch in batches:
                names, place = np.unique(np.asarray(batch.column(0)), return_inverse=True)
                counts = np.zeros((len(names), CLASSES))
                np.add.at(counts, (place, np.asarray(batch.column(1))), np.asarray(batch.column(2)))
                part = held.value.gradient(names, counts)
                out = part if out is None else (out[0] + part[0], out[1] + part[1])
            if out is not None:
                at = np.flatnonzero(out[1].any(1))  # the rows of the histories seen here
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (
                    at.astype("<i8"), *(x[at].astype("<f4") for x in out))], ["at", "g", "h"])

        g, h = np.zeros_like(model.weights), np.zeros_like(model.weights)
        for r in counted.mapInArrow(run, "at binary, g binary, h binary").collect():  # as many rows as ``parts``, of the model's size at most
            at = np.frombuffer(r["at"], "<i8")
            g[at] += np.frombuffer(r["g"], "<f4").reshape(len(at), -1)
            h[at] += np.frombuffer(r["h"], "<f4").reshape(len(at), -1)
        moved *= 0.5
        moved += np.clip(0.5 * (g - 0.5 * model.weights * (h > 0)) / (h + 1.0), -2, 2)
        model.weights += moved * 0.5
        held.destroy()  # its copies on every machine go before the next step
    return model


def fit_words(cells: DataFrame, average, rho: float, steps: int) -> DataFrame:
    """(a, n, classes, theta): each last word's own class weights, trained against the class law of its
    class averaged over the words two back; a word has one list of at most CLASSES cells."""
    def run(batches):
        for keys, n in whole_blocks(batches):
            words = blocks_of(keys)
            starts = np.append(np.flatnonzero(np.append(True, words[1:] != words[:-1])), len(keys))
            for lo in range(0, len(starts) - 1, 4096):
                some = starts[lo:lo + 4097]
                last, seen = words[some[:-1]], np.add.reduceat(n[some[0]:some[-1]], some[:-1] - some[0])
                row = np.repeat(np.arange(len(last)), np.diff(some))
                counts = np.zeros((len(last), CLASSES))
                counts[row, keys[some[0]:some[-1]] & 0xFFFFFF] = n[some[0]:some[-1]]
                last, counts, seen = last[seen > 1], counts[seen > 1], seen[seen > 1]
                base = average.value[last >> 28]
                total = counts.sum(1, keepdims=True)
                has = counts > 0
                theta = np.zeros(counts.shape)
                for _ in range(steps):
                    p = np.exp(log_softmax(base + theta))
                    step = (counts - total * p - rho * theta) / (total * p * (1 - p) + rho)
                    theta += 0.7 * np.clip(np.where(has, step, 0), -2, 2)
                at, cls = np.nonzero(has)
                ends = pa.array(np.concatenate([[0], np.cumsum(has.sum(1))]).astype("i4"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(last), pa.array(seen), pa.ListArray.from_arrays(ends, pa.array(cls.astype("i1"))),
                     pa.ListArray.from_arrays(ends, pa.array(theta[at, cls].astype("f4")))], ["a", "n", "classes", "theta"])

    lists = cells.select((F.shiftleft("a", 24) + F.col("b")).alias("key"), "n")
    lists = lists.repartition(F.shiftright("key", 24)).sortWithinPartitions("key")
    return lists.mapInArrow(run, "a long, n long, classes array<byte>, theta array<float>")


def train_blocks(block: np.ndarray, n: np.ndarray, m: np.ndarray, total: np.ndarray, mass: np.ndarray,
                 rho: float, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """(weight of each pair, log normaliser less that of the class of each block)."""
    weight = np.zeros(len(n))

    def norm():
        return mass + np.bincount(block, weights=m * np.expm1(weight), minlength=len(mass))

    for _ in range(steps):
        p = m * np.exp(weight) / norm()[block]
        step = (n - total[block] * p - rho * weight) / (total[block] * p * (1 - p) + rho)
        weight += 0.7 * np.clip(step, -2, 2)
    weight = weight.astype("f4").astype(float)
    return weight, np.log(norm() / mass)


def fit_members(pairs: DataFrame, vocabulary, rho: float, steps: int) -> DataFrame:
    """(key, value, n, part): weights of pairs and corrections of their blocks' normalisers, by name, and
    the part of their block.  ``pairs``: (key, n, total, m), m the mass of the pair's cell."""
    def run(batches):
        for keys, n, total, m in whole_blocks(batches):
            blocks = blocks_of(keys)
            starts = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1]))
            block = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(keys))))
            mass = vocabulary.value.masses[blocks[starts] >> 34]
            value, shift = train_blocks(block, n, m, total[starts].astype(float), mass, rho, steps)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([keys, block_names(blocks[starts])])),
                 pa.array(np.concatenate([value, -shift]).astype("f4")),
                 pa.array(np.concatenate([n, total[starts]])),
                 pa.array(np.mod(np.concatenate([blocks, blocks[starts]]), vocabulary.value.parts).astype("i4"))],
                ["key", "value", "n", "part"])

    ordered = pairs.repartition(F.shiftrightunsigned("key", 24)).sortWithinPartitions("key")
    return ordered.mapInArrow(run, "key long, value float, n long, part int")


class Model:
    """What the tasks need: the class weights, and the most used word and pair weights."""

    def __init__(self, classes: Maxent, thetas: pa.Table, weights: pa.Table, bits: np.ndarray):
        self.logits = classes.logits(np.arange((CLASSES + 1) ** 2))  # of every class history
        self.logs = log_softmax(np.where(np.isinf(self.logits), -1e300, self.logits))
        order = np.argsort(np.asarray(thetas["a"]))
        lists = thetas.take(pa.array(order)).combine_chunks()
        self.last = np.asarray(lists["a"])
        self.theta = np.zeros((len(order), CLASSES), "f4")
        if len(order):
            cls, value = lists["classes"].chunk(0), lists["theta"].chunk(0)
            row = np.repeat(np.arange(len(order)), np.diff(np.asarray(cls.offsets)))
            self.theta[row, np.asarray(cls.flatten())] = np.asarray(value.flatten())
        self.keys, self.values = (np.asarray(weights[c]) for c in ("key", "value"))
        order = np.argsort(self.keys)
        self.keys, self.values = self.keys[order], self.values[order]
        self.bits = bits

    def may_have(self, keys: np.ndarray) -> np.ndarray:
        """Whether a weight of that name may exist (never false for one that does)."""
        at = bit_of(keys)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1

    def class_logs(self, history: np.ndarray, last: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log P(class | history), and whether the last word may have weights that are not here."""
        key = mix(last.view(U) + (history * CLASSES + classes).astype(U) * U(0x9E3779B97F4A7C15))
        _, head, place = np.unique(key, return_index=True, return_inverse=True)
        found, at = find(self.last, last[head])
        value = self.logs[history[head], classes[head]]
        own = np.flatnonzero(found)
        for lo in range(0, len(own), 4096):
            some = own[lo:lo + 4096]
            value[some] = self.with_weights(history[head[some]], self.theta[at[some]], classes[head[some]])
        return value[place], (~found & self.may_have(last[head]))[place]

    def with_weights(self, history: np.ndarray, theta: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """log P(class | history) with a last word's own weights."""
        return log_softmax(self.logits[history] + theta)[np.arange(len(classes)), classes]

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(weight or 0, whether it may be one that is not here) of each name."""
        names, place = np.unique(keys, return_inverse=True)
        found, at = find(self.keys, names)
        value = np.where(found, self.values[at], 0.0) if len(self.keys) else np.zeros(len(names))
        return value[place], (~found & self.may_have(names))[place]


def bit_of(keys: np.ndarray) -> np.ndarray:
    return np.mod(keys, BUCKETS * 32768)


def bitmap(keys: DataFrame) -> np.ndarray:
    """The bits of all names, in a bitmap of fixed size."""
    place = F.pmod("key", F.lit(BUCKETS * 32768))
    found = keys.select((place / 32768).cast("int").alias("bucket"), F.pmod(place, F.lit(32768)).alias("bit"))
    out = np.zeros((BUCKETS, 4096), np.uint8)
    for r in found.groupBy("bucket").agg(F.expr("bitmap_construct_agg(bit)").alias("bits")).collect():
        out[r["bucket"]] = np.frombuffer(r["bits"], np.uint8)
    return out.reshape(-1)


def most_used(table: DataFrame, name: str, limit: int) -> Column:
    """Which rows are among the ``limit`` of greatest ``n``, or a few less: of rows with equal ``n``,
    those whose names hash low.  Costs two counts, no sort."""
    n, bucket, left = F.least(F.col("n"), F.lit(1 << 16)), F.pmod(F.xxhash64(name), F.lit(4096)), limit
    for r in sorted(table.groupBy(n.alias("n")).count().collect(), reverse=True):
        if r["count"] > left:
            break
        left -= r["count"]
    else:
        return F.lit(True)
    last, buckets = r["n"], 0
    for b in sorted(table.where(n == last).groupBy(bucket.alias("bucket")).count().collect()):
        if b["count"] > left:
            break
        left, buckets = left - b["count"], b["bucket"] + 1
    return (n > last) | ((n == last) & (bucket < buckets))


class Trained:
    """The model's tables, their broadcast part and which rows are in it."""

    def __init__(self, thetas: DataFrame, weights: DataFrame, classes: Maxent, words: int, pairs: int):
        spark = thetas.sparkSession
        self.thetas, self.weights, self.classes = thetas, weights, classes
        self.held_thetas, self.held_weights = most_used(thetas, "a", words), most_used(weights, "key", pairs)
        used = thetas.where(self.held_thetas).select("a", "classes", "theta")
        most = weights.where(self.held_weights).select("key", "value")
        bits = bitmap(weights.select("key").union(thetas.select(F.col("a").alias("key"))))
        self.held = spark.sparkContext.broadcast(Model(classes, used.toArrow(), most.toArrow(), bits))
        release()  # the driver's copies


def train(docs: DataFrame, counts: DataFrame, vocabulary, rows: int = 8192, steps: int = 12, parts: int = 8,
          least: int = 2, rho: float = 0.15, words: int = 50_000, pairs: int = 2_000_000) -> Trained:
    """Train on all of ``docs`` (text); ``words`` and ``pairs`` bound what is broadcast, not the model."""
    found = stage(tally(count_contexts(docs, vocabulary), least), "contexts")
    blocks = found.where("total = 0").withColumn("cls", F.shiftright("key", 34))
    code = F.col("key") - F.lit(HISTORY << 34)
    trigrams = blocks.where(F.col("cls") == HISTORY).select(
        F.floor(code / CLASSES).alias("a"), (code % CLASSES).alias("b"), "n")
    classes = fit_classes(trigrams, vocabulary, rows, steps, parts)

    spark = docs.sparkSession
    every = np.arange((CLASSES + 1) ** 2)
    logs = log_softmax(classes.single().logits(every)).reshape(CLASSES + 1, CLASSES + 1, CLASSES)
    seen = np.zeros((CLASSES + 1, CLASSES + 1))
    for r in trigrams.groupBy("a").agg(F.sum("n").alias("n")).collect():  # one row a class history
        seen[r["a"] // (CLASSES + 1), r["a"] % (CLASSES + 1)] = r["n"]
    share = (seen + 1e-9) / (seen + 1e-9).sum(0)
    average = spark.sparkContext.broadcast(np.log(np.maximum((np.exp(logs) * share[:, :, None]).sum(0), 1e-300)))
    cells = blocks.where(F.col("cls") != HISTORY).select(
        F.col("key").bitwiseAND((1 << 34) - 1).alias("a"), F.col("cls").alias("b"), "n")
    thetas = stage(fit_words(cells, average, rho, steps), "word-weights")

    shared = F.lit(SINGLES) + F.pmod("token", F.lit(SHARED))
    cell = F.shiftright("token", 32).bitwiseAND(0xFFFFFF)
    masses = counts.where(~F.col("token").isin(vocabulary.value.single_names.tolist())).groupBy(
        (shared * (1 << 24) + cell).alias("cell")).agg(F.sum(F.col("n") + F.lit(SMOOTH)).alias("m"))
    pairs_of = found.where("total > 0").withColumn(
        "cell", F.shiftrightunsigned("key", 58) * (1 << 24) + F.col("key").bitwiseAND(0xFFFFFF))
    members = pairs_of.join(masses, "cell").select("key", "n", "total", "m")
    weights = stage(fit_members(members, vocabulary, rho, steps * 2), "pair-weights")
    return Trained(thetas, weights, classes, words, pairs)


REST, PAIRS, LASTS = range(3)  # what texts ask for: counts of words, weights of pairs and blocks, of last words
TABLE = 3  # added to one of these: the table itself
PACKED = ["kind byte", "names binary", "uids binary", "codes binary", "values binary"]
TOLD = ["n_tokens long", "n_common long", "common_log double", "score_part double"]
ADDED = ["known long", "more double", "weights double"]
SUMS = ["uids binary", *(f"{c.split()[0]} binary" for c in ADDED)]


def read(docs: DataFrame, vocabulary, held) -> DataFrame:
    """What a text alone tells, one row a text, and, packed by parts, the names of what is not broadcast:
    words that are not common, pairs, and last words with their class history (codes)."""
    kind = docs.schema["key"].dataType.simpleString()
    names = ["part", "uid", "key", "held_out", *(c.split()[0] for c in TOLD + PACKED[:4])]

    def run(batches):
        v, m = vocabulary.value, held.value
        parts = v.parts
        asked, size = [[], [], []], 0

        def flush(key_type):
            rows = []
            for what, part_of in ((REST, lambda x: x), (PAIRS, blocks_of), (LASTS, lambda x: x)):
                name, uid, code = (np.concatenate(c) for c in zip(*asked[what]))
                if len(name):
                    rows += [(r[0], what, *r[1:]) for r in dealt(np.mod(part_of(name), parts), name, uid, code)]
                asked[what].clear()
            part, *told = zip(*rows) if rows else [[]] * 5
            nulls = [pa.nulls(len(rows), t) for t in (pa.int64(), key_type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())]
            types = (pa.int8(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), *nulls, *map(pa.array, told, types)], names)

        for batch in batches:
            key_type = batch.column(2).type
            for lo, hi in text_slices(batch.column(1)):
                tokens, first = tokens_of(batch.column(1)[lo:hi])
                counts, classes = v.count(tokens), v.classes(tokens)
                last, history = contexts_of(tokens, classes, first), histories(classes, first)
                p, more_last = m.class_logs(history, last, classes)
                shared = classes >= SINGLES
                pairs = pair_names(last, classes, cells_of(tokens, classes))
                value, more = m.look_up(np.concatenate([pairs, block_names(blocks_of(pairs))]))
                value, more = value.reshape(2, -1) * shared, (more.reshape(2, -1) & shared).any(0)
                p += value.sum(0)
                common = counts > 0
                logs = np.log10(counts + SMOOTH)
                p = p / LN10 - np.log10(v.masses[classes]) + np.where(common, logs, 0)
                owner = np.repeat(np.arange(hi - lo), np.diff(first))
                uids = np.asarray(batch.column(0)[lo:hi])
                code = history * CLASSES + classes
                for what, some, name in ((REST, ~common, tokens), (PAIRS, more, pairs), (LASTS, more_last, last)):
                    asked[what].append((name[some], uids[owner[some]], code[some] if what == LASTS else np.zeros(some.sum(), np.int64)))
                    size += len(asked[what][-1][0])
                sums = lambda x: pa.array(np.bincount(owner, weights=x, minlength=hi - lo))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.mod(uids, parts).astype("i4")), *(batch.column(c)[lo:hi] for c in (0, 2, 3)),
                     pa.array(np.diff(first)), sums(common).cast(pa.int64()), sums(np.where(common, logs, 0)), sums(p),
                     *(pa.nulls(hi - lo, t) for t in (pa.int8(), pa.binary(), pa.binary(), pa.binary()))], names)
                if size > 1_500_000:
                    yield flush(key_type)
                    size = 0
        if size:
            yield flush(key_type)

    return docs.select("uid", "text", "key", "held_out").mapInArrow(
        run, f"part int, uid long, key {kind}, held_out boolean, {', '.join(TOLD + PACKED[:4])}")


def packed_rows(table: DataFrame, what: int, parts: int) -> DataFrame:
    """The rows of a table (key, value, or classes and theta; part, if it is not that of the key), packed by parts."""
    def flush(held):
        held = pa.Table.from_batches(held).combine_chunks()
        names = np.asarray(held["key"])
        part = np.asarray(held["part"]) if "part" in held.column_names else np.mod(names, parts)
        if what != LASTS:
            rows = [(p, n, None, None, v) for p, n, v in dealt(part, names, np.asarray(held["value"]).astype(float))]
        else:
            rows = []
            for p, n, at in dealt(part, names, np.arange(len(names))):
                some = held.take(pa.array(unpacked(at))).combine_chunks()
                lists = [some[c].chunk(0) for c in ("classes", "theta")]
                rows.append((p, n, packed(np.diff(np.asarray(lists[0].offsets)).astype(np.int64)),
                             *(np.asarray(x.flatten()).tobytes() for x in lists)))
        part, *rest = zip(*rows)
        kind = pa.array([what + TABLE] * len(rows), pa.int8())
        return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), kind, *(pa.array(c, pa.binary()) for c in rest)],
                                          ["part", *(c.split()[0] for c in PACKED)])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size > 500_000:
                yield flush(held)
                held, size = [], 0
        if held:
            yield flush(held)

    return table.mapInArrow(run, f"part int, {', '.join(PACKED)}")


def answers(told: DataFrame, counts: DataFrame, trained: Trained, parts: int) -> DataFrame:
    """A row for each text: what it alone tells, and what the tables beyond the broadcast add: known words,
    their logs, and weights.  One shuffle of what is asked and of the tables, one of the sums, packed by
    parts of texts, so their rows do not multiply with texts and parts."""
    held = trained.held
    weights = trained.weights.where(~trained.held_weights).select("key", "value", "part")
    thetas = trained.thetas.where(~trained.held_thetas).select(F.col("a").alias("key"), "classes", "theta")
    tables = [(counts.select(F.col("token").alias("key"), F.col("n").alias("value")), REST), (weights, PAIRS), (thetas, LASTS)]
    for table, what in tables:
        told = told.unionByName(packed_rows(table, what, parts), allowMissingColumns=True)

    def gains(names, codes, rows):
        """What the last words' own weights add to the log of a class."""
        keys = np.concatenate([unpacked_names(b) for b in rows["names"].to_pylist()])
        size = np.concatenate([unpacked(b) for b in rows["uids"].to_pylist()])
        classes = np.frombuffer(b"".join(rows["codes"].to_pylist()), "i1")
        values = np.frombuffer(b"".join(rows["values"].to_pylist()), "f4")
        order, starts = np.argsort(keys), np.cumsum(size) - size
        found, at = find(keys[order], names)
        out, at = np.zeros(len(names)), order[at[found]]
        each, place = np.unique(at << 20 | codes[found], return_inverse=True)
        gain = np.zeros(len(each))
        for lo in range(0, len(each), 4096):
            at, code = each[lo:lo + 4096] >> 20, each[lo:lo + 4096] & 0xFFFFF
            row = np.repeat(np.arange(len(at)), size[at])
            cell = np.arange(len(row)) + np.repeat(starts[at] - (np.cumsum(size[at]) - size[at]), size[at])
            theta = np.zeros((len(at), CLASSES))
            theta[row, classes[cell]] = values[cell]
            history, cls = code // CLASSES, code % CLASSES
            gain[lo:lo + 4096] = held.value.with_weights(history, theta, cls) - held.value.logs[history, cls]
        out[found] = gain[place]
        return out

    text_names = ["uid", "key", "held_out", *(c.split()[0] for c in TOLD)]

    def fill(rows):
        for c in SUMS:
            if c.split()[0] not in rows.column_names:
                rows = rows.append_column(c.split()[0], pa.nulls(len(rows), pa.binary()))
        return rows

    def run(asked):
        texts = asked.filter(pc.is_null(asked["kind"]))
        out = [[], [], [], []]
        for what in (REST, PAIRS, LASTS):
            rows, table = (asked.filter(pc.equal(asked["kind"], kind)) for kind in (what, what + TABLE))
            if not len(rows) or not len(table):
                continue
            names = np.concatenate([unpacked_names(b) for b in rows["names"].to_pylist()])
            uids = np.concatenate([unpacked(b) for b in rows["uids"].to_pylist()])
            zero = np.zeros(len(names))
            if what == LASTS:
                added = zero, zero, gains(names, np.concatenate([unpacked(b) for b in rows["codes"].to_pylist()]), table)
            else:
                key = np.concatenate([unpacked_names(b) for b in table["names"].to_pylist()])
                value = np.concatenate([unpacked(b).view(float) for b in table["values"].to_pylist()])
                order = np.argsort(key)
                key, value = key[order], value[order]
                if what == REST:
                    found, at = find(key, names)
                    added = found, np.where(found, np.log10(value[at] + SMOOTH) - np.log10(SMOOTH), 0), zero
                else:
                    asks = names, block_names(blocks_of(names))
                    added = zero, zero, sum(np.where(f, value[at], 0) for f, at in (find(key, x) for x in asks))
            for o, x in zip(out, (uids, *added)):
                o.append(x)
        of_texts = texts.select(["part", *text_names])
        if not out[0]:
            return fill(of_texts)
        uids, place = np.unique(np.concatenate(out[0]), return_inverse=True)
        sums = [np.bincount(place, weights=np.concatenate(o), minlength=len(uids)) for o in out[1:]]
        part, *blobs = zip(*dealt(np.mod(uids, parts), uids, *sums))
        more = pa.table([pa.array(part, pa.int32()), *(pa.array(b, pa.binary()) for b in blobs)], ["part", *(c.split()[0] for c in SUMS)])
        return fill(pa.concat_tables([of_texts, more], promote_options="default"))

    def add(rows):
        """The texts of a part with the sums of what was added to them."""
        texts, more = rows.filter(pc.is_valid(rows["uid"])).combine_chunks(), rows.filter(pc.is_null(rows["uid"]))
        order = np.argsort(np.asarray(texts["uid"]))
        texts = texts.take(pa.array(order))
        sums = np.zeros((len(ADDED), len(texts)))
        for row in more.select([c.split()[0] for c in SUMS]).to_pylist():
            at = np.searchsorted(np.asarray(texts["uid"]), unpacked_names(row["uids"]))
            for i, c in enumerate(ADDED):
                sums[i, at] += unpacked(row[c.split()[0]]).view(float)
        columns = [pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2])]
        return pa.Table.from_arrays([*(texts[c] for c in text_names), *columns], [*text_names, *(c.split()[0] for c in ADDED)])

    kind = told.schema["key"].dataType.simpleString()
    of_text = f"uid long, key {kind}, held_out boolean, {', '.join(TOLD)}"
    summed = told.groupBy("part").applyInArrow(run, f"part int, {of_text}, {', '.join(SUMS)}")
    return summed.groupBy("part").applyInArrow(add, f"{of_text}, {', '.join(ADDED)}")


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", common: int = 200_000, **options) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document;
    learns from the rows whose crc32(key) mod 10 is not 0."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"),
                       (crc_of_id(F.col(f"`{key}`")) % 10 == 0).alias("held_out"))
    training = rows.where(~F.col("held_out"))
    counts = stage(count_tokens(training).groupBy("token").agg(F.sum("n").alias("n")), "token-counts")
    sums = counts.groupBy(F.pmod("token", F.lit(SHARED)).alias("s")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    total = {"n": sum(r["n"] for r in sums), "v": sum(r["v"] for r in sums)}
    frequent = counts.orderBy(F.desc("n"), "token").limit(max(common, SINGLES)).toArrow()
    vocabulary = spark.sparkContext.broadcast(Vocabulary(
        frequent, total["n"], total["v"], {r["s"]: r["n"] + SMOOTH * r["v"] for r in sums}))
    trained = train(training, counts, vocabulary, **options)
    told = read(with_uid(rows), vocabulary, trained.held)
    token, n = (frequent[c][-1].as_py() if len(frequent) else 0 for c in ("token", "n"))
    beyond = counts.where((F.col("n") < n) | ((F.col("n") == n) & (F.col("token") > token)))
    out = answers(told, beyond, trained, vocabulary.value.parts)
    # every token beyond the common ones counts as unknown first; the tables add what the known ones have on top
    beyond = (F.col("n_tokens") - F.col("n_common")) * F.log10(F.lit(SMOOTH)) + F.col("more")
    below = math.log10(total["n"] + SMOOTH * (total["v"] + 1))
    return out.select(
        F.col("key").alias(key), "held_out", F.col("n_tokens"),
        (F.col("n_common") + F.col("known")).cast("long").alias("n_known"),
        F.lit(total["n"]).cast("long").alias("train_tokens"),
        (F.col("common_log") + beyond - F.col("n_tokens") * F.lit(below)).alias("base_score"),
        (F.col("score_part") + beyond + F.col("weights") / F.lit(LN10)).alias("score"))
