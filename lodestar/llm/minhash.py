"""Operator 8: near-duplicates by ProbMinHash, banding and exact verification.

A text's weighted set holds its runs of five words, weighted by how often each
occurs (a shorter text is one run of all its words).  Similarity is the
probability Jaccard index J_P of two such sets; it equals the plain Jaccard
index where every run occurs once.  Texts are linked if J_P >= ``threshold``.

* Signature: every element sends a Poisson process of rate = weight; each
  arrival falls on one of ``bands * rows`` registers, which keep their first
  arrival.  An element stops at its first arrival later than all registers'
  (early termination).  Two registers agree with probability J_P.
* Banding: texts that agree on all registers of a band meet in a bucket.
  With 30 bands of 5 a pair at J_P = 0.8 is missed with probability 7e-6.
* Linking within buckets, without forming all pairs: first every text is
  compared with its bucket's smallest (a star).  Texts found alike join one
  component.  Buckets whose texts lie in one component are done.  In the
  rest, texts of different components are compared by their signatures, block
  against block; only those that agree on enough registers become pairs.  In
  the first rounds each text names just the most alike text of another
  component, so a large group grows together before its pairs are listed; the
  last round lists every pair still between components.
* Verification: J_P is computed exactly for every pair.

Texts that are equal are one vertex (named by a 128-bit digest) throughout and
are never paired with each other.  Classes are the connected components.

Defined cases: null texts and texts without words are alone in their class;
equal texts are one class; the class id is the smallest key in it, its
representative (``kept``) the first row by (key, row); a null key comes last;
rows that repeat wholly still give one row each, one of them kept; an empty
table gives an empty result.  Only the key and text columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.operators.sizing import join_small

from .common import release, stage, with_uid
from .components import components
from .words import U, mix, ranges, split, text_slices, windows, WORD_BASES

BLOCK = 512  # texts of a bucket compared with each other in one go
ROUNDS = 1  # rounds in which a text names its most alike text of another component, before all such pairs
FINE = 512  # registers, kept as bytes, by which the texts of such buckets are compared


def digest(text: str) -> Column:
    """128-bit name of a text; null for a text without words."""
    body = F.col(f"`{text}`").cast("string")
    return F.when(body.rlike(r"[^\x20\x09-\x0D]"), F.unhex(F.md5(body.cast("binary"))))


def weighted_runs(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, run hash, count) of the distinct runs of each text, ordered by text."""
    words = split(texts)
    hashes = words.hashes()
    at, runs = windows(words, hashes, width)
    owner = words.texts_of_words()[at]
    counts = np.diff(words.first)
    short = np.flatnonzero((counts > 0) & (counts < width))
    owner = np.concatenate([owner, short])
    runs = np.concatenate([runs, ranges(hashes, words.first[short], words.first[short + 1], WORD_BASES[0])])
    # equal (text, run) pairs become neighbours under one 64-bit sort key
    order = np.argsort(runs ^ mix(owner.astype(U) + U(0x5851F42D4C957F2D)), kind="stable")
    owner, runs = owner[order], runs[order]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:] != runs[:-1]) | (owner[1:] != owner[:-1])
    firsts = np.flatnonzero(new)
    weights = np.diff(np.append(firsts, len(runs)))
    owner, runs = owner[firsts], runs[firsts]
    by_text = np.argsort(owner, kind="stable")
    return owner[by_text], runs[by_text], weights[by_text]


def signatures(owner: np.ndarray, runs: np.ndarray, weights: np.ndarray, texts: int, registers: int) -> np.ndarray:
    """ProbMinHash registers (texts x registers, uint64 names of the winning runs)."""
    first = np.full(texts * registers, np.inf)
    names = np.zeros(texts * registers, U)
    base = owner.astype(np.int64) * registers
    rate = weights.astype(float)
    arrival = np.zeros(len(runs))
    name, state, text = runs, runs.copy(), owner
    while len(name):
        state = mix(state + U(0x9E3779B97F4A7C15))
        arrival = arrival - np.log(((state >> U(11)).astype(float) + 0.5) * 2.0 ** -53) / rate
        place = base + (mix(state ^ U(0xDA942042E4DD58B5)) % U(registers)).astype(np.int64)
        np.minimum.at(first, place, arrival)
        won = arrival == first[place]
        names[place[won]] = name[won]
        latest = first.reshape(texts, registers).max(axis=1)
        live = arrival < latest[text]  # a process past every register is over
        name, state, text, base, rate, arrival = (x[live] for x in (name, state, text, base, rate, arrival))
    return names.reshape(texts, registers)


def bands_of(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One bucket name per text and band."""
    parts = signature.reshape(len(signature), bands, rows)
    salt = mix(np.arange(bands * rows, dtype=U).reshape(bands, rows) + U(1)) | U(1)
    return mix((mix(parts) * salt).sum(axis=2, dtype=U) + np.arange(bands, dtype=U))


def sign(docs: DataFrame, width: int, bands: int, rows: int, text: str = "text") -> DataFrame:
    """(node, buckets) of every distinct text of a batch of ``docs``."""
    def run(batches):
        release()
        for batch in batches:
            for lo, hi in text_slices(batch.column(1)):
                nodes = batch.column(0)[lo:hi].to_pylist()
                seen: dict = {}
                for i, node in enumerate(nodes):
                    seen.setdefault(node, i)
                rows_of = pa.array(list(seen.values()), pa.int64())
                texts = batch.column(1)[lo:hi].take(rows_of)
                owner, runs, weights = weighted_runs(texts, width)
                found = signatures(owner, runs, weights, len(texts), bands * rows)
                buckets = bands_of(found, bands, rows).astype("<i8")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi].take(rows_of),
                     pa.ListArray.from_arrays(np.arange(0, buckets.size + 1, bands, dtype="i4"), pa.array(buckets.ravel()))],
                    ["node", "buckets"])

    source = docs.select(digest(text).alias("node"), F.col(f"`{text}`").cast("string").alias("text")).where("node is not null")
    return source.mapInArrow(run, "node binary, buckets array<long>")


def fine_signatures(texts: DataFrame, width: int) -> DataFrame:
    """(node, sig): ``FINE`` registers of every text of ``texts`` (node, text), a byte each."""
    def run(batches):
        release()
        for batch in batches:
            for lo, hi in text_slices(batch.column(1)):
                owner, runs, weights = weighted_runs(batch.column(1)[lo:hi], width)
                found = signatures(owner, mix(runs), weights, hi - lo, FINE)
                short = (found >> U(56)).astype(np.uint8)  # a byte tells different runs apart 255 times in 256
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], pa.array([s.tobytes() for s in short], pa.binary())], ["node", "sig"])

    return texts.select("node", "text").mapInArrow(run, "node binary, sig binary")


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact J_P of two weighted sets given as (sorted names, weights)."""
    common, at_a, at_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    x, y = a[1][at_a].astype(float), b[1][at_b].astype(float)
    ratio = x / y
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    alone_x, alone_y = a[1].sum() - x.sum(), b[1].sum() - y.sum()
    # of a pair i, terms j with ratio_j >= ratio_i take x_j / x_i, the others y_j / y_i
    below = np.searchsorted(ratio, ratio, "left")
    y_below = np.concatenate([[0.0], np.cumsum(y)])[below] + alone_y
    x_from = x.sum() - np.concatenate([[0.0], np.cumsum(x)])[below] + alone_x
    return float((1.0 / (x_from / x + y_below / y)).sum())


def _weighted_set(text: str, width: int) -> tuple[np.ndarray, np.ndarray]:
    _, runs, weights = weighted_runs(pa.array([text], pa.string()), width)
    order = np.argsort(runs)
    return runs[order], weights[order]


def verify(pairs: DataFrame, texts: DataFrame, width: int, threshold: float) -> DataFrame:
    """The rows (u, v) of ``pairs`` whose texts have J_P >= threshold; ``texts``: (node, text)."""
    def run(batches):
        held: dict = {}

        def set_of(node: bytes, text: pa.Scalar):
            if node not in held:
                if len(held) >= 1000:
                    held.clear()
                held[node] = _weighted_set(text.as_py(), width)
            return held[node]

        for batch in batches:
            kept = [probability_jaccard(set_of(u, text_u), set_of(v, text_v)) >= threshold - 1e-12
                    for u, v, text_u, text_v in zip(*(batch.column(c).to_pylist() for c in (0, 1)), batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(pa.array(kept, pa.bool_())) for c in (0, 1)], ["u", "v"])

    joined = (pairs.join(texts.select(F.col("node").alias("u"), F.col("text").alias("text_u")), "u")
              .join(texts.select(F.col("node").alias("v"), F.col("text").alias("text_v")), "v"))
    return joined.select("u", "v", "text_u", "text_v").mapInArrow(run, "u binary, v binary")


def texts_of(nodes: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """(node, text) of the given distinct nodes, one row each."""
    named = docs.select(digest(text).alias("node"), F.col(f"`{text}`").cast("string").alias("text")).where("node is not null")
    return join_small(named, nodes, ["node"], "left_semi", materialized=True).groupBy("node").agg(F.first("text").alias("text"))


def _blocks(members: DataFrame, threshold: float, best_only: bool) -> DataFrame:
    """Pairs (u, v) that agree on enough registers among the members (bucket, node, root, sig,
    buckets) of different roots; with ``best_only`` each member names only its best partner in
    a block.

    A large bucket is cut into blocks, compared two by two; no pair is formed in between.
    Texts that share several buckets are compared in the first of them only."""
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n"))
    cut = members.join(sizes, "bucket").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    cut = cut.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    spread = cut.select("bucket", "node", "root", "sig", "buckets", "block", other).select(
        "bucket", "node", "root", "sig", "buckets", "block",
        F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))

    def compare(group: pa.Table) -> pa.Table:
        nodes, roots = group.column("node").to_pylist(), group.column("root").to_pylist()
        sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), np.uint8).reshape(len(nodes), -1)
        names = {r: i for i, r in enumerate(dict.fromkeys(roots))}
        root = np.array([names[r] for r in roots])
        block = group.column("block").to_numpy()
        apart = group.column("lo")[0].as_py() != group.column("hi")[0].as_py()
        bands = np.asarray(group.column("buckets").combine_chunks().flatten()).reshape(len(nodes), -1)
        earlier = bands[:, :int(np.argmax(bands[0] == group.column("bucket")[0].as_py()))]
        registers = sig.shape[1]
        least = registers * (threshold - 4 * (threshold * (1 - threshold) / registers) ** 0.5)  # four deviations below
        out: set[tuple[bytes, bytes]] = set()
        for i in range(len(nodes) if len(names) > 1 else 0):
            ok = root != root[i]
            if apart:
                ok &= block != block[i]
            if not best_only:
                ok[:i] = False
            others = np.flatnonzero(ok)
            others = others[~(earlier[others] == earlier[i]).any(axis=1)]
            agree = (sig[others] == sig[i]).sum(axis=1)
            if best_only:
                others, agree = (others[[agree.argmax()]], agree.max(keepdims=True)) if len(others) else (others, agree)
            out.update((min(nodes[i], nodes[j]), max(nodes[i], nodes[j])) for j in others[agree >= least])
        pairs = sorted(out)
        return pa.table({"u": pa.array([p[0] for p in pairs], pa.binary()), "v": pa.array([p[1] for p in pairs], pa.binary())})

    return spread.groupBy("bucket", "lo", "hi").applyInArrow(compare, "u binary, v binary").distinct()


def classes(docs: DataFrame, text: str = "text", width: int = 5, threshold: float = 0.8,
            bands: int = 30, rows: int = 5) -> DataFrame:
    """(node, root): the class of every distinct text that is linked with another."""
    signed = stage(sign(docs, width, bands, rows, text), "signatures")
    entries = signed.select("node", F.explode("buckets").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
    members = stage(entries.join(shared.select("bucket", F.col("low").alias("u")), "bucket").distinct(), "buckets")
    star = stage(members.where("u <> node").select("u", F.col("node").alias("v")).distinct(), "star-pairs")
    nodes = members.select("node").distinct()
    texts = stage(texts_of(stage(nodes, "bucket-nodes"), docs, text), "bucket-texts")
    links = stage(verify(star, texts, width, threshold), "star-links")
    tested, found, sigs = star, components(links), None
    for turn in range(ROUNDS + 1):
        rooted = members.join(found, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))
        open_buckets = rooted.groupBy("bucket").agg(
            F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("n")).where("a <> b and n > 2")
        # (a bucket of two has had its only pair compared)
        left = stage(rooted.join(open_buckets.select("bucket"), "bucket", "left_semi"), "open-buckets")
        if left.isEmpty():
            break
        if sigs is None:  # later rounds have no other texts
            nodes = left.select("node").distinct()
            own = join_small(signed, nodes, ["node"], "left_semi").groupBy("node").agg(F.first("buckets").alias("buckets"))
            sigs = stage(fine_signatures(texts.join(nodes, "node", "left_semi"), width).join(own, "node"), "fine-signatures")
        pairs = _blocks(left.join(sigs, "node"), threshold, best_only=turn < ROUNDS)
        more = stage(pairs.join(tested, ["u", "v"], "left_anti"), "block-pairs")
        links = links.union(stage(verify(more, texts, width, threshold), "block-links"))
        tested, found = tested.union(more), components(links)
    return found


def _heads(named: DataFrame, found: DataFrame) -> DataFrame:
    """(node, head, class_size) of every distinct text; ``named``: (key, uid, node)."""
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "uid"))
    per_text = named.where("node is not null").groupBy("node").agg(first.alias("head"), F.count("*").alias("n"))
    rooted = per_text.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    per_class = rooted.groupBy("root").agg(F.min("head").alias("head"), F.sum("n").alias("class_size"))
    return rooted.select("node", "root").join(per_class, "root").select("node", "head", "class_size")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: key, class_id (smallest key of its class), class_size, kept."""
    named = stage(with_uid(docs.select(F.col(f"`{key}`").alias("key"), digest(text).alias("node"))), "names")
    out = named.join(_heads(named, classes(docs, text, **options)), "node", "left")
    return out.select(
        F.col("key").alias(key),
        F.when(F.col("head").isNull(), F.col("key")).otherwise(F.col("head.key")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"),
        (F.col("head").isNull() | (F.col("head.uid") == F.col("uid"))).alias("kept"))


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stand for their class: one of each class, all columns."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(f"`{key}`").alias("key"), digest(text).alias("node"))
    held = stage(with_uid(rows), "rows")
    named = held.select("key", "uid", "node")
    heads = _heads(named, classes(held.select("row.*"), text, **options)).where("class_size > 1")
    dropped = named.join(heads.select("node", F.col("head.uid").alias("first")), "node").where("uid <> first").select("uid")
    return join_small(held.select("row", "uid"), dropped, ["uid"], "left_anti").select("row.*")
