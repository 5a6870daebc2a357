"""Operator 10: exact top-k inner products by an impact-ordered, score-at-a-time index.

A component x becomes the integer floor(scale * x).  Vectors are dealt into
blocks of bounded size.  In each block every dimension's postings are sorted by
value and cut into segments of one quantised impact level.  For a query, a
posting adds query component times value over the dimension's least, and the
segments are processed in descending order of the most they add.  What a
vector can still gain is at most the sum of the greatest impacts left in each
dimension.  Processing stops only on proof: once all but a few vectors cannot
reach the k-th best of what is surely gained.  The possible members are then
scored exactly.  (Dense vectors have a posting in every dimension, so proof
comes late; nothing is skipped before it.)

Every block answers every query (queries come in chunks, blocks stay where
they are); the k best of all blocks are merged with a partial limit.

Defined cases: vectors that are null, or hold null or non-finite components,
take no part; vectors of different lengths are not compared (their score is
undefined); empty vectors score 0 with one another; ties go to the smaller id,
a null id last; a query with fewer than k candidates gets them all; rows with
equal ids are rows of their own, and only the query's own row is left out; an
empty table gives an empty result.  Components of any finite size count
exactly: where a block's and a chunk's greatest could leave 64 bits, the same
index runs on Python integers.  Ranks are then still exact, and a score that
no long can hold is null.  Only the id and vector columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage, with_uid

LEVELS = 16
BLOCK = 16_384
CHUNK = 256
WIDE_CELLS = 1 << 20  # cells of a block that may need Python integers
BELOW = -(1 << 2200)  # under every sum of products of doubles


def usable(vector: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    v = F.col(f"`{vector}`")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & finite, F.lit(False))


def integers(values: np.ndarray, scale: int, wide: bool) -> np.ndarray:
    """floor(scale * value): 64-bit integers, or Python's if ``wide``."""
    if not wide:
        return np.floor(values * scale).astype(np.int64)
    with np.errstate(over="ignore"):
        whole = np.floor(values * scale)
    # a product beyond the doubles comes from a value that is itself an integer
    exact = [int(w) if np.isfinite(w) else int(x) * scale for w, x in zip(whole.ravel().tolist(), values.ravel().tolist())]
    out = np.empty(len(exact), object)
    out[:] = exact
    return out.reshape(values.shape)


def leaves_long(dims: int, one: float, other: float) -> bool:
    """Whether sums over ``dims`` products of integers up to these sizes may come near 64 bits."""
    return dims * (one + 1) * (other + 1) >= 2.0 ** 60


class ImpactIndex:
    """Impact-ordered segments of one block of integer vectors (rows x dimensions)."""

    def __init__(self, vectors: np.ndarray, levels: int = LEVELS):
        self.vectors = vectors
        n, dims = vectors.shape
        self.order = np.ascontiguousarray(np.argsort(vectors, axis=0, kind="stable").T)
        self.ranked = np.take_along_axis(vectors.T, self.order, axis=1)
        self.least, self.most = self.ranked[:, 0], self.ranked[:, -1]
        dim, first, end = [], [], []  # of each segment: its dimension, first and end posting
        for d in range(dims):
            span = int(self.most[d] - self.least[d]) + 1
            level = (self.ranked[d] - self.least[d]) * levels // span
            cuts = np.flatnonzero(np.diff(level)) + 1
            first.append(np.concatenate([[0], cuts]))
            end.append(np.concatenate([cuts, [n]]))
            dim.append(np.full(len(cuts) + 1, d))
        self.dim, self.first, self.end = np.concatenate(dim), np.concatenate(first), np.concatenate(end)
        self.low, self.high = self.ranked[self.dim, self.first], self.ranked[self.dim, self.end - 1]
        self.start = np.searchsorted(self.dim, np.arange(dims + 1))  # each dimension's first segment

    def top(self, query: np.ndarray, k: int, own: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(rows, exact scores) of every vector that can be among the k best, unordered.

        ``own``: a row to leave out.  A vector's accumulator holds what its seen postings
        add over each dimension's least; what it lacks of its score lies between nothing
        and the sum over the dimensions of the greatest impact not yet processed."""
        n = len(self.vectors)
        floor = np.minimum(query * self.least, query * self.most)
        gained = np.zeros(n, self.vectors.dtype)
        if own is not None:
            gained[own] = BELOW if gained.dtype == object else np.iinfo(np.int64).min // 2
        few, unseen = max(4 * k, n // 64), 0
        for spans, unseen, last in self.rounds(query, floor):
            for d, first, end in spans:
                np.add.at(gained, self.order[d, first:end], query[d] * self.ranked[d, first:end] - floor[d])
            if not last and np.count_nonzero(gained + unseen >= self._kth(gained, k)) <= few:
                break
        members = np.flatnonzero(gained + unseen >= self._kth(gained, k))
        if own is not None:
            members = members[members != own]
        return members, self.vectors[members] @ query

    def rounds(self, query: np.ndarray, floor: np.ndarray):
        """(postings, what is unseen after them, whether they are the last) of each round: the segments
        next in descending order of impact, half of all and then a quarter of the rest.  Those of one
        dimension lie side by side in a round, so they are one span (dimension, first, end)."""
        q = query[self.dim]
        impact = np.maximum(q * self.low, q * self.high) - floor[self.dim]  # a segment's greatest
        turn = np.argsort(-impact, kind="stable")
        turn = turn[impact[turn] > 0]  # postings at their dimension's least add nothing
        dims, up, sizes = len(query), query > 0, np.bincount(self.dim[turn], minlength=len(query))
        done, at, total = np.zeros(dims, np.int64), 0, len(turn)
        while at < total:
            end = min(total, at + (total - at + 1) // 4 + 1 if at else total // 2 + 1)
            now = done + np.bincount(self.dim[turn[at:end]], minlength=dims)
            some = np.flatnonzero(now > done)
            # greatest values first for a positive component, least first for a negative one
            low = np.where(up, self.start[1:] - now, self.start[:-1] + done)[some]
            high = np.where(up, self.start[1:] - done, self.start[:-1] + now)[some] - 1
            left = np.flatnonzero(now < sizes)
            ahead = np.where(up, self.start[1:] - now - 1, self.start[:-1] + now)[left]
            spans = zip(some.tolist(), self.first[low].tolist(), self.end[high].tolist())
            yield spans, int(impact[ahead].sum()), end == total
            done, at = now, end

    @staticmethod
    def _kth(lower: np.ndarray, k: int) -> int:
        return np.partition(lower, len(lower) - k)[len(lower) - k] if len(lower) >= k else BELOW if lower.dtype == object else np.iinfo(np.int64).min


def usable_rows(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(uid, id, dims, v) of every usable row; an empty vector is held as one component 0."""
    v = F.col(f"`{vector}`").cast("array<double>")
    rows = vectors.where(usable(vector)).select(F.col(f"`{key}`").cast("long").alias("id"), v.alias("v"))
    held = F.when(F.size("v") > 0, F.col("v")).otherwise(F.array(F.lit(0.0)))
    return with_uid(rows).select("uid", "id", F.size("v").alias("dims"), held.alias("v"))


def _packed(rows: DataFrame, group: list[str]) -> DataFrame:
    """One row per group of vectors: uids, ids (null: greatest long), and the matrix of components, as binaries."""
    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("uid")
        ids = table.column("id").fill_null(np.iinfo(np.int64).max)
        blobs = [np.asarray(table.column("uid")).astype("<i8"), np.asarray(ids).astype("<i8"), np.asarray(table.column("v").combine_chunks().flatten()).astype("<f8")]
        return pa.table({**{g: table.column(g)[:1] for g in group},
                         **{name: pa.array([b.tobytes()], pa.binary()) for name, b in zip(("uids", "ids", "vs"), blobs)}})

    kinds = ", ".join(f"{g} {rows.schema[g].dataType.simpleString()}" for g in group)
    return rows.groupBy(*group).applyInArrow(pack, f"{kinds}, uids binary, ids binary, vs binary")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, key: str = "vec_id",
          vector: str = "embedding", block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for every row for which ``is_query`` (over ``id``) holds."""
    held = stage(usable_rows(vectors, key, vector), "usable-rows")
    queries = held.where(is_query)
    most = F.max(F.array_max(F.transform("v", lambda x: F.abs(x)))) * F.lit(float(scale)) + 1
    sizes = held.groupBy("dims").agg(F.count("*").alias("n"), F.count_if(is_query).alias("q"), most.alias("most"))
    wide = F.greatest("dims", F.lit(1)) * F.col("most") * F.col("most") >= F.lit(2.0 ** 60)
    rows = F.when(wide, F.greatest(F.lit(1), F.least(F.lit(block), F.floor(F.lit(WIDE_CELLS) / F.greatest("dims", F.lit(1)))))).otherwise(block)
    sizes = sizes.select("dims", F.ceil(F.col("n") / rows).cast("int").alias("blocks"), F.ceil(F.col("q") / chunk).cast("int").alias("chunks"))
    sizes = stage(sizes, "sizes")  # a row per vector length
    dealt = held.join(sizes, "dims").select("*", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int").alias("block"))
    index = _packed(dealt.select("dims", "block", "uid", "id", "v"), ["dims", "block"])
    asked = queries.join(sizes, "dims").select("*", F.pmod(F.xxhash64("uid"), F.col("chunks")).cast("int").alias("chunk"))
    asked = _packed(asked.select("dims", "chunk", "uid", "id", "v"), ["dims", "chunk"])
    spread = asked.join(sizes, "dims").select(
        "dims", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.col("uids").alias("q_uids"), F.col("ids").alias("q_ids"), F.col("vs").alias("q_vs"))
    names = ["query_uid", "query_id", "id", "uid", "score", "digits"]

    def run(batches):
        last, indexes = None, {}
        for batch in batches:
            for r in range(batch.num_rows):
                dims, place, uids, ids, vs, q_uids, q_ids, q_vs = (batch.column(c)[r].as_py() for c in range(8))
                if last != (dims, place):
                    last, indexes = (dims, place), {}
                    held_uids, held_ids = np.frombuffer(uids, "<i8"), np.frombuffer(ids, "<i8")
                    at = {u: i for i, u in enumerate(held_uids.tolist())}
                    values = np.frombuffer(vs, "<f8").reshape(len(at), -1)
                    greatest = float(np.abs(values).max()) * scale
                asked_uids = np.frombuffer(q_uids, "<i8").tolist()
                q_values = np.frombuffer(q_vs, "<f8").reshape(len(asked_uids), -1)
                wide = leaves_long(max(dims, 1), greatest, float(np.abs(q_values).max()) * scale)
                if wide not in indexes:
                    indexes[wide] = ImpactIndex(integers(values, scale, wide))
                out = []
                for u, i, q in zip(asked_uids, np.frombuffer(q_ids, "<i8").tolist(), integers(q_values, scale, wide)):
                    rows, scores = indexes[wide].top(q, k, at.get(u))
                    best = np.lexsort((held_uids[rows], held_ids[rows], -scores))[:k]
                    out.extend((u, i, held_ids[rows[b]].item(), held_uids[rows[b]].item(), *_sortable(int(scores[b]))) for b in best)
                columns = list(zip(*out)) if out else [[]] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.string() if n == "digits" else pa.int64()) for n, c in zip(names, columns)], names)

    pairs = index.join(spread, ["dims", "block"]).select("dims", "block", "uids", "ids", "vs", "q_uids", "q_ids", "q_vs")
    best = pairs.mapInArrow(run, "query_uid long, query_id long, id long, uid long, score long, digits string")
    order = Window.partitionBy("query_uid").orderBy(F.desc("score"), F.desc("digits"), "id", "uid")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    named = F.when(F.col("id") != np.iinfo(np.int64).max, F.col("id"))
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), named.alias(key),
                         F.when(F.col("digits").isNull(), F.col("score")).alias("score"))


def _sortable(score: int) -> tuple[int, str | None]:
    """A score as a long; one beyond the longs as the nearest and digits that sort like it."""
    limit = (1 << 63) - 1
    if abs(score) < limit:
        return score, None
    return (limit if score > 0 else -limit), f"{score - BELOW:0552x}"
