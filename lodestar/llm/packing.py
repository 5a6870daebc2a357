"""Operator 2: packing documents into training sequences by a grouping genetic algorithm.

A document is its token ids and an end id; longer ones are cut into pieces of
``capacity`` ids of which the first may be shorter.  Pieces are packed into as
few sequences as possible:

* Pieces are dealt by hash into cells of about ``cell`` pieces, so every cell
  is a sample of all lengths and of bounded size.
* A cell's islands each hold a population of packings, starting from
  best-fit-decreasing and from best fits in disturbed orders.  Crossover
  injects whole well-filled sequences of one parent into the other, removes
  the sequences that now hold duplicates, and puts the displaced pieces back
  by best fit.  After each epoch every island passes its elite to the next one
  in a ring.  An island stops when it meets the cell's lower bound.
* Sequences that stay poorly filled are opened again; their pieces are dealt
  into fewer, new cells, until one cell is left or nothing improves.

All random choices come from the cell, island and epoch numbers, so a task
that is run again gives the same packing.

Defined cases: a null text counts as empty and is packed as its end id alone;
equal documents are packed separately; an empty table gives an empty result.
Only the key and text columns are read.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import read_definition, tokenizer_of
from .common import stage, with_uid
from .pieces import slices

GOOD = 0.995  # a sequence filled to this share is kept when cells are dealt anew


def cut(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0,
        key: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32 (and ids, if asked for)."""
    definition = docs.sparkSession.sparkContext.broadcast(read_definition(tokenizer_path))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        tokenizer = tokenizer_of(definition.value)
        for batch in batches:
            for lo, hi in slices(batch.column(1), 2_000_000):
                rows, numbers, starts, lengths, crcs, bodies = [], [], [], [], [], []
                for row, body in enumerate(tokenizer.encode(batch.column(1)[lo:hi].to_pylist())):
                    body += end
                    total = len(body) // 4
                    at, piece = 0, 0
                    size = total % capacity or capacity
                    while at < total:
                        part = body[4 * at:4 * (at + size)]
                        rows.append(lo + row)
                        numbers.append(piece)
                        starts.append(at)
                        lengths.append(size)
                        crcs.append(zlib.crc32(part))
                        if keep_ids:
                            bodies.append(np.frombuffer(part, "<u4").astype("<i4"))
                        at, piece, size = at + size, piece + 1, capacity
                columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int32()),
                           pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64())]
                names = [key, "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    columns.append(pa.array(bodies, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    source = docs.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").cast("string").alias("text"))
    kind = source.schema[key].dataType.simpleString()
    return source.mapInArrow(run, f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long"
                             + ", ids array<int>" * keep_ids)


# -- one cell ------------------------------------------------------------------

class Packing:
    """Sequences of items: ``bins`` lists of item numbers, ``fill`` their lengths."""

    def __init__(self, bins: list[list[int]], fill: list[int]):
        self.bins, self.fill = bins, fill

    def fitness(self, capacity: int) -> tuple[int, float]:
        """Fewer sequences first, then fuller ones (mean squared fill)."""
        return -len(self.bins), sum((f / capacity) ** 2 for f in self.fill) / max(1, len(self.fill))

    def assignment(self, n: int) -> np.ndarray:
        out = np.zeros(n, "<i4")
        for number, items in enumerate(self.bins):
            out[items] = number
        return out

    @staticmethod
    def of(assignment: np.ndarray, lengths: list[int]) -> Packing:
        order = np.argsort(assignment, kind="stable")
        edges = np.flatnonzero(np.diff(assignment[order])) + 1
        bins = [part.tolist() for part in np.split(order, edges)] if len(order) else []
        return Packing(bins, [sum(lengths[i] for i in b) for b in bins])


def best_fit(packing: Packing, items: list[int], lengths: list[int], capacity: int) -> Packing:
    """Put each item into the sequence with the least room that still holds it, in place."""
    rooms = sorted((capacity - f, b) for b, f in enumerate(packing.fill) if f < capacity)
    for item in items:
        size = lengths[item]
        at = bisect.bisect_left(rooms, (size, -1))
        if at < len(rooms):
            room, b = rooms.pop(at)
            packing.bins[b].append(item)
            packing.fill[b] += size
        else:
            b, room = len(packing.bins), capacity
            packing.bins.append([item])
            packing.fill.append(size)
        if room > size:
            bisect.insort(rooms, (room - size, b))
    return packing


def crossover(a: Packing, b: Packing, lengths: list[int], capacity: int, rng: np.random.Generator) -> Packing:
    """``a`` with whole well-filled sequences of ``b`` injected."""
    full = [i for i, f in enumerate(b.fill) if f >= GOOD * capacity] or list(range(len(b.bins)))
    start = int(rng.integers(len(full)))
    count = max(1, int(len(full) * rng.uniform(0.1, 0.5)))
    chosen = [full[(start + i) % len(full)] for i in range(count)]
    injected = {item for i in chosen for item in b.bins[i]}
    bins, fill, displaced = [list(b.bins[i]) for i in chosen], [b.fill[i] for i in chosen], []
    slack = int(capacity * rng.uniform(0.95, 1.0))
    for items, f in zip(a.bins, a.fill):
        if f < slack or not injected.isdisjoint(items):  # poorly filled sequences are opened as well
            displaced.extend(i for i in items if i not in injected)
        else:
            bins.append(list(items))
            fill.append(f)
    displaced.sort(key=lambda i: -lengths[i])
    return best_fit(Packing(bins, fill), displaced, lengths, capacity)


def evolve(lengths: list[int], capacity: int, seeds: list[np.ndarray], rng: np.random.Generator,
           population: int = 4, generations: int = 5) -> Packing:
    """One island's epoch; ``seeds``: its own elite and the one that migrated here."""
    least = -(-sum(lengths) // capacity)
    people = [Packing.of(s, lengths) for s in seeds]
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    if not people:
        people.append(best_fit(Packing([], []), order, lengths, capacity))
    rank = lambda p: p.fitness(capacity)
    while len(people) < population and len(max(people, key=rank).bins) > least:
        noise = rng.uniform(0.8, 1.2, len(lengths))
        disturbed = sorted(range(len(lengths)), key=lambda i: -lengths[i] * noise[i])
        people.append(best_fit(Packing([], []), disturbed, lengths, capacity))
    for _ in range(generations):
        people.sort(key=rank, reverse=True)
        if len(people[0].bins) <= least or len(people) < 2:
            break
        i, j = rng.choice(len(people), 2, replace=False)
        children = [crossover(people[0], people[int(max(i, 1))], lengths, capacity, rng),
                    crossover(people[int(i)], people[int(j)], lengths, capacity, rng)]
        people = sorted(people + children, key=rank, reverse=True)[:population]
    return max(people, key=rank)


# -- all cells -----------------------------------------------------------------

def _epoch(rows: DataFrame, capacity: int, epoch: int, turn: int) -> DataFrame:
    """One epoch of every island; ``rows``: (cell, island, lengths, own, migrant)."""
    def run(batches):
        for batch in batches:
            out, bins, fits = [], [], []
            for cell, island, packed, own, migrant in zip(*(batch.column(i).to_pylist() for i in range(5))):
                lengths = np.frombuffer(packed, "<i4").tolist()
                seeds = [np.frombuffer(s, "<i4") for s in (own, migrant) if s is not None]
                rng = np.random.default_rng([turn, epoch, cell, island])
                best = evolve(lengths, capacity, seeds, rng)
                out.append(best.assignment(len(lengths)).tobytes())
                bins.append(len(best.bins))
                fits.append(best.fitness(capacity)[1])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(3)), pa.array(out, pa.binary()), pa.array(bins, pa.int64()), pa.array(fits, pa.float64())],
                ["cell", "island", "lengths", "own", "bins", "fit"])

    return rows.mapInArrow(run, "cell long, island int, lengths binary, own binary, bins long, fit double")


def _solve(items: DataFrame, cells: int, capacity: int, islands: int, epochs: int, turn: int) -> DataFrame:
    """(cell, uids, lengths, own): the best packing found of each cell."""
    dealt = items.select(F.pmod(F.xxhash64(F.lit(turn), "uid"), F.lit(cells)).alias("cell"), "uid", "length")
    gathered = dealt.groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("uid", "length"))).alias("items"))

    def pack(batches):
        for batch in batches:
            lists = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([np.array([x["uid"] for x in items], "<i8").tobytes() for items in lists], pa.binary()),
                 pa.array([np.array([x["length"] for x in items], "<i4").tobytes() for items in lists], pa.binary())],
                ["cell", "uids", "lengths"])

    packed = stage(gathered.mapInArrow(pack, "cell long, uids binary, lengths binary"), "cells")
    ring = packed.select("cell", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), "lengths")
    partitions = max(1, min(cells * islands, 4096))
    none = F.lit(None).cast("binary")
    state = stage(_epoch(ring.repartition(partitions, "cell", "island").select("cell", "island", "lengths", none.alias("own"), none.alias("migrant")), capacity, 0, turn), "islands")
    for epoch in range(1, epochs):
        elite = state.select("cell", ((F.col("island") + 1) % islands).cast("int").alias("island"), F.col("own").alias("migrant"))
        state = stage(_epoch(state.join(elite, ["cell", "island"]).select("cell", "island", "lengths", "own", "migrant"),
                             capacity, epoch, turn), "islands")
    best = state.groupBy("cell").agg(F.max_by("own", F.struct(-F.col("bins"), "fit", -F.col("island"))).alias("own"))
    return packed.join(best, "cell")


def _places(solved: DataFrame, capacity: int, turn: int, final: bool) -> DataFrame:
    """(uid, length, sequence_id, offset); sequence_id is null for pieces to be dealt anew."""
    def run(batches):
        for batch in batches:
            for cell, uids, lengths, own in zip(*(batch.column(i).to_pylist() for i in range(4))):
                uids, lengths, own = np.frombuffer(uids, "<i8"), np.frombuffer(lengths, "<i4").astype("<i8"), np.frombuffer(own, "<i4")
                order = np.argsort(own, kind="stable")
                ends = np.cumsum(lengths[order])
                new = np.ones(len(order), bool)
                new[1:] = own[order][1:] != own[order][:-1]
                begin = (ends - lengths[order])[new]
                offset = ends - lengths[order] - np.repeat(begin, np.diff(np.append(np.flatnonzero(new), len(order))))
                fill = np.bincount(own, weights=lengths)[own[order]]
                number = (turn << 56) + (cell << 24) + own[order].astype("<i8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uids[order]), pa.array(lengths[order]),
                     pa.array(number, mask=(fill < GOOD * capacity) & (not final)), pa.array(offset)],
                    ["uid", "length", "sequence_id", "offset"])

    return solved.select("cell", "uids", "lengths", "own").mapInArrow(
        run, "uid long, length long, sequence_id long, offset long")


def place(items: DataFrame, capacity: int = 2048, cell: int = 4096, islands: int = 3, epochs: int = 2,
          turns: int = 4) -> DataFrame:
    """(uid, sequence_id, offset) of every row (uid, length) of ``items``."""
    done = None
    count = items.count()
    for turn in range(turns):
        cells = max(1, -(-count // cell))
        final = cells == 1 or turn == turns - 1
        placed = stage(_places(_solve(items, cells, capacity, islands, epochs, turn), capacity, turn, final), "places")
        kept = placed.where("sequence_id is not null").select("uid", "sequence_id", "offset")
        done = kept if done is None else done.union(kept)
        items = placed.where("sequence_id is null").select("uid", "length")
        if final:
            break
        count = items.count()
        if not count:
            break
    return done


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, key: str = "doc_id",
         text: str = "text", keep_ids: bool = False, **options) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, (ids,) sequence_id, offset."""
    pieces = stage(with_uid(cut(docs, tokenizer_path, capacity, end_id, key, text, keep_ids)), "pieces")
    placed = place(pieces.select("uid", "length"), capacity, **options)
    return pieces.join(placed, "uid").drop("uid")
