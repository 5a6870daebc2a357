"""Operator 6: embedding near-duplicates by product quantisation.

* Equal vectors of a label are one vertex with a multiplicity.
* Vectors of each length are indexed and compared among themselves.
* A coarse quantiser puts each unit vector into the inverted list of its
  nearest centroid; the residual is coded in subspaces (product quantisation)
  and its exact coding error is kept.  Both are trained for each length, on a
  sample of about ``sample`` distinct vectors in all and ``LEAST`` of each
  length; every vector is indexed.
* A vector probes each list whose cell can hold a vector within the distance
  that the threshold allows: the distance to the plane between the two
  centroids proves it.  So no list is left out that could hold a link.
* Within a list, table lookups give the asymmetric distance to every member's
  code.  A member is a candidate unless that distance exceeds the allowed one
  by more than the member's coding error, which again loses nothing.
* Candidates are reranked by the exact cosine in double precision.

Lists and their queries are cut into chunks, compared chunk against chunk, so
a label or list with a third of all vectors is spread over tasks.  Of a
chunk's links only counts per vector and a spanning forest leave the task.

Defined cases: vectors that are null, zero, or hold null or non-finite
components link with nothing, nor do rows without a label; vectors of
different lengths do not link; equal ids are rows of their own; a null id counts as no id for
``component_id``; an empty table gives an empty result.  Only the id, vector
and label columns are read.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, with_uid
from .components import components
from .search import usable

MEMBERS, QUERIES = 1024, 2048  # chunk sizes of a list's members and queries
LEAST = 64  # expected sample of a length, if it has as many distinct vectors
SLACK = 1e-6  # for rounding in the two lossless filters


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of each row to each centre."""
    d = (x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)
    return np.maximum(d, 0)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    k = min(k, len(x))
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        owner = _nearest(x, centres).argmin(1)
        size = np.bincount(owner, minlength=k)
        total = np.zeros_like(centres)
        np.add.at(total, owner, x)
        centres = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centres)
    return np.unique(centres, axis=0)


class ProductQuantiser:
    """Coarse centroids and, per subspace, the centroids of residuals."""

    def __init__(self, sample: np.ndarray, lists: int, subspaces: int = 8, codes: int = 256, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.coarse = _kmeans(sample, lists, rng)
        residual = sample - self.coarse[_nearest(sample, self.coarse).argmin(1)]
        self.parts = np.array_split(np.arange(sample.shape[1]), min(subspaces, sample.shape[1]))
        self.books = [_kmeans(residual[:, p], codes, rng) for p in self.parts]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(list, codes, coding error, squared distances to all coarse centroids) of unit vectors."""
        far = _nearest(x, self.coarse)
        home = far.argmin(1)
        residual = x - self.coarse[home]
        codes = np.stack([_nearest(residual[:, p], b).argmin(1) for p, b in zip(self.parts, self.books)], axis=1)
        rebuilt = np.concatenate([b[codes[:, j]] for j, b in enumerate(self.books)], axis=1)
        return home, codes.astype(np.uint8), np.sqrt(((residual - rebuilt) ** 2).sum(1)), far

    def probes(self, home: np.ndarray, far: np.ndarray, reach: float) -> list[np.ndarray]:
        """The lists that can hold a vector within ``reach`` of each row."""
        apart = np.sqrt(_nearest(self.coarse, self.coarse))[home]
        gap = far - far[np.arange(len(home)), home][:, None]
        near = gap <= 2 * (reach + SLACK) * apart + SLACK
        near[np.arange(len(home)), home] = True
        return [np.flatnonzero(row) for row in near]

    def distances(self, x: np.ndarray, place: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric distances of rows to the coded members of list ``place``."""
        residual = x - self.coarse[place]
        total = np.zeros((len(x), len(codes)), np.float32)
        for j, (p, book) in enumerate(zip(self.parts, self.books)):
            total += _nearest(residual[:, p], book).astype(np.float32)[:, codes[:, j]]
        return np.sqrt(total)


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vertices and roots of the components of links (a, b), roots left out."""
    names, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = place[:len(a)], place[len(a):]
    root = np.arange(len(names))
    while True:
        low = root.copy()
        np.minimum.at(low, i, root[j])
        np.minimum.at(low, j, root[i])
        low = low[low]
        if np.array_equal(low, root):
            break
        root = low
    hung = np.flatnonzero(root != np.arange(len(names)))
    return names[hung], names[root[hung]]


def compare(quantiser: ProductQuantiser, place: int, threshold: float, members: dict, queries: dict):
    """Links of one chunk of a list with one chunk of its queries: (query uid, links) and a forest."""
    reach = math.sqrt(max(0.0, 2 - 2 * threshold))
    count = np.zeros(len(queries["uid"]), np.int64)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lo in range(0, len(count), 256):
        part = slice(lo, lo + 256)
        raw, norm = queries["vector"][part], queries["norm"][part]
        far = quantiser.distances(raw / norm[:, None], place, members["codes"])
        candidate = far <= reach + members["error"][None, :] + 1e-4
        rows, columns = np.flatnonzero(candidate.any(1)), np.flatnonzero(candidate.any(0))
        if not len(rows):
            continue
        cosine = (raw[rows] @ members["vector"][columns].T) / (norm[rows][:, None] * members["norm"][columns])
        linked = candidate[np.ix_(rows, columns)] & (cosine >= threshold)
        linked &= queries["uid"][part][rows][:, None] != members["uid"][columns]
        count[lo + rows] += linked @ members["copies"][columns]
        i, j = np.nonzero(linked)
        a, b = _forest(queries["uid"][part][rows][i], members["uid"][columns][j])
        left.append(a)
        right.append(b)
    return count, *_forest(np.concatenate(left), np.concatenate(right))


def links(distinct: DataFrame, threshold: float, sample: int = 16_384, per_list: int = 4096) -> DataFrame:
    """(u, v, n): a row (uid, null, links) per linked vector and chunk, and rows (u, v, null) of forests.

    ``distinct``: (uid, label, v, copies), no two rows of a label with equal vectors."""
    spark = distinct.sparkSession
    distinct = distinct.withColumn("dims", F.size("v"))
    number = {r["dims"]: r["n"] for r in distinct.groupBy("dims").agg(F.count("*").alias("n")).collect()}  # one row per length
    total = sum(number.values())
    empty = spark.createDataFrame([], "u long, v long, n long")
    if total < 2:
        return empty
    share = F.greatest(F.lit(sample / total), F.lit(float(LEAST)) / F.col("n"))
    drawn = distinct.join(F.broadcast(spark.createDataFrame(list(number.items()), "dims int, n long")), "dims").where(
        F.pmod(F.xxhash64(F.lit("sample"), "uid"), F.lit(1 << 30)) / F.lit(float(1 << 30)) < share)
    rows = defaultdict(list)
    for r in drawn.select("uid", "dims", "v").collect():  # about ``sample`` rows and LEAST per length, whatever the table's size
        rows[r["dims"]].append((r["uid"], r["v"]))
    trained = {}
    for dims in sorted(rows):
        x = np.array([v for _, v in sorted(rows[dims])])
        x /= np.sqrt((x * x).sum(1))[:, None]
        trained[dims] = ProductQuantiser(x, min(4096, -(-number[dims] // per_list)))
    quantisers = spark.sparkContext.broadcast(trained)

    def quantiser_of(dims: int) -> ProductQuantiser:
        """The one of a length; a length of which nothing was drawn has one list and one code."""
        return quantisers.value.get(dims) or ProductQuantiser(np.zeros((1, dims)), 1)

    reach = math.sqrt(max(0.0, 2 - 2 * threshold))

    def encode(batches):
        for whole in batches:
            sizes_here = np.asarray(whole.column(4))
            for dims in np.unique(sizes_here).tolist():
                batch, q = whole.filter(pa.array(sizes_here == dims)), quantiser_of(dims)
                raw = np.asarray(batch.column(2).flatten()).reshape(batch.num_rows, -1)
                norm = np.sqrt((raw * raw).sum(1))
                home, codes, error, far = q.encode(raw / norm[:, None])
                probes = [p.tolist() for p in q.probes(home, far, reach)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), batch.column(4), batch.column(3), pa.array([r.tobytes() for r in raw], pa.binary()),
                     pa.array(norm), pa.array(home.astype("i4")), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error),
                     pa.array(probes, pa.list_(pa.int32()))],
                    ["uid", "label", "dims", "copies", "vector", "norm", "list", "codes", "error", "probes"])

    kind = distinct.schema["label"].dataType.simpleString()
    coded = stage(distinct.select("uid", "label", "v", "copies", "dims").mapInArrow(
        encode, f"uid long, label {kind}, dims int, copies long, vector binary, norm double, list int, codes binary, error double, probes array<int>"), "coded")
    asked = coded.select("uid", "label", "dims", "vector", "norm", F.explode("probes").alias("list"))
    held = coded.groupBy("label", "dims", "list").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("mchunks"))
    asking = asked.groupBy("label", "dims", "list").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("qchunks"))
    sizes = stage(held.join(asking, ["label", "dims", "list"]), "list-sizes")
    chunk = lambda n: F.pmod(F.xxhash64("uid"), F.col(n)).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    group = ["label", "dims", "list", "mchunk", "qchunk"]
    members = coded.join(sizes, ["label", "dims", "list"]).select(
        "label", "dims", "list", chunk("mchunks").alias("mchunk"), upto("qchunks").alias("qchunk"), "uid", "copies", "vector", "norm", "codes", "error")
    queries = asked.join(sizes, ["label", "dims", "list"]).select(
        "label", "dims", "list", upto("mchunks").alias("mchunk"), chunk("qchunks").alias("qchunk"), "uid", "vector", "norm")
    queries = queries.select(*[F.col(c).alias(c) for c in queries.columns])  # columns apart from those of members

    def columns(table: pa.Table) -> dict:
        out = {c: np.asarray(table.column(c)) for c in ("uid", "norm", "copies", "error") if c in table.column_names}
        out["vector"] = np.frombuffer(b"".join(table.column("vector").to_pylist()), "<f8").reshape(table.num_rows, -1)
        if "codes" in table.column_names:
            out["codes"] = np.frombuffer(b"".join(table.column("codes").to_pylist()), np.uint8).reshape(table.num_rows, -1)
        return out

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("n", pa.int64())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        asked_here = columns(right)
        count, a, b = compare(quantiser_of(left.column("dims")[0].as_py()), left.column("list")[0].as_py(), threshold, columns(left), asked_here)
        some = np.flatnonzero(count)
        u = np.concatenate([asked_here["uid"][some], a])
        return pa.table([pa.array(u), pa.array(np.concatenate([np.zeros(len(some), np.int64), b]), mask=np.arange(len(u)) < len(some)),
                         pa.array(np.concatenate([count[some], np.zeros(len(a), np.int64)]), mask=np.arange(len(u)) >= len(some))], schema=schema)

    return members.groupBy(*group).cogroup(queries.groupBy(*group)).applyInArrow(run, "u long, v long, n long")


def scaled(vector: str, peak: str) -> F.Column:
    """The vector times a power of two where its largest component ``peak`` is so small or large
    that squares would leave the range of doubles; cosines do not change."""
    power = -F.floor(F.log2(F.col(peak)) / 2)  # half of it, applied twice: 2**1074 is no double
    factor = F.pow(F.lit(2.0), power)
    extreme = (F.col(peak) < 1e-100) | (F.col(peak) > 1e100)
    return F.when(extreme, F.transform(vector, lambda x: x * factor * factor)).otherwise(F.col(vector))


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, key: str = "vec_id", vector: str = "embedding",
                    label: str = "label", **options) -> DataFrame:
    """One row per vector: key, n_links, component_id, kept."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must lie in (0, 1]")
    v = F.col(f"`{vector}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{key}`").alias("id"), F.col(f"`{label}`").alias("label"), F.when(usable(vector), v).alias("v"))
    rows = rows.withColumn("_peak", F.array_max(F.transform("v", F.abs)))
    rows = rows.withColumn("v", F.when(F.col("label").isNotNull() & (F.col("_peak") > 0), scaled("v", "_peak"))).drop("_peak")
    name = F.when(F.col("v").isNotNull(), F.md5(F.concat_ws(",", F.col("v").cast("array<string>"))))
    held = stage(with_uid(rows.withColumn("name", name)), "vectors")
    named = held.select("uid", "id", "label", "name")
    distinct = stage(held.where("v is not null").groupBy("label", "name").agg(
        F.min("uid").alias("uid"), F.count("*").alias("copies"), F.first("v").alias("v")), "distinct-vectors")
    found = stage(links(distinct, threshold, **options), "vector-links")
    counts = found.where("n is not null").groupBy(F.col("u").alias("uid")).agg(F.sum("n").alias("more"))
    rooted = components(found.where("v is not null").select("u", "v")).withColumnRenamed("node", "uid")
    vertex = distinct.select("label", "name", "uid", "copies").join(counts, "uid", "left").join(rooted, "uid", "left").select(
        "label", "name", (F.col("copies") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"), F.coalesce("root", "uid").alias("root"))
    least = named.where("name is not null").groupBy("label", "name").agg(F.min("id").alias("least")).join(vertex, ["label", "name"])
    per_root = least.groupBy("root").agg(F.min("least").alias("component_id"))
    final = vertex.join(per_root, "root").select("label", "name", "n_links", "component_id")
    out = named.join(final, ["label", "name"], "left")
    component = F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
