"""Operator 6 against brute force."""

import math

import numpy as np
import pytest

from lodestar.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int, uid string, name int, list int"


def groups(seed=3, dims=16):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(12):
        centre = rng.normal(size=dims)
        for _ in range(int(rng.integers(1, 40))):
            v = centre + rng.normal(size=dims) * rng.choice([0.02, 0.12, 0.16, 0.2])
            rows.append([*map(float, v.astype(np.float32))])
    out = [(i, v, int(rng.integers(0, 3)) if i % 7 else 1, "u", 1, 2) for i, v in enumerate(rows)]
    out += [(1000 + i, out[5][1], out[5][2], "u", 1, 2) for i in range(30)]  # many copies of one vector
    out += [(1100, [2 * x for x in out[5][1]], out[5][2], "u", 1, 2)]  # and a multiple of it
    nan, inf = float("nan"), float("inf")
    out += [(2000, None, 1, "u", 1, 2), (2001, [0.0] * dims, 1, "u", 1, 2), (2002, [nan] + [1.0] * (dims - 1), 1, "u", 1, 2),
            (2003, [inf] + [1.0] * (dims - 1), 1, "u", 1, 2), (2004, [None] + [1.0] * (dims - 1), 1, "u", 1, 2),
            (2005, [1.0] * 3, 1, "u", 1, 2), (2006, [], 1, "u", 1, 2), (2007, out[5][1], None, "u", 1, 2), (2008, out[5][1], None, "u", 1, 2),
            (None, out[5][1], out[5][2], "u", 1, 2), (3, out[3][1], out[3][2], "u", 1, 2)]
    return out


def plain(rows, threshold=0.98):
    dims = 16
    good = [r[1] is not None and r[2] is not None and len(r[1]) == dims and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1]) for r in rows]
    unit = np.array([np.array(r[1], float) / np.linalg.norm(np.array(r[1], float)) if g else np.full(dims, np.nan) for r, g in zip(rows, good)])
    with np.errstate(invalid="ignore"):
        links = unit @ unit.T >= threshold
    labels = np.array([-1 if r[2] is None else r[2] for r in rows])
    links &= labels[:, None] == labels[None, :]
    np.fill_diagonal(links, False)
    root = np.arange(len(rows))
    while True:
        low = np.array([min([root[i], *root[links[i]]]) for i in range(len(rows))])
        if (low == root).all():
            break
        root = low
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None]
        component = min(ids, default=None)
        out.append((r[0], int(links[i].sum()), component, r[0] == component))
    return out


@pytest.mark.parametrize("options", [{}, {"per_list": 12}, {"per_list": 3, "sample": 60}])
def test_links_and_components(spark, options, monkeypatch):
    if options:
        monkeypatch.setattr(vectors, "MEMBERS", 7)
        monkeypatch.setattr(vectors, "QUERIES", 11)
    rows = groups()
    found = vectors.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3), **options).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, found), key=key) == sorted(plain(rows), key=key)


@pytest.mark.parametrize("options", [{}, {"per_list": 5, "sample": 40}])
def test_vectors_of_every_length_are_compared(spark, options, monkeypatch):
    if options:
        monkeypatch.setattr(vectors, "LEAST", 1e-9)  # a length of which nothing is drawn loses nothing either
    rng, rows = np.random.default_rng(9), groups(4)
    want = [r[:2] for r in plain(rows)]
    for dims, n in ((24, 70), (4, 40), (1, 3)):
        centres = rng.normal(size=(6, dims))
        data = (centres[np.arange(n) % 6] + rng.normal(size=(n, dims)) * 0.1).astype(np.float32)
        label = np.arange(n) % 2
        unit = data.astype(float) / np.linalg.norm(data.astype(float), axis=1)[:, None]
        links = (unit @ unit.T >= 0.98) & (label[:, None] == label)
        rows += [(10_000 * dims + i, [*map(float, data[i])], int(label[i]), "u", 1, 2) for i in range(n)]
        want += [(10_000 * dims + i, int(links[i].sum()) - 1) for i in range(n)]
    found = vectors.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3), **options).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([tuple(r)[:2] for r in found], key=key) == sorted(want, key=key)
    assert sum(n for k, n in want if k and k >= 10_000) > 100


def test_empty_and_useless_tables(spark):
    assert vectors.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, None, 1, "u", 1, 2), (2, [0.0, 0.0], 1, "u", 1, 2), (3, [1.0, 0.0], 1, "u", 1, 2)]
    found = vectors.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, found)) == [(i, 0, i, True) for i in (1, 2, 3)]


def test_probes_and_distances_lose_nothing():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    q = vectors.ProductQuantiser(x[:200], 20, subspaces=4, codes=16)
    home, codes, error, far = q.encode(x)
    reach = 0.5
    probes = q.probes(home, far, reach)
    apart = np.linalg.norm(x[:, None] - x[None], axis=2)
    for i, j in zip(*np.nonzero(apart <= reach)):
        assert home[j] in probes[i]
        assert q.distances(x[[i]], home[j], codes[[j]])[0, 0] <= reach + error[j] + 1e-4


@pytest.mark.parametrize("size", [1e-310, 1e-200, 1e-120, 1e120, 1e200, 1e307])
def test_extreme_lengths_link_like_others(spark, size):
    """Finite vectors that are not zero link, however short or long they are."""
    base = [3.0, 1.0, -2.0, 0.5]
    rows = [(1, 0, base), (2, 0, [x * size for x in base]), (3, 0, [x * size for x in base]),
            (4, 0, [-x * size for x in base]), (5, 1, [x * size for x in base]), (6, 0, [0.0] * 4)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4), 5: (0, 5), 6: (0, 6)}
