"""Centroid clustering against plain Python."""

import hashlib
import math
import random

import numpy as np

from llm import centroids

VECTORS = "vec_id long, embedding array<double>, label int, Cluster string"


def brute(rows, k, rounds, size):
    fine = [(i, [math.floor(1024 * x) if abs(x) < 2**53 else int(x) * 1024 for x in e]) for i, e, *_ in rows if e is not None and len(e) == size and all(x is not None and math.isfinite(x) for x in e)]
    order = sorted(fine, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    cs = [v for _, v in order[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cs))
    for _ in range(rounds):
        mine = [[] for _ in cs]
        for _, v in fine:
            mine[near(v)[1]].append(v)
        cs = [[sum(x) // len(m) for x in zip(*m)] if m else c for m, c in zip(mine, cs)]
    found = [(i, *near(v)) for i, v in fine]
    long = lambda x: x if x < 2**63 else None
    part = [sum(d for _, d, n in found if n == c) for c in range(len(cs))]
    return sorted(((i, n, long(d), long(part[n]), long(sum(part)), hashlib.sha256(",".join(map(str, cs[n])).encode()).hexdigest()) for i, d, n in found), key=repr)


def got(df, **args):
    out = centroids.apply(df, **args)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def made(rng, n, size, scale):
    spots = [[rng.gauss(0, scale) for _ in range(size)] for _ in range(5)]
    rows = [(i, [x + rng.gauss(0, scale / 9) for x in rng.choice(spots)], 0, "x") for i in range(n)]
    rows += [rows[0], rows[0], (2**60 + 1, rows[1][1], None, None), (None, rows[2][1], 1, "y"), (n + 1, [0.0] * size, 0, None), (n + 2, [0.0] * size, 0, None)]
    return rows + [(n + 3, None, 0, ""), (n + 4, [1.0], 0, ""), (n + 5, [1.0] * (size - 1) + [None], 0, ""), (n + 6, [1.0] * (size - 1) + [math.nan], 0, ""), (n + 7, [1.0] * (size - 1) + [-math.inf], 0, ""), (n + 8, [], 0, "")]


def test_equals_plain_rounds(spark):
    rows = made(random.Random(1), 150, 64, 1.0)
    assert got(spark.createDataFrame(rows, VECTORS).repartition(5)) == brute(rows, 8, 10, 64)


def test_ties_and_empty_clusters(spark):
    rng = random.Random(2)
    rows = [(i, [float(rng.randint(0, 1)) for _ in range(4)], 0, "") for i in range(60)]
    assert got(spark.createDataFrame(rows, VECTORS), size=4) == brute(rows, 8, 10, 4)
    rows = [(i, [1.0, 2.0], 0, "") for i in range(20)]  # all equal: every vector in cluster 0, seven empty ones
    assert got(spark.createDataFrame(rows, VECTORS), size=2) == brute(rows, 8, 10, 2)


def test_numbers_beyond_64_bits(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([1e4, 1e9, 3e38, 1e200]) * rng.uniform(-1, 1) for _ in range(3)], 0, "") for i in range(40)]
    rows += [(100, [1.5, 2.5, -3.5], 0, "")]
    want = brute(rows, 8, 4, 3)
    assert got(spark.createDataFrame(rows, VECTORS), size=3, rounds=4) == want and any(r[2] is None for r in want)


def test_few_and_none(spark):
    rows = made(random.Random(4), 5, 64, 1.0)[:1]
    assert got(spark.createDataFrame(rows, VECTORS)) == brute(rows, 8, 10, 64)
    assert got(spark.createDataFrame([], VECTORS)) == []
    assert got(spark.createDataFrame([(1, None, 0, "")], VECTORS)) == []


def test_search_is_exact_and_partial():
    rng = np.random.default_rng(5)
    spots = rng.integers(-4000, 4000, (8, 64))
    v = spots[rng.integers(0, 8, 3000)] + rng.integers(-50, 50, (3000, 64))
    order = np.argsort(-v.var(axis=0))
    number, best, work = centroids.nearest(v, spots, order)
    full = ((v[:, None, :] - spots[None]) ** 2).sum(axis=2)
    assert (number == full.argmin(axis=1)).all() and (best == full.min(axis=1)).all()
    assert work < 0.5 * full.size * 64
