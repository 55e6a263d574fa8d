"""Near pairs at large radii against all pairs, and how many pairs are compared for them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairn.operators import covering, similarity, wide


def clustered(seed, centres, each, words=1, flips=3):
    """Different hashes, ``each`` around a centre, up to ``flips`` bits from it."""
    rng = np.random.default_rng(seed)
    base = np.repeat(rng.integers(-(1 << 63), 1 << 63, (centres, words), dtype=np.int64), each, axis=0)
    for _ in range(flips):
        base[np.arange(len(base)), rng.integers(0, words, len(base))] ^= np.int64(1) << rng.integers(0, 63, len(base))
    return np.unique(base, axis=0)


def brute(hashes, t):
    found = set()
    for lo in range(0, len(hashes), 500):
        a, b = np.nonzero(covering.apart(hashes[lo : lo + 500], hashes) <= t)
        found |= {(int(x) + lo, int(y)) for x, y in zip(a, b) if x + lo < y}
    return found


def table(spark, hashes):
    return spark.createDataFrame([(i, [int(w) for w in ws]) for i, ws in enumerate(hashes)], "hash long, words array<long>")


@pytest.mark.parametrize("words, t, block", [(1, 20, 300), (1, 14, 4096), (3, 60, 50)])
def test_equal_to_all_pairs(spark, monkeypatch, words, t, block):
    """Many small cells in a block, and cells cut into several blocks."""
    monkeypatch.setattr(covering, "BLOCK", block)
    hashes = np.concatenate([clustered(1, 30, 40, words), clustered(2, 1, 500, words, 9), clustered(3, 200, 1, words)])
    hashes = np.unique(hashes, axis=0)
    got = [(r["ha"], r["hb"]) for r in covering.near_pairs(table(spark, hashes), t, len(hashes)).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(hashes, t)


def test_fewer_than_half_of_the_pairs_are_compared(spark):
    hashes = clustered(4, 300, 60)
    compared = spark.sparkContext.accumulator(0)
    got = covering.near_pairs(table(spark, hashes), 20, len(hashes), compared).collect()
    assert {tuple(r) for r in got} == brute(hashes, 20)
    assert 0 < compared.value < len(hashes) ** 2 / 2 * 0.3
    _, known = covering.cells(table(spark, hashes), 20, len(hashes))
    assert known.sizes.sum() == len(hashes) and not known.meets.all() and (known.meets == known.meets.T).all()


def test_hashes_without_structure_are_all_compared(spark):
    hashes = clustered(5, 900, 1)
    got = {(r["ha"], r["hb"]) for r in covering.near_pairs(table(spark, hashes), 24, len(hashes)).collect()}
    assert got == brute(hashes, 24)


def test_both_joins_take_it_at_large_radii(spark):
    hashes = clustered(6, 20, 8)
    assert similarity.bands(20, len(hashes)) is None
    got = {tuple(r) for r in similarity.near_hashes(spark.createDataFrame([(int(h[0]),) for h in hashes], "hash long"), 20).collect()}
    assert got == {tuple(sorted((int(hashes[a][0]), int(hashes[b][0])))) for a, b in brute(hashes, 20)}
    assert {tuple(r) for r in wide.near_hashes(table(spark, hashes), 20, 64, banded=False).collect()} == brute(hashes, 20)


def test_none_and_one(spark):
    one = table(spark, np.array([[5]], dtype=np.int64))
    assert covering.near_pairs(one, 20, 1).count() == 0 and covering.near_pairs(one.where(F.lit(False)), 20, 0).count() == 0
