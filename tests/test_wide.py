"""Hashes of other lengths than 64 bits."""

import random

import numpy as np
import pytest

from cairn import __main__ as programs
from cairn.functions import images as I
from cairn.operators import wide
from cairn.plans import report_queries
from tests.test_similarity import sequential


def words(value, bits):
    value <<= -bits % 64
    n = -(-bits // 64)
    out = [(value >> 64 * (n - 1 - i)) & (2**64 - 1) for i in range(n)]
    return [x - (1 << 64) if x >> 63 else x for x in out]


@pytest.mark.parametrize("size, t, banded", [(4, 3, True), (12, 20, True), (12, 9, False), (16, 31, True), (16, 40, False), (10, 13, True), (16, 63, True)])
def test_pairs_and_clusters(spark, size, t, banded):
    rng, bits = random.Random(size * t), size * size
    base = [rng.getrandbits(bits) for _ in range(8)]
    hashes = []
    for _ in range(90):
        h = rng.choice(base)
        for _ in range(rng.randint(0, t)):
            h ^= 1 << rng.randrange(bits)
        hashes.append(h)
    hashes += [hashes[0], hashes[0], None, 0, (1 << bits) - 1]
    df = spark.createDataFrame([(i, i, None if h is None else words(h, bits)) for i, h in enumerate(hashes)], "id long, ord long, words array<long>")
    got = {(r["a"], r["b"]): r["distance"] for r in wide.hamming_pairs(df, t, bits, banded).collect()}
    apart = {(i, j): (a ^ b).bit_count() for i, a in enumerate(hashes) for j, b in enumerate(hashes) if i < j and a is not None and b is not None}
    assert got == {k: n for k, n in apart.items() if n <= t}
    assert {r["id"]: r["leader"] for r in wide.clusters(df, t, bits, banded).collect()} == sequential(hashes, t)


def test_deduplicate_program(spark, tmp_path):
    """Crops whose differences only a longer hash can see: the program finds the clusters that a loop over 256-bit hashes does."""
    rng = np.random.default_rng(6)
    (tmp_path / "in").mkdir()
    coarse, fine = rng.integers(0, 255, (4, 4, 3)), rng.integers(-60, 60, (16, 16, 1))
    pictures = {}
    for i in range(6):
        p = np.clip(np.kron(coarse, np.ones((32, 32, 1))) + (i % 2) * np.kron(fine, np.ones((8, 8, 1))) + rng.normal(0, 1, (128, 128, 1)), 0, 255).astype(np.uint8)
        pictures[f"c{i}.png"] = p
        (tmp_path / "in" / f"c{i}.png").write_bytes(I.png(p))
    hashes = [sum((x & (2**64 - 1)) << 64 * (3 - k) for k, x in enumerate(I.hash_words(p, 16))) for _, p in sorted(pictures.items())]
    want = len(set(sequential(hashes, 40).values()))
    options = programs._parser().parse_args(["deduplicate", "--crops", str(tmp_path / "in"), "--output", str(tmp_path / "out"), "--threshold", "40", "--hash-size", "16"])
    assert programs.run(spark, options) == {"clusters": want, "kept": want, "duplicates": 6 - want} and 1 < want < 6
    assert len(list((tmp_path / "out" / "crops").iterdir())) == want


def test_hash_words():
    rng = np.random.default_rng(4)
    picture = np.kron(rng.integers(0, 255, (16, 16, 3)), np.ones((8, 8, 1))).astype(np.uint8)
    for size in (4, 8, 12, 16):
        held = I.hash_words(picture, size)
        assert len(held) == -(-size * size // 64) and all(-(1 << 63) <= x < 1 << 63 for x in held)
        ones = sum((x & (2**64 - 1)).bit_count() for x in held)
        assert abs(ones - size * size / 2) <= 1
    assert I.hash_words(picture)[0] == I.hash_pixels(picture)
    assert wide.bands(8, 144, 10**9) is not None and wide.bands(8, 144, 10) is None and wide.bands(63, 256, 500, always=True) == (8, 1)


def test_query_compares_where_bands_would_pair_more(spark, tmp_path, monkeypatch):
    """Bits of four levels agree too often for bands: their join has more rows than there are pairs."""
    monkeypatch.setattr(wide, "_banded", None)
    v = np.random.default_rng(8).normal(0, 0.125, (90, 64))
    v[1:30] = v[0] + np.random.default_rng(9).normal(0, 0.03, (29, 64))
    spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    bits = (v[:, None, :] > np.array(report_queries.LEVELS)[:, None]).reshape(len(v), -1)
    apart = (bits[:, None] != bits).sum(axis=2)
    got = {(r["a"], r["b"]): r["distance"] for r in report_queries.wide_hamming_pairs(spark, str(tmp_path)).collect()}
    assert got == {(a, b): apart[a, b] for a in range(90) for b in range(a + 1, 90) if apart[a, b] <= 63} and len(got) > 100
