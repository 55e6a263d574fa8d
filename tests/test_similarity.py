"""Set-based clusterings against sequential models of a few lines."""

import random
from math import comb

import pytest
from pyspark.sql import functions as F

from cairn.operators import similarity as S


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def sequential(hashes, t):
    leaders, out = [], {}
    for i, h in enumerate(hashes):
        lead = None if h is None else next((j for j in leaders if hashes[j] is not None and (hashes[j] ^ h).bit_count() <= t), None)
        if lead is None:
            leaders.append(i)
        out[i] = i if lead is None else lead
    return out


@pytest.mark.parametrize("t", [0, 5, 8, 18])
def test_pairs_and_leaders(spark, t):
    rng = random.Random(t)
    base = [rng.getrandbits(64) for _ in range(12)]
    hashes = []
    for _ in range(90):
        h = rng.choice(base)
        for _ in range(rng.randint(0, 12)):
            h ^= 1 << rng.randrange(64)
        hashes.append(h)
    hashes[7] = hashes[40] = None
    items = spark.createDataFrame([(i, i, None if h is None else signed(h)) for i, h in enumerate(hashes)], "id long, ord long, hash long")
    edges = S.hamming_pairs(items, t)
    assert {r["id"]: r["leader"] for r in S.clusters(items, t).collect()} == sequential(hashes, t)
    got = sorted((r["a"], r["b"]) for r in edges.collect())
    assert got == sorted((i, j) for j in range(90) for i in range(j) if None not in (hashes[i], hashes[j]) and (hashes[i] ^ hashes[j]).bit_count() <= t)
    assert {r["id"]: r["leader"] for r in S.leaders(items, edges).collect()} == sequential(hashes, t)


def test_temporal_dedup(spark):
    rng = random.Random(3)
    dets = sorted((rng.randrange(3), rng.randrange(60), rng.randrange(16)) for _ in range(120))
    rows = [(v, f, i, i, h) for i, (v, f, h) in enumerate(dets)]
    df = spark.createDataFrame(rows, "video long, frame long, id long, ord long, hash long")
    for t, cooldown in ((1, 5), (0, 0), (2, 20)):
        saved, out = {}, set()
        for v, f, i, _, h in rows:
            if not any((h ^ g).bit_count() <= t and f - e <= cooldown for e, g in saved.get(v, [])):
                saved.setdefault(v, []).append((f, h))
                out.add(i)
        assert {r["id"] for r in S.temporal_kept(df, t, cooldown).where("kept").collect()} == out


def test_a_static_scene_is_one_pass(spark):
    """5,000 looks at one thing, a frame each: with a cooldown of 1 every second is kept.  A null hash is always kept."""
    df = spark.range(5000).select(F.lit("v").alias("video"), F.col("id").alias("frame"), "id", F.col("id").alias("ord"), F.lit(-7).cast("long").alias("hash"))
    df = df.union(spark.createDataFrame([("v", 3, 9000, 9000, None), (None, 4, 9001, 9001, -7)], "video string, frame long, id long, ord long, hash long"))
    kept = [r["id"] for r in S.temporal_kept(df, 0, 1).where("kept").collect()]
    assert sorted(kept) == [*range(0, 5000, 2), 9000, 9001]


@pytest.mark.parametrize("most", [0, 5, 10**6])
def test_long_chains_end(spark, monkeypatch, most):
    """A chain in order, where a round decides two items only, and random edges, by rounds and by the last task."""
    monkeypatch.setattr(S, "LAST", most)
    rng = random.Random(5)
    n = 24
    pairs = sorted({(i, i + 1) for i in range(n - 1)} | {tuple(sorted(rng.sample(range(n, 60), 2))) for _ in range(60)})
    edges = spark.createDataFrame([(a, b, a, b) for a, b in pairs], "a long, b long, oa long, ob long")
    items = spark.range(62).select("id", F.col("id").alias("ord"))
    leads, want = set(), {}
    for i in range(62):
        near = [a for a, b in pairs if b == i and a in leads]
        want[i] = min(near, default=i)
        if not near:
            leads.add(i)
    assert {r["id"]: r["leader"] for r in S.leaders(items, edges).collect()} == want


def test_bands_never_cost_more_than_all_pairs():
    """Candidates of evenly spread hashes, by the plan: under a tenth of all pairs at 8 bits for 2,000 rows, and few at scale."""
    for many in (2_000, 100_000, 10**7, 10**9):
        for t in range(0, 21):
            plan = S.bands(t, many)
            if plan:
                cut, r = plan
                made = sum(sum(comb(w, k) for k in range(r + 1)) * many * many / 2**w for _, w in cut)
                assert sum(w for _, w in cut) == 64 and made < many * many / 2 * (0.1 if t <= 8 else 1)
                assert r * len(cut) <= t < (r + 1) * len(cut)
    assert S.bands(0, 2000) and S.bands(8, 10**7) and S.bands(20, 2000) is None


def test_candidates_of_bands(spark, monkeypatch):
    """Counted on random hashes: what the bands' join makes is as few as the plan says."""
    rng = random.Random(6)
    nodes = spark.createDataFrame([(signed(rng.getrandbits(64)),) for _ in range(1500)], "hash long")
    cut, r = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)], 1
    pairs = S._banded(nodes, 64, cut, r).count()  # any pair that meets in a band
    assert pairs < 0.1 * 1500 * 1499 / 2


def test_equal_hashes_meet_once(spark):
    """2,000 items of one hash are one node of the join; all share their first."""
    items = spark.range(2000).select("id", F.col("id").alias("ord"), F.lit(5).cast("long").alias("hash"))
    assert {r["leader"] for r in S.clusters(items, 8).collect()} == {0}
    assert S.near_hashes(items.select("hash").distinct(), 8).count() == 0


def test_empty(spark):
    items = spark.createDataFrame([], "id long, ord long, hash long")
    assert S.clusters(items, 8).count() == 0 and S.hamming_pairs(items, 8).count() == 0
