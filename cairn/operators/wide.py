"""Joins and clustering by Hamming distance of hashes of any length, kept as arrays of 64-bit words, the first bit highest."""

from __future__ import annotations

from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.operators import similarity as S
from cairn.operators.covering import near_pairs
from cairn.plans.scratch import stage


def bands(t: int, bits: int, many: int, always: bool = False) -> tuple[int, int] | None:
    """Width of the bands for ``many`` hashes of ``bits`` bits, and how many bits may differ in the best of them; None where comparing
    all pairs as arrays would cost less (unless ``always``).  Widths divide 64, so no band lies in two words."""
    best, cost = None, float("inf") if always else S.VECTOR * -(-bits // 64) * many * many / 2
    for width in (64, 32, 16, 8, 4):
        m = -(-bits // width)
        r = t // m
        flips = sum(comb(width, n) for n in range(r + 1)) if r < width else 1 << 62
        now = m * flips * many + m * flips * many * many / 2 ** min(width, bits)
        if m * flips <= S.FLIPS and now < cost:
            best, cost = (width, r), now
    return best


def distance(a: Column, b: Column, bits: int) -> Column:
    words = [F.bit_count(F.get(a, i).bitwiseXOR(F.get(b, i))) for i in range(-(-bits // 64))]
    return sum(words[1:], words[0])


def _banded(nodes: DataFrame, t: int, bits: int, width: int, r: int) -> DataFrame:
    """An equi-join of each band with up to ``r`` bits flipped on one side; a pair counts in its first such band only."""
    pieces = []  # word, shift and length of each band
    for lo in range(0, bits, width):
        n = min(width, bits - lo)
        pieces.append((lo // 64, 64 - lo % 64 - n, n))
    cut = lambda w, p: F.shiftrightunsigned(F.get(w, p[0]), p[1]).bitwiseAND(F.lit((1 << p[2]) - 1 if p[2] < 64 else -1))
    left, right = [], []
    for k, p in enumerate(pieces):
        masks = [sum(1 << i for i in c) for n in range(min(r, p[2]) + 1) for c in combinations(range(p[2]), n)]
        signed = [m - (1 << 64) if m >> 63 else m for m in masks]
        left.append(F.transform(F.array(*[F.lit(m).cast("long") for m in signed]), S._flip(cut(F.col("words"), p), F.lit(k).alias("band"))))
        right.append(F.struct(F.lit(k).alias("band"), cut(F.col("words"), p).alias("bits")))
    a = nodes.select(F.col("hash").alias("ha"), F.col("words").alias("wa"), F.explode(F.concat(*left)).alias("k")).select("ha", "wa", "k.band", "k.bits")
    b = nodes.select(F.col("hash").alias("hb"), F.col("words").alias("wb"), F.explode(F.array(*right)).alias("k")).select("hb", "wb", "k.band", "k.bits")
    first = F.coalesce(*[F.when(F.bit_count(cut(F.col("wa"), p).bitwiseXOR(cut(F.col("wb"), p))) <= r, k) for k, p in enumerate(pieces)])
    near = distance(F.col("wa"), F.col("wb"), bits) <= t
    return a.join(b, ["band", "bits"]).where((F.col("ha") < F.col("hb")) & near & (first == F.col("band"))).select("ha", "hb")


def numbered(items: DataFrame) -> DataFrame:
    """``hash``, a number, and ``words`` of each different hash of ``items``."""
    return stage(items.where("words is not null").select("words").distinct().withColumn("hash", F.monotonically_increasing_id()))


def near_hashes(nodes: DataFrame, t: int, bits: int, banded: bool | None = None) -> DataFrame:
    """Pairs ``ha`` < ``hb`` of numbers of ``nodes`` (of ``numbered``) at most ``t`` bits apart; ``banded`` says which way, by default
    the cheaper one."""
    many = nodes.count()
    plan = bands(t, bits, many) if banded is None else (bands(t, bits, many, always=True) if banded else None)
    return near_pairs(nodes, t, many) if plan is None else _banded(nodes, t, bits, *plan)


def hamming_pairs(items: DataFrame, t: int, bits: int, banded: bool | None = None) -> DataFrame:
    """All pairs ``a`` < ``b`` (by ``ord``) and their ``distance`` of items (``id``, ``ord``, ``words``) at most ``t`` of ``bits`` bits apart."""
    nodes = numbered(items)
    near = near_hashes(nodes, t, bits, banded)
    both = near.union(near.select("hb", "ha")).union(nodes.select("hash", F.col("hash").alias("h")))
    known = stage(items.join(nodes, "words").select("id", "ord", "words", "hash"))
    a = known.select(F.col("id").alias("a"), F.col("ord").alias("oa"), F.col("hash").alias("ha"), F.col("words").alias("wa"))
    b = known.select(F.col("id").alias("b"), F.col("ord").alias("ob"), F.col("hash").alias("hb"), F.col("words").alias("wb"))
    pairs = a.join(both, "ha").join(b, "hb").where(F.col("oa") < F.col("ob"))
    return pairs.select("a", "b", "oa", "ob", distance(F.col("wa"), F.col("wb"), bits).alias("distance"))


def clusters(items: DataFrame, t: int, bits: int, banded: bool | None = None) -> DataFrame:
    """``id`` and ``leader`` of each item under sequential leader clustering, as ``similarity.clusters`` has it for 64 bits."""
    nodes = numbered(items)
    known = items.join(nodes, "words", "left").select("id", "ord", "hash")
    return S.clusters(known, t, near_hashes(nodes, t, bits, banded))
