"""Near pairs of hashes at radii where bands don't help: cells around pivots, and the triangle inequality between them.

A bounded sample gives the pivots, the hash with most others around it first, none within half the radius of another.  Every
hash goes to the cell of its nearest pivot, and a cell knows the least and greatest distance of its members to every pivot.  Two
cells whose ranges lie more than the radius apart for some pivot hold no near pair and never meet; where they meet, hashes too
far from the other's pivot are left out.  All others are compared, so the result is exact whatever the pivots; with many more
clusters than pivots, or none, it comes to comparing all pairs.  Small cells are packed together with near ones to blocks, a
large one is cut into several, so a task holds two blocks whatever the sizes.

The driver gets the sample and, for each cell, its size and ranges; both are bounded by ``SAMPLE`` and ``PIVOTS``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Accumulator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.plans.scratch import stage

#: Most pivots, hashes they are chosen from, and hashes a cell should have on average; hashes of a block.
PIVOTS, SAMPLE, SHARE, BLOCK = 1024, 8192, 16, 4096
ROWS = 1024  # hashes whose distances to all pivots are held at once
TILE = 1 << 16  # distances of a step of comparing


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of all rows of ``a`` and ``b``, arrays of 64-bit words."""
    total, b = np.zeros((len(a), len(b)), dtype=np.uint16), np.ascontiguousarray(b.T)
    for w in range(a.shape[1]):
        total += np.bitwise_count((a[:, w, None] ^ b[w]).view(np.uint64))
    return total


def pivots(sample: np.ndarray, t: int, most: int) -> np.ndarray:
    """Up to ``most`` rows of ``sample``: the one with most others within half of ``t`` first, then of those not within it of one before."""
    radius = max(1, t // 2)
    near = np.concatenate([apart(sample[lo : lo + ROWS], sample) <= radius for lo in range(0, len(sample), ROWS)])
    chosen, free = [], np.ones(len(sample), dtype=bool)
    for i in np.argsort(-near.sum(axis=1), kind="stable"):
        if free[i] and len(chosen) < most:
            chosen.append(i)
            free &= ~near[i]
    return sample[chosen]


@dataclass
class Cells:
    """Sizes of the cells that have hashes, which of them can hold near pairs, and how they are packed."""

    numbers: list[int]
    sizes: np.ndarray
    meets: np.ndarray
    first: np.ndarray  # the first block of each cell
    parts: np.ndarray  # and how many blocks it is cut into
    radius: np.ndarray  # greatest distance of a member to the cell's own pivot
    centres: np.ndarray


def _packed(sizes: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First block and number of blocks of each cell; each next cell is the one whose ranges are most like those of the last."""
    first, parts, left = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64), set(range(len(sizes)))
    middle, block, filled, now = (low + high).astype(np.int32), 0, 0, 0
    while left:
        left.discard(now)
        parts[now] = -(-sizes[now] // BLOCK)
        if filled and (parts[now] > 1 or filled + sizes[now] > BLOCK):
            block, filled = block + 1, 0
        first[now] = block
        if parts[now] > 1:
            block += int(parts[now])
        else:
            filled += int(sizes[now])
        if left:
            others = np.fromiter(left, np.int64)
            now = int(others[np.abs(middle[others] - middle[now]).sum(axis=1).argmin()])
    return first, parts


def _meets(low: np.ndarray, high: np.ndarray, t: int) -> np.ndarray:
    return np.stack([((low <= high[i] + t) & (low[i] <= high + t)).all(axis=1) for i in range(len(low))])


def cells(nodes: DataFrame, t: int, many: int) -> tuple[DataFrame, Cells]:
    """``hash``, ``words`` and ``cell`` of every row of ``nodes`` (``hash``, ``words``; ``many`` of them), written, and the cells."""
    some = nodes.orderBy(F.xxhash64("words"), "hash").limit(SAMPLE).select("words").collect()
    centres = pivots(np.array([list(r["words"]) for r in some], dtype=np.int64), t, max(1, min(PIVOTS, many // SHARE)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centres)
        count, low, high = np.zeros(k, np.int64), np.full((k, k), 1 << 14, np.int16), np.full((k, k), -1, np.int16)
        none = lambda n: pa.nulls(n, pa.binary())
        for b in batches:
            if not b.num_rows:
                continue
            words = b.column("words").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            home = np.zeros(b.num_rows, np.int32)
            for lo in range(0, b.num_rows, ROWS):
                far = apart(words[lo : lo + ROWS], centres).astype(np.int16)
                home[lo : lo + ROWS] = far.argmin(axis=1)
                np.minimum.at(low, home[lo : lo + ROWS], far)
                np.maximum.at(high, home[lo : lo + ROWS], far)
            count += np.bincount(home, minlength=k)
            yield pa.record_batch([b.column("hash"), b.column("words").cast(pa.list_(pa.int64())), pa.array(home), pa.nulls(b.num_rows, pa.int64()), none(b.num_rows), none(b.num_rows)], ["hash", "words", "cell", "n", "low", "high"])
        own = np.flatnonzero(count)
        ends = [pa.array([x[c].tobytes() for c in own], pa.binary()) for x in (low, high)]
        yield pa.record_batch([pa.nulls(len(own), pa.int64()), pa.nulls(len(own), pa.list_(pa.int64())), pa.array(own.astype(np.int32)), pa.array(count[own]), *ends], ["hash", "words", "cell", "n", "low", "high"])

    dealt = stage(nodes.select("hash", "words").mapInArrow(deal, "hash long, words array<long>, cell int, n long, low binary, high binary"))

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        ends = {c: np.stack([np.frombuffer(x, np.int16) for x in pdf[c]]) for c in ("low", "high")}
        return pd.DataFrame({"cell": pdf["cell"][:1], "n": [pdf["n"].sum()], "low": [ends["low"].min(axis=0).tobytes()], "high": [ends["high"].max(axis=0).tobytes()]})

    known = dealt.where("n is not null").select("cell", "n", "low", "high").groupBy("cell").applyInPandas(merge, "cell int, n long, low binary, high binary")
    found = sorted(known.collect(), key=lambda r: r["cell"])  # PIVOTS rows at most
    low, high = (np.stack([np.frombuffer(r[c], np.int16) for r in found]).astype(np.int32) for c in ("low", "high"))
    sizes = np.array([r["n"] for r in found], dtype=np.int64)
    numbers = [r["cell"] for r in found]
    radius = high[np.arange(len(numbers)), numbers]
    return dealt.where("n is null").select("hash", "words", "cell"), Cells(numbers, sizes, _meets(low, high, t), *_packed(sizes, low, high), radius, centres[numbers])


def near_pairs(nodes: DataFrame, t: int, many: int, compared: Accumulator | None = None) -> DataFrame:
    """Pairs ``ha`` < ``hb`` of the rows of ``nodes`` (``hash``, a different number each, and ``words``) at most ``t`` bits apart.
    ``compared`` adds up the pairs that were compared."""
    if not many:
        return nodes.select(F.col("hash").alias("ha"), F.col("hash").alias("hb"))
    dealt, known = cells(nodes, t, many)
    at = {c: i for i, c in enumerate(known.numbers)}
    meets, radius, centres, spark = known.meets, known.radius, known.centres, nodes.sparkSession
    # A bin is what shares blocks: cells packed together, or one that is cut.  Each block is sent once to every pair it is half of.
    bins: dict[int, list[int]] = {}
    for i, b in enumerate(known.first.tolist()):
        bins.setdefault(b, []).append(i)
    parts = {b: int(known.parts[own[0]]) for b, own in bins.items()}
    partners = [(b, d, d + parts[d] - 1) for b, own in bins.items() for d, other in bins.items() if meets[np.ix_(own, other)].any()]
    place = F.broadcast(spark.createDataFrame([(c, int(known.first[i]), int(known.parts[i])) for c, i in at.items()], "cell int, bin long, parts long"))
    rows = dealt.join(place, "cell").select("hash", "words", "cell", "bin", (F.col("bin") + F.pmod(F.xxhash64("words"), "parts")).alias("block"))
    held = stage(rows.groupBy("bin", "block").agg(F.collect_list(F.struct("hash", "words", "cell")).alias("x")))  # about BLOCK rows
    sent = held.select("bin", "block", F.col("x.hash").alias("hash"), F.flatten("x.words").alias("words"), F.col("x.cell").alias("cell"))
    pairs = F.broadcast(spark.createDataFrame(partners, "bin long, lo long, hi long"))  # PIVOTS * PIVOTS rows at most
    keys = held.select("bin", "block").join(pairs, "bin").select("block", F.explode(F.sequence("lo", "hi")).alias("other"))
    dealt_to = sent.join(keys, "block").select(F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "hash", "words", "cell")

    def near(pdf: pd.DataFrame) -> pd.DataFrame:
        sides = []
        for h, w, c in zip(*(pdf.sort_values("block")[x] for x in ("hash", "words", "cell"))):
            order = np.argsort(c, kind="stable")
            sides.append((np.asarray(h, np.int64)[order], np.asarray(w, np.int64).reshape(len(h), -1)[order], np.array([at[n] for n in np.asarray(c)[order]])))
        if len(sides) == 1 and pdf["i"].iloc[0] != pdf["j"].iloc[0]:
            return pd.DataFrame({"ha": [], "hb": []}, dtype=np.int64)  # the other block has no rows
        (hx, wx, cx), (hy, wy, cy) = sides[0], sides[-1]
        out = [np.zeros((0, 2), dtype=np.int64)]
        own = np.unique(cy)
        to = apart(wx, centres[own])  # a hash farther from a cell's pivot than its radius and t is near none of its members
        jobs = [(np.flatnonzero(meets[c][cx] & (to[:, k] <= radius[c] + t)), np.flatnonzero(cy == c)) for k, c in enumerate(own)]
        if 2 * sum(len(some) * len(others) for some, others in jobs) > len(hx) * len(hy):
            jobs = [(np.arange(len(hx)), np.arange(len(hy)))]  # little is left out; going by cells would cost more than it spares
        for some, others in jobs:
            if compared is not None:
                compared.add(len(some) * len(others))
            step = max(1, TILE // max(1, len(others)))
            for lo in range(0, len(some), step):
                a, b = np.nonzero(apart(wx[some[lo : lo + step]], wy[others]) <= t)
                out.append(np.stack([hx[some[lo + a]], hy[others[b]]], axis=1))
        ends = np.concatenate(out)
        ends = np.unique(np.sort(ends[ends[:, 0] != ends[:, 1]], axis=1), axis=0)
        return pd.DataFrame(ends, columns=["ha", "hb"])

    return dealt_to.groupBy("i", "j").applyInPandas(near, "ha long, hb long")
