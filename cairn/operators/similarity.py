"""Joins and clusterings by Hamming distance of 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from cairn.operators.covering import near_pairs
from cairn.plans.scratch import drop, stage

#: What comparing a pair in an array costs next to a row of a join.
VECTOR = 0.02
#: Most looked-up values of a hash.
FLIPS = 2000
#: With so many live edges left or fewer, one task ends the rounds of ``leaders``.
LAST = 1_000_000


def bands(t: int, many: int) -> tuple[list[tuple[int, int]], int] | None:
    """(shift, width) of each band for ``many`` hashes, and how many bits may differ in the best one; None where comparing
    comparing cells around pivots may cost less.

    If hashes differ in t bits, one of m bands differs in t // m at most.  The cost of m is that of looked-up values and of
    the candidates that evenly spread hashes would have."""
    best, cost = None, VECTOR * many * many / 2
    for m in range(1, min(64, t + 1) + 1):
        r, width = t // m, 64 // m
        flips = sum(comb(width + (64 % m > 0), n) for n in range(r + 1)) if width > r else 1 << 62
        now = m * flips * many + m * flips * many * many / 2**width
        if m * flips <= FLIPS and now < cost:
            best, cost = m, now
    if best is None:
        return None
    edges = [64 * i // best for i in range(best + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])], t // best


def _flip(own: Column, band: Column):
    return lambda m: F.struct(band, own.bitwiseXOR(m.cast("long")).alias("bits"))


def _banded(nodes: DataFrame, t: int, cut: list[tuple[int, int]], r: int) -> DataFrame:
    """Pairs ``ha`` < ``hb`` of hashes at most ``t`` bits apart: an equi-join of each band with up to ``r`` bits flipped on one
    side.  A pair counts in its first such band only, so nothing has to be made distinct."""
    piece = lambda h, s, w: F.shiftrightunsigned(h, s).bitwiseAND(F.lit((1 << w) - 1))
    left, right = [], []
    for k, (s, w) in enumerate(cut):
        masks = [sum(1 << i for i in c) for n in range(r + 1) for c in combinations(range(w), n)]
        own, band = piece(F.col("hash"), s, w), F.lit(k).alias("band")
        left.append(F.transform(F.array(*map(F.lit, masks)), _flip(own, band)))
        right.append(F.struct(F.lit(k).alias("band"), own.alias("bits")))
    a = nodes.select(F.col("hash").alias("ha"), F.explode(F.concat(*left)).alias("k")).select("ha", "k.band", "k.bits")
    b = nodes.select(F.col("hash").alias("hb"), F.explode(F.array(*right)).alias("k")).select("hb", "k.band", "k.bits")
    x = F.col("ha").bitwiseXOR(F.col("hb"))
    first = F.coalesce(*[F.when(F.bit_count(piece(x, s, w)) <= r, k) for k, (s, w) in enumerate(cut)])
    return a.join(b, ["band", "bits"]).where((F.col("ha") < F.col("hb")) & (F.bit_count(x) <= t) & (first == F.col("band"))).select("ha", "hb")


def near_hashes(nodes: DataFrame, t: int) -> DataFrame:
    """Pairs ``ha`` < ``hb`` of the different hashes of ``nodes`` (``hash``, each once) at most ``t`` bits apart."""
    many = nodes.count()
    plan = bands(t, many)
    return near_pairs(nodes.select("hash", F.array("hash").alias("words")), t, many) if plan is None else _banded(nodes, t, *plan)


def hamming_pairs(items: DataFrame, t: int) -> DataFrame:
    """All pairs ``a`` < ``b`` (by ``ord``) and their ``distance`` of items (``id``, ``ord``, ``hash``) at most ``t`` bits apart.

    Hashes are compared once each, whatever the number of items that have them."""
    base = items.where("hash is not null")
    nodes = stage(base.select("hash").distinct())
    near = near_hashes(nodes, t)
    both = near.union(near.select("hb", "ha")).union(nodes.select("hash", F.col("hash").alias("h")))
    a = base.select(F.col("id").alias("a"), F.col("ord").alias("oa"), F.col("hash").alias("ha"))
    b = base.select(F.col("id").alias("b"), F.col("ord").alias("ob"), F.col("hash").alias("hb"))
    pairs = a.join(both, "ha").join(b, "hb").where(F.col("oa") < F.col("ob"))
    return pairs.select("a", "b", "oa", "ob", F.bit_count(F.col("ha").bitwiseXOR(F.col("hb"))).alias("distance"))


def clusters(items: DataFrame, t: int, near: DataFrame | None = None) -> DataFrame:
    """``id`` and ``leader`` of each item under sequential leader clustering by Hamming distance, see ``leaders``.

    Items of equal hash share a leader, so one of each hash, the first, stands for all; a null hash leads itself.
    ``near`` has the pairs of hashes (``ha``, ``hb``) at most ``t`` apart where ``hash`` only numbers them."""
    base = items.where("hash is not null")
    first = stage(base.groupBy("hash").agg(F.min("ord").alias("ord"), F.min_by("id", "ord").alias("id")))
    near = near_hashes(first.select("hash"), t) if near is None else near
    a = first.select(F.col("hash").alias("ha"), F.col("id").alias("a"), F.col("ord").alias("oa"))
    b = first.select(F.col("hash").alias("hb"), F.col("id").alias("b"), F.col("ord").alias("ob"))
    ends = near.join(a, "ha").join(b, "hb")
    turn = F.col("oa") > F.col("ob")
    pick = lambda x, y: F.when(turn, F.col(y)).otherwise(F.col(x))
    edges = ends.select(pick("a", "b").alias("a"), pick("b", "a").alias("b"), pick("oa", "ob").alias("oa"), pick("ob", "oa").alias("ob"))
    lead = leaders(first, edges).withColumnRenamed("id", "first")
    known = first.select(F.col("id").alias("first"), "hash").join(lead, "first").select("hash", "leader")
    return base.join(known, "hash").select("id", "leader").union(items.where("hash is null").select("id", F.col("id").alias("leader")))


def leaders(items: DataFrame, edges: DataFrame) -> DataFrame:
    """``id`` and ``leader`` of each item under sequential leader clustering in ``ord``: an item leads unless an earlier
    leader is near; others join their first near leader.  ``edges`` (``a``, ``b``, ``oa``, ``ob``) has a before b.

    In rounds: items without an undecided earlier neighbour lead, and their later neighbours don't.  When few edges are left
    between undecided items, one task goes through those in order, so a long chain takes no round for each link."""
    edges = stage(edges.select("a", "b", "oa", "ob"))
    node = lambda k: F.struct(F.col(k).alias("id"), F.col(f"o{k}").alias("ord"))
    touched = edges.select(F.explode(F.array(node("a"), node("b"))).alias("n")).select("n.*").distinct()
    open_ = stage(touched)
    lead = stage(items.select("id").join(open_, "id", "left_anti"))
    live = edges
    while (left := live.count()) > LAST:
        new = stage(open_.select("id").join(live.select(F.col("b").alias("id")), "id", "left_anti"))
        out = live.join(new.select(F.col("id").alias("a")), "a", "left_semi").select(F.col("b").alias("id"))
        lead = lead.union(new)
        rest = stage(open_.join(new, "id", "left_anti").join(out, "id", "left_anti"))
        kept = live.join(rest.select(F.col("id").alias("a")), "a", "left_semi").join(rest.select(F.col("id").alias("b")), "b", "left_semi")
        last, live = live, stage(kept)
        drop(open_, *([last] if last is not edges else []))
        open_ = rest
    if left:
        lead = lead.union(_in_turn(open_, live))
    else:
        lead = lead.union(open_.select("id"))
    lead = stage(lead)
    joined = edges.join(lead.select(F.col("id").alias("a")), "a", "left_semi").groupBy("b").agg(F.min_by("a", "oa").alias("leader")).withColumnRenamed("b", "id")
    alone = lead.select("id", F.col("id").alias("leader"))
    return alone.union(joined.join(lead, "id", "left_anti").select("id", "leader"))


def _in_turn(open_: DataFrame, live: DataFrame) -> DataFrame:
    """Ids of the undecided items that lead, found by going through them in order; there are ``LAST`` edges at most."""
    alone = open_.select("id").join(live.select(F.explode(F.array("a", "b")).alias("id")), "id", "left_anti")
    ends = live.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("oa").alias("ord")), F.struct(F.col("b").alias("id"), F.col("ob").alias("ord")))).alias("n"))
    order = stage(ends.select("n.*").distinct().withColumn("k", F.row_number().over(W.orderBy("ord")) - 1))
    a, b = order.select(F.col("id").alias("a"), F.col("k").alias("ka")), order.select(F.col("id").alias("b"), F.col("k").alias("kb"))
    numbered = live.join(a, "a").join(b, "b").select("ka", "kb", F.lit(0).alias("g"))

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        leads = np.ones(int(max(pdf["ka"].max(), pdf["kb"].max())) + 1, dtype=bool)
        for before, after in pdf.sort_values("kb", kind="stable")[["ka", "kb"]].itertuples(index=False):
            if leads[before]:
                leads[after] = False
        return pd.DataFrame({"k": np.flatnonzero(leads).astype(np.int32)})

    return alone.union(order.join(numbered.groupBy("g").applyInPandas(walk, "k int"), "k").select("id"))


def representatives(items: DataFrame, clusters: DataFrame, score: Column) -> DataFrame:
    """The member with the highest score of each cluster; among equals the first in ``ord``."""
    return items.join(clusters, "id").groupBy("leader").agg(F.min_by("id", F.struct(-score, F.col("ord"))).alias("keep"), F.count("*").alias("members"))


def cross_split(items: DataFrame, clusters: DataFrame, split: str = "split") -> DataFrame:
    """Clusters whose members lie in more than one split, with their size and number of splits."""
    return items.join(clusters, "id").groupBy("leader").agg(F.count("*").alias("members"), F.countDistinct(split).alias("splits")).where("splits > 1")


def duplicate_groups(items: DataFrame, digest: Column, split: str | None = None) -> DataFrame:
    """Groups of more than one item with equal content: digest, size, first id, and the number of splits if asked."""
    aggs = [F.count("*").alias("members"), F.min("id").alias("first_id")]
    if split:
        aggs.append(F.countDistinct(split).alias("splits"))
    return items.groupBy(digest.alias("digest")).agg(*aggs).where("members > 1")


def temporal_kept(dets: DataFrame, t: int, cooldown: int) -> DataFrame:
    """``dets`` (``video``, ``frame``, ``ord``, ``hash`` and more) with ``kept``: false if one kept within ``cooldown`` frames before it
    in its video is at most ``t`` bits apart.  A null hash is near to none.

    Each video is gone through in order once, across batches, with the kept ones of one cooldown in memory."""
    schema = T.StructType([*[f for f in dets.schema.fields if f.name != "kept"], T.StructField("kept", T.BooleanType())])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        video, frames, hashes = object(), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in batches:
            kept = np.ones(b.num_rows, dtype=bool)
            for i, (v, f, h) in enumerate(zip(*(b.column(c).to_pylist() for c in ("video", "frame", "hash")))):
                if v != video:
                    video, frames, hashes = v, frames[:0], hashes[:0]
                if h is None:
                    continue
                if len(frames) and f - frames[0] > cooldown:
                    first = np.searchsorted(frames, f - cooldown)
                    frames, hashes = frames[first:], hashes[first:]
                kept[i] = not (np.bitwise_count((hashes ^ np.int64(h)).view(np.uint64)) <= t).any()
                if kept[i]:
                    frames, hashes = np.append(frames, f), np.append(hashes, np.int64(h))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(kept)], [*b.schema.names, "kept"])

    return dets.drop("kept").repartition("video").sortWithinPartitions("video", "ord").mapInArrow(walk, schema)
