"""Mixing sources to target weights, with DataFrame functions only, by a multivariate-hypergeometric splitting tree.

1. Targets.  Each source has a weight; a share of the total goes to the sources by weight, no source above ``max_epochs``
   times its words, the excess reshared by weight among the rest (water filling, exact).
2. Blocks.  A source's documents fall into blocks by hash, and the blocks have a random order (a permutation by hash).
   A target is so many whole passes over the source, then the first blocks of the order, then a hash-ordered part of one
   more block, up to the first document that is longer than what is left.  That gap is filled with other documents in hash
   order, passing over those that don't fit, until none fits that isn't taken.
3. Splitting tree.  The quota of blocks of every source is divided among the output shards: each node of a binary tree over
   the shards draws, from a multivariate hypergeometric distribution, how many blocks of each source its left half gets.
   Quotas are kept exactly, shards have equal numbers of blocks, and each shard draws its own disjoint run of the order.
4. Rows go to their shards, each partition of the output to one of them, and are shuffled there by hash.

Only counts come to the driver: a row for each source, and one for each block, of which a source has ``max_blocks`` at most
and all sources together ``all_blocks``, or one each if there are more sources than that; and a few hundred sizes of each source
that fill its gap.

Defined results for odd input: a null source is a source of its own, last in order; a null or blank text has size 0 and
follows its block; an empty table gives an empty result.  Texts of any length are read whole.  Everything depends on ``seed``, ids and texts alone, so reruns
agree, in whatever order rows are read.  Rows equal in id, text and source stay together and count as one document that is so
many times as long.  No target is exceeded, and what it lacks is less than the shortest document that could be taken once
more.  Extra columns pass through; one called like an added one, whatever its case, gives way to it.
"""

from __future__ import annotations

import bisect
import json
import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import materialize, remove, table, words

#: More rows than this of (source, block) are joined by shuffle instead of broadcast; a row has under 100 bytes.
BROADCAST_ROWS = 200_000
SUB = 1024
#: The first number of the blocks that fill a source's gap; the others are below it.
MORE = -1
ADDED = ("size", "source_size", "target", "shards")


def size_of(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.size(words(text)).cast("long")


def targets(sizes: list[int], weights: list[float], share: float, max_epochs: float) -> list[float]:
    """Words for each source: ``share`` of all words by weight, none over ``max_epochs`` times its own."""
    left, out, free = share * sum(sizes), [0.0] * len(sizes), [i for i, n in enumerate(sizes) if n > 0]
    while free:
        per = left / sum(weights[i] for i in free)
        over = [i for i in free if weights[i] * per > max_epochs * sizes[i]]
        for i in over or free:
            out[i] = max_epochs * sizes[i] if over else weights[i] * per
            left -= out[i]
        free = [i for i in free if i not in set(over)] if over else []
    return out


def split_quotas(quotas: list[int], shards: int, seed: int) -> list[list[int]]:
    """Blocks of each source by shard: a tree of hypergeometric draws that keeps every quota and evens out the shards."""
    rng, out = np.random.Generator(np.random.PCG64(seed)), [[0] * len(quotas) for _ in range(shards)]

    def node(lo: int, hi: int, have: np.ndarray) -> None:
        if hi - lo == 1:
            out[lo] = [int(x) for x in have]
            return
        mid, total = (lo + hi) // 2, int(have.sum())
        left, base = total * (mid - lo) // (hi - lo), np.zeros_like(have)
        if len(have):
            base = rng.multivariate_hypergeometric(have, left, method="marginals")
        node(lo, mid, base)
        node(mid, hi, have - base)

    node(0, shards, np.asarray(quotas, dtype=np.int64))
    return out


def _rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A few driver rows as a DataFrame, without leaving the JVM."""
    return spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")).alias("r")).select("r.*")


def _near(small: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(small) if rows <= BROADCAST_ROWS else small


def assign(
    docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, max_epochs: float = 2.0, shards: int = 64,
    block_rows: int = 256, max_blocks: int = 1024, all_blocks: int = 100_000, seed: int = 42, fill: int = 512,
) -> DataFrame:
    """``docs`` plus ``size``, ``source_size``, ``target`` and ``shards``, the output shard of each copy that the mix takes.

    Columns of ``docs`` that are called so, whatever their case, give way; all others stay, whatever their names."""
    found = _assigned(docs, weights, share, max_epochs, shards, block_rows, max_blocks, all_blocks, seed, fill)
    own = [c for c in docs.columns if c.lower() not in ADDED]
    return found.select(*[F.col("_row").getField(c).alias(c) for c in own], *ADDED)


def _assigned(docs: DataFrame, weights: tuple[float, ...], share: float, max_epochs: float, shards: int, block_rows: int, max_blocks: int, all_blocks: int, seed: int, fill: int) -> DataFrame:
    """``_row``, each row of ``docs`` as one column, so that its names meet no others, and the columns ``ADDED``."""
    spark = docs.sparkSession
    key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))  # names sort as before, and null has a name that no source has
    digest = lambda salt: F.xxhash64(F.lit(seed), F.lit(salt), F.col("doc_id"), F.col("text"))
    slim = materialize(docs.select(key.alias("_key"), digest("block").alias("_h"), digest("order").alias("_u"), size_of(F.col("text")).alias("size")), "sizes")

    source = slim.groupBy("_key").agg(F.count("*").alias("n"), F.sum("size").alias("words")).collect()  # a row for each source
    source = sorted(source, key=lambda r: (r["_key"] == "n", r["_key"]))
    place = {r["_key"]: i for i, r in enumerate(source)}
    held_words = [r["words"] for r in source]
    goal = targets(held_words, [weights[i % len(weights)] for i in range(len(source))], share, max_epochs)
    blocks = [max(1, min(max_blocks, all_blocks // len(source), math.ceil(r["n"] / block_rows))) for r in source]
    about = _rows(spark, [{"_key": r["_key"], "_nb": b, "_sid": i, "source_size": r["words"], "target": g} for i, (r, b, g) in enumerate(zip(source, blocks, goal))], "_key:string,_nb:bigint,_sid:int,source_size:bigint,target:double")

    def blocked(df: DataFrame, columns: list[str]) -> DataFrame:
        return df.join(_near(about, len(source)), "_key").withColumn("_block", F.pmod("_h", "_nb")).select(*columns)

    # The order of blocks, and how far each target reaches in it.
    by_block = blocked(slim, ["_sid", "_block", "size"]).groupBy("_sid", "_block").agg(F.sum("size").alias("w")).collect()  # bounded by max_blocks a source
    held: list[dict[int, int]] = [{} for _ in source]
    for r in by_block:
        held[r["_sid"]][r["_block"]] = r["w"]
    rng = np.random.Generator(np.random.PCG64(seed))
    order = [[int(b) for b in rng.permutation(n)] for n in blocks]
    whole, taken, edge = [], [], {}
    for i, g in enumerate(goal):
        full, got = int(g // held_words[i]) if held_words[i] else 0, []
        rest = g - full * held_words[i]
        for b in order[i] if rest >= 1 else ():  # less than a word can't be filled, not even by documents without words
            if held[i].get(b, 0) > rest:
                edge[i] = (b, rest)
                break
            rest -= held[i].get(b, 0)
            got.append(b)
        whole.append(full)
        taken.append(got)

    # Inside the last block of a source: the place in hash order where the target is met, found by narrowing 1024-fold.
    low = {i: (-(2**63), 2**63 - 1, rest) for i, (_, rest) in edge.items()}  # first and last hash that may hold the place
    cut: dict[int, int] = {}
    left: dict[int, float] = {}
    while low:
        look = _rows(spark, [{"_sid": i, "_block": edge[i][0], "_lo": a, "_hi": b, "_step": max(1, -((a - b - 1) // SUB))} for i, (a, b, _) in low.items()], "_sid:int,_block:bigint,_lo:bigint,_hi:bigint,_step:decimal(20,0)")
        inside = blocked(slim, ["_sid", "_block", "_u", "size"]).join(_near(look, len(low)), ["_sid", "_block"]).where(F.col("_u").between(F.col("_lo"), F.col("_hi")))
        part = F.floor((F.col("_u").cast("decimal(20,0)") - F.col("_lo").cast("decimal(20,0)")) / F.col("_step")).cast("int")
        seen = inside.groupBy("_sid", part.alias("p")).agg(F.sum("size").alias("w"), F.min("_u").alias("a"), F.max("_u").alias("b")).collect()  # at most SUB a source
        ahead = {}
        for i, (a, _, rest) in low.items():
            cut[i] = cut.get(i, max(a - 1, -(2**63)))
            for r in sorted((r for r in seen if r["_sid"] == i), key=lambda r: r["p"]):
                if r["w"] > rest:
                    if r["a"] < r["b"]:
                        ahead[i] = (r["a"], r["b"], rest)
                    break
                rest -= r["w"]
                cut[i] = r["b"]
            left[i] = rest
        low = ahead
    passed = [{"_sid": i, "_block": b} for i in left for b in taken[i]]
    extra = _fill(spark, blocked(slim, ["_sid", "_block", "_u", "size"]), {i: (x, edge[i][0], cut[i]) for i, x in left.items() if x >= 1}, passed, max(16, min(fill, all_blocks // max(1, len(source)) // 8)))

    # Which shard has each block of each pass.
    runs = [[(b, e) for e in range(whole[i]) for b in order[i]] + [(b, whole[i]) for b in taken[i]] + ([(edge[i][0], whole[i])] if i in edge else []) for i in range(len(source))]
    for i, x in extra.items():  # what fills a gap is cut into blocks too, at random places of the order
        for k in range(math.ceil(len(x) / block_rows)):
            runs[i].insert(int(rng.integers(len(runs[i]) + 1)), (MORE - k, whole[i]))
    counts = split_quotas([len(x) for x in runs], shards, seed)
    plan: dict[tuple[int, int], list[list[int]]] = {}
    for i, run in enumerate(runs):
        ends = list(np.cumsum([c[i] for c in counts]))
        for at, (b, e) in enumerate(run):
            plan.setdefault((i, b), []).append([e, bisect.bisect_right(ends, at)])
    mapped = _rows(
        spark,
        [{"_sid": i, "_block": b, "_copies": [{"e": e, "s": s} for e, s in v], "_edge": whole[i] if i in edge and edge[i][0] == b else -1, "_cut": cut.get(i, 0)} for (i, b), v in plan.items() if b > MORE],
        "_sid:int,_block:bigint,_copies:array<struct<e:int,s:int>>,_edge:int,_cut:bigint",
    )
    more = [{"_sid": i, "_block": b, "_u": u, "_more": plan[i, MORE - k // block_rows][0][1]} for i, x in extra.items() for k, (b, u) in enumerate(x)]
    added = _rows(spark, more, "_sid:int,_block:bigint,_u:bigint,_more:int")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = docs.select(row, key.alias("_key"), digest("block").alias("_h"), digest("order").alias("_u"), size_of(F.col("text")).alias("size"))
    rows = blocked(rows, ["_row", "size", "source_size", "target", "_sid", "_block", "_u"])
    got = F.filter("_copies", lambda c: (c["e"] != F.col("_edge")) | (F.col("_u") <= F.col("_cut")))
    found = rows.join(_near(mapped, len(plan)), ["_sid", "_block"], "left").join(_near(added, len(more)), ["_sid", "_block", "_u"], "left")
    none = F.array().cast("array<int>")
    placed = F.concat(F.coalesce(F.transform(got, lambda c: c["s"]), none), F.when(F.col("_more").isNotNull(), F.array("_more")).otherwise(none))
    return found.select("_row", "size", "source_size", "target", placed.alias("shards"))


def _fill(spark: SparkSession, rows: DataFrame, open_: dict[int, tuple[float, int, int]], passed: list[dict], many: int) -> dict[int, list[tuple[int, int]]]:
    """Documents that fill what is left of each source's target: block and hash of those that fit, of the ones not yet taken in the
    last pass, in hash order, passing over those that are too long.  At the end no document that isn't taken would fit.

    ``open_`` has the words left, the last block and the place of its cut, for each source; ``passed`` the blocks that are taken
    whole.  About ``many`` documents of a source come to the driver at a time, a range of hashes; what is left then is mostly
    less than the shortest of them, so few documents still fit and a few rounds do."""
    out: dict[int, list[tuple[int, int]]] = {i: [] for i in open_}
    if not open_:
        return out
    state = _rows(spark, [{"_sid": i, "_left": x, "_last": b, "_cut": c} for i, (x, b, c) in open_.items()], "_sid:int,_left:double,_last:bigint,_cut:bigint")
    unused = rows.join(_near(state, len(open_)), "_sid").join(_near(_rows(spark, passed, "_sid:int,_block:bigint"), len(passed)), ["_sid", "_block"], "left_anti")
    unused = unused.where((F.col("_block") != F.col("_last")) | (F.col("_u") > F.col("_cut")))
    could = materialize(unused.groupBy("_sid", "_block", "_u", "_left").agg(F.sum("size").alias("w")).where(F.col("w").between(F.lit(1), F.col("_left"))).drop("_left"), "fill")
    left, begin, end = {i: x for i, (x, _, _) in open_.items()}, dict.fromkeys(open_, -(2**63)), 2**63 - 1
    while left:
        now = _rows(spark, [{"_sid": i, "_left": x, "_lo": begin[i]} for i, x in left.items()], "_sid:int,_left:double,_lo:bigint")
        fits = could.join(_near(now, len(left)), "_sid").where((F.col("w") <= F.col("_left")) & (F.col("_u") >= F.col("_lo")))
        count = {r["_sid"]: r["n"] for r in fits.groupBy("_sid").agg(F.count("*").alias("n")).collect()}
        upto = {i: min(end, begin[i] + (end - begin[i]) * many // n) if n > many else end for i, n in count.items()}
        until = _rows(spark, [{"_sid": i, "_hi": x} for i, x in upto.items()], "_sid:int,_hi:bigint")
        some = fits.join(_near(until, len(upto)), "_sid").where(F.col("_u") <= F.col("_hi")).select("_sid", "_u", "_block", "w").collect()
        for i, u, b, w in sorted(map(tuple, some)):
            if w <= left[i]:
                left[i] -= w
                out[i].append((b, u))
        begin = {i: x + 1 for i, x in upto.items()}
        left = {i: left[i] for i, x in upto.items() if left[i] >= 1 and x < end}
    remove(could)
    return out


def mix(
    docs: DataFrame, seed: int = 42, shards: int = 64, shard: str | None = "shard", part_rows: int = 100_000, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5,
    max_epochs: float = 2.0, block_rows: int = 256, max_blocks: int = 1024, all_blocks: int = 100_000, fill: int = 512,
) -> DataFrame:
    """The mixed rows: each copy that is taken, with the columns of ``docs`` and its shard's number in column ``shard`` (None:
    without), for which one called so gives way.  Every partition holds rows of one shard only, in hash order; a shard has a
    partition for each ``part_rows`` rows it can hold at most."""
    parts = max(1, math.ceil(max_epochs * docs.count() / shards / part_rows))
    columns = [c for c in docs.columns if shard is None or c.lower() != shard.lower()]
    out = _assigned(docs, weights, share, max_epochs, shards, block_rows, max_blocks, all_blocks, seed, fill).select("_row", F.posexplode("shards").alias("_copy", "_shard"))
    order = F.xxhash64(F.lit(seed), "_row.doc_id", "_row.text", "_copy")
    placed = out.repartitionById(shards * parts, (F.col("_shard") * parts + F.pmod(order, F.lit(parts))).cast("int"))
    placed = placed.sortWithinPartitions(order, "_row.doc_id", "_row.text", "_copy")
    return placed.select(*[F.col("_row").getField(c).alias(c) for c in columns], *([F.col("_shard").alias(shard)] if shard else []))


def write_mix(docs: DataFrame, path: str, **options) -> None:
    """The mix as Parquet below ``path``, a folder ``shard=...`` for each shard."""
    mix(docs, shard="shard", **options).write.partitionBy("shard").parquet(path)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As the contract says, and in ``shards`` the output shard that the splitting tree gave each copy."""
    taken = (F.col("size") * F.size("shards")).cast("long")
    return assign(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", taken.alias("taken"), "shards")
