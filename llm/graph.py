"""Connected components of a link table by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import hot_keys, materialize, remove, spread_join

#: Below so many edges no node's edges are too many for a task.
SMALL = 200_000


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``component`` (the smallest id that can be reached) of every end of ``links`` (``a``, ``b``) that isn't the
    smallest itself.  Each step is two aggregations and joins, the edges of a hub dealt to several tasks; nothing but a count
    and a checksum comes to the driver.  The steps end by themselves, after about the squared logarithm of the nodes."""
    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark, total = None, edges.count()
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        up, used = edges.select(F.col("v").alias("u"), F.col("u").alias("v")), [edges]
        large = _by_node(up, least, total, used).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        if total > SMALL:
            large = materialize(large, "large")
            used.append(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        ends = F.array(F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")), F.struct("u", F.col("m").alias("v")))
        small = _by_node(large, least, total, used).select(F.explode(ends).alias("e")).select("e.*").where("u <> v").distinct()
        now = materialize(small, "edges")
        row = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        remove(*used)
        edges, total = now, row[0]
        if tuple(row) == mark:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
        mark = tuple(row)


def _by_node(edges: DataFrame, least: DataFrame, total: int, used: list[DataFrame]) -> DataFrame:
    """``edges`` with the ``m`` of their node ``u``; a hub's edges go to several tasks."""
    if total <= SMALL:
        return edges.join(least, "u")
    hot = materialize(hot_keys(edges.groupBy("u").agg(F.count("*").alias("c")), ["u"], "c", total), "hubs")
    used.append(hot)
    return spread_join(edges, least, ["u"], hot)


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For 0 .. n-1 the smallest number that links ``a``-``b`` reach."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if np.array_equal(before, label):
            break
    return label
