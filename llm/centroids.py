"""Centroid clustering of integer vectors, exact, with partial-distance search.

Components are floor(1024 * x).  Lloyd's rounds run over the table as it is: each task holds a batch of vectors and the few
centroids, and what it returns are exact sums for each cluster and dimension, added up by Spark; the driver gets those of all
clusters (a few hundred numbers) and makes the next centroids by whole-number division.

The search goes through the dimensions in order of their variance over the whole table, a slice at a time.  A centroid is given
up for a vector as soon as its sum is strictly above the vector's best finished distance; a vector's best begins as the distance
to the centroid that looked nearest after the first slice, so most others end early.  What is not given up finishes all
dimensions, so the nearest centroid is the true one and ties go to the smaller number.

Defined results for odd input: vectors that are null, have another length, or hold null or non-finite components are left out.
Repeated rows count each.  Rows without an id are clustered, but can only be first centroids where ids run short.  Components
beyond ``SAFE`` are reckoned with Python's whole numbers, so nothing overflows; a distance or sum beyond 64 bits is given as
null.  With fewer vectors than centroids there are as many centroids as vectors.  Other columns are ignored.  An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import materialize, table

#: Integers up to this size: 64 squares of differences fit into 63 bits.
SAFE = 1 << 27
#: Sums are sent in digits of this base, so that Spark can add them as decimals whatever their size.
BASE = 10**30
SLICE = 16
SUMS = "cluster int, dim int, digit int, s decimal(38,0)"


def integers(vectors: np.ndarray) -> np.ndarray:
    """floor(1024 * x) of doubles, as int64 where all are within ``SAFE``, else as Python's whole numbers."""
    if not vectors.size or np.abs(vectors).max() < SAFE / 1024 - 1:
        return np.floor(1024 * vectors).astype(np.int64)
    whole = lambda x: int(x) * 1024 if abs(x) >= 2.0**53 else int(np.floor(1024 * x))
    return np.array([[whole(float(x)) for x in row] for row in vectors], dtype=object)


def nearest(v: np.ndarray, centroids: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of and squared distance to the nearest of ``centroids`` for each row of ``v``, by partial distances over the
    dimensions in ``order``, and how many differences that took."""
    if v.dtype == object or centroids.dtype == object:
        v, centroids = v.astype(object), centroids.astype(object)
    n, k = len(v), len(centroids)
    v, centroids = v[:, order], centroids[:, order]

    def part(rows, c, lo: int) -> np.ndarray:
        d = v[rows, lo : lo + SLICE] - c[..., lo : lo + SLICE]
        return (d * d).sum(axis=-1)

    steps = range(0, len(order), SLICE)
    begun = np.stack([part(slice(None), centroids[c], 0) for c in range(k)], axis=1)
    work = begun.size * min(SLICE, len(order))
    guess = begun.argmin(axis=1) if v.dtype != object else np.array([min(range(k), key=r.__getitem__) for r in begun], dtype=np.int64)
    best = begun[np.arange(n), guess]
    for lo in steps[1:]:
        best = best + part(slice(None), centroids[guess], lo)
        work += n * min(SLICE, len(order) - lo)
    chosen = guess.copy()
    for c in range(k):
        rows = np.flatnonzero((guess != c) & (begun[:, c] <= best).astype(bool))
        sums = begun[rows, c]
        for lo in steps[1:]:
            if not len(rows):
                break
            sums = sums + part(rows, centroids[c], lo)
            work += len(rows) * min(SLICE, len(order) - lo)
            left = (sums <= best[rows]).astype(bool)  # given up only when strictly above
            rows, sums = rows[left], sums[left]
        better = ((sums < best[rows]) | ((sums == best[rows]) & (c < chosen[rows]))).astype(bool)
        chosen[rows[better]], best[rows[better]] = c, sums[better]
    return chosen, best, work


def _vectors(batches: Iterator[pa.RecordBatch], size: int, rows: int = 4096) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and integer vectors, a few thousand rows at a time; ids stay in Arrow, so nulls don't change the others."""
    for b in batches:
        for lo in range(0, b.num_rows, rows):
            some = b.slice(lo, rows)
            yield some.column("vec_id"), integers(some.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(-1, size))


def kept(rows: DataFrame, size: int = 64) -> DataFrame:
    """``vec_id`` and ``embedding`` (doubles) of the vectors of ``size`` finite components."""
    e = F.col("embedding").cast("array<double>")
    fine = F.forall(e, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return rows.where((F.size(e) == size) & fine).select("vec_id", e.alias("embedding"))


def _first(rows: DataFrame, k: int, salt: str) -> np.ndarray:
    """The first centroids: the ``k`` vectors with the least hash of their id, by hash and then by components."""
    chosen = rows.withColumn("_h", F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)).orderBy(F.col("_h").asc_nulls_last(), "embedding").limit(k).collect()
    return integers(np.array([r["embedding"] for r in chosen], dtype=np.float64).reshape(len(chosen), len(chosen[0]["embedding"]) if chosen else 0))


def _sums(rows: DataFrame, centroids: np.ndarray, order: np.ndarray) -> DataFrame:
    """Exact sums of each cluster: dimension -1 is the number of vectors, others are components; in digits of base ``BASE``."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dims = centroids.shape
        held = np.zeros((k, dims + 1), dtype=object)
        for _, v in _vectors(batches, dims):
            number, _, _ = nearest(v, centroids, order)
            for c in range(k):
                mine = v[number == c]
                if len(mine):
                    held[c, 0] += len(mine)
                    held[c, 1:] += np.array([int(x) for x in mine.sum(axis=0)], dtype=object)
        sent = [(c, d - 1, i, x) for c in range(k) if held[c, 0] for d in range(dims + 1) for i, x in enumerate(_digits(held[c, d]))]
        types = [pa.int32(), pa.int32(), pa.int32(), pa.decimal128(38, 0)]
        yield pa.record_batch([pa.array([x[i] for x in sent], t) for i, t in enumerate(types)], ["cluster", "dim", "digit", "s"])

    return rows.mapInArrow(add, SUMS).groupBy("cluster", "dim", "digit").agg(F.sum("s").alias("s"))


def _digits(x: int) -> list[Decimal]:
    """The digits of ``x`` in base ``BASE``, lowest first, each with its sign."""
    sign, x, out = (-1 if x < 0 else 1), abs(x), []
    while x or not out:
        out.append(Decimal(sign * (x % BASE)))
        x //= BASE
    return out


def _totals(sums: DataFrame) -> dict[tuple[int, int], int]:
    out: dict[tuple[int, int], int] = {}
    for r in sums.collect():  # clusters times dimensions
        at = (r["cluster"], r["dim"])
        out[at] = out.get(at, 0) + int(r["s"]) * BASE ** r["digit"]
    return out


def _as_array(rows: list[list[int]]) -> np.ndarray:
    small = all(abs(x) < SAFE for r in rows for x in r)
    return np.array(rows, dtype=np.int64 if small else object)


def by_variance(rows: DataFrame, size: int) -> np.ndarray:
    """The dimensions, those of most variance first; only the order of the search depends on it, never the result."""
    one = rows.agg(*[F.coalesce(F.var_pop(F.get("embedding", i)), F.lit(0.0)).alias(f"v{i}") for i in range(size)]).first()
    return np.argsort([-np.nan_to_num(x) for x in one], kind="stable")


def apply(vectors: DataFrame, k: int = 8, rounds: int = 10, size: int = 64, salt: str = "3:") -> DataFrame:
    """``vec_id cluster distance cluster_inertia inertia centroid_sha256`` of every vector, after ``rounds`` of exact Lloyd steps
    from the ``k`` vectors whose sha256 of ``salt`` and id is least.  ``vectors`` is a written table, read once a round."""
    rows = kept(vectors, size)
    centroids, order = _first(rows, k, salt), by_variance(rows, size)
    ids = vectors.schema["vec_id"].dataType.simpleString()
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], f"vec_id {ids}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        found = _totals(_sums(rows, centroids, order))
        centroids = _as_array([[found[c, d] // found[c, -1] for d in range(size)] if found.get((c, -1)) else [int(x) for x in centroids[c]] for c in range(len(centroids))])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for id_, v in _vectors(batches, size):
            number, distance, _ = nearest(v, centroids, order)
            exact = [int(x) for x in distance]
            fits = pa.array([x if x < 1 << 63 else None for x in exact], pa.int64())
            big = pa.array([None if x < 1 << 63 else _digits(x) for x in exact], pa.list_(pa.decimal128(38, 0)))
            yield pa.record_batch([id_, pa.array(number, pa.int32()), fits, big], ["vec_id", "cluster", "distance", "big"])

    done = materialize(rows.mapInArrow(assign, f"vec_id {ids}, cluster int, distance long, big array<decimal(38,0)>"), "clusters")
    digits = F.coalesce(F.col("big"), F.array(F.col("distance").cast("decimal(38,0)")))
    parts = done.select("cluster", F.lit(0).alias("dim"), F.posexplode(digits).alias("digit", "s"))
    inertia = {c: x for (c, _), x in _totals(parts.groupBy("cluster", "dim", "digit").agg(F.sum("s").alias("s"))).items()}
    long = lambda x: F.lit(x if x is not None and x < 1 << 63 else None).cast("long")
    of, sha = F.lit(None).cast("long"), F.lit(None).cast("string")
    for c, centre in enumerate(centroids):
        text = ",".join(str(int(x)) for x in centre)
        of = F.when(F.col("cluster") == c, long(inertia.get(c))).otherwise(of)
        sha = F.when(F.col("cluster") == c, hashlib.sha256(text.encode()).hexdigest()).otherwise(sha)
    return done.select("vec_id", "cluster", "distance", of.alias("cluster_inertia"), long(sum(inertia.values())).alias("inertia"), sha.alias("centroid_sha256"))


def oracle_sql(k: int = 8, rounds: int = 10, size: int = 64) -> str:
    """The rows of ``op11_centroid_clustering`` in DuckDB SQL, a pair of steps for each round."""
    near = lambda c: f"""SELECT v.rid, arg_min(c.n, (d, c.n)) AS n, min(d) AS d FROM (SELECT v.rid, c.n, list_sum(list_transform(range(1, {size + 1}), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i]))) AS d
  FROM v CROSS JOIN {c} c) c JOIN v USING (rid) GROUP BY v.rid"""  # noqa: E731
    steps = []
    for i in range(rounds):
        steps.append(f"a{i} AS MATERIALIZED ({near(f'c{i}')})")
        steps.append(f"""c{i + 1} AS MATERIALIZED (SELECT c.n, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN (SELECT n, list(((s - ((s % t) + t) % t) // t)::BIGINT ORDER BY i) AS x FROM
  (SELECT a.n, i, sum(x[i])::HUGEINT AS s, count(*)::HUGEINT AS t FROM v JOIN a{i} a USING (rid) CROSS JOIN range(1, {size + 1}) r(i) GROUP BY a.n, i) GROUP BY n) m USING (n))""")
    return f"""WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size}),
 c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS n, x FROM v ORDER BY sha256('3:' || vec_id) LIMIT {k}),
 {', '.join(steps)}, z AS MATERIALIZED ({near(f'c{rounds}')})
SELECT vec_id, z.n::INTEGER AS cluster, z.d::BIGINT AS distance, (sum(z.d) OVER (PARTITION BY z.n))::BIGINT AS cluster_inertia, (sum(z.d) OVER ())::BIGINT AS inertia,
 sha256(array_to_string(c.x, ',')) AS centroid_sha256 FROM v JOIN z USING (rid) JOIN c{rounds} c ON c.n = z.n"""


ORACLE_SQL = oracle_sql()


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply(table(spark, sf_dir, "embeddings"))
