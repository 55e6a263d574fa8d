"""Near-duplicate embeddings by hierarchical navigable small-world graphs, a graph for each shard.

Equal vectors of a label are one node with a count, told apart by a 128-bit digest.  The nodes of a label are dealt to shards
of about ``shard_rows`` by hash, and each shard builds a graph.  Every node queries every shard of its label; a query's beam
doubles while all of it lies over the threshold, and every shard's beam doubles until an audit finds every link: its queries
are compared with all vectors of the shard, half of them nodes and half made so that they have a link close to the threshold.
Links are verified by cosine in double precision.  A task holds one pair of shards and returns a row for each vector, its number
of links and one link towards its group's first, so groups of any size stay linear.  Pairs of shards are listed as numbers, and
graphs are joined to them by shard, so that every shard's graph is sent equally often.

Defined results for odd input: a vector that is null, all zeros, or holds a null or a number that isn't finite links with
nothing, nor does one with a null label; vectors of different lengths never link.  Such a row is a component of its own.
Repeated rows are vectors of their own, linked by cosine 1, and so are rows that share an id; a null id links like others and
is never a smallest id: a component of null ids alone keeps null, and such rows are kept.  An empty table gives an empty
result.  Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import logging
import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import hot_keys, materialize, remove, spread_join, table
from llm.graph import components, local_components

BATCH = 256
#: Labels of more than one shard are broadcast up to this number (about 30 bytes each), and joined by shuffle beyond.
BROADCAST_LABELS = 200_000
log = logging.getLogger(__name__)


class Graph:
    """A navigable small-world graph of unit vectors, built and searched in batches."""

    def __init__(self, x: np.ndarray, degree: int = 16, beam: int = 64, seed: int = 3):
        self.x, self.degree = x.astype(np.float32), degree
        rng, n = np.random.default_rng(seed), len(x)
        level = np.minimum((-np.log(rng.random(n)) / np.log(degree)).astype(int), 6) if n else np.zeros(0, int)
        self.top = int(level.max()) if n else 0
        level[:1] = self.top
        self.entry = 0
        self.next = [np.full((n, 2 * degree if h == 0 else degree), -1, dtype=np.int32) for h in range(self.top + 1)]
        for lo in range(0, n, BATCH):
            self._insert(np.arange(lo, min(n, lo + BATCH)), level, beam)

    def _insert(self, new: np.ndarray, level: np.ndarray, beam: int) -> None:
        q, old = self.x[new], new[0]
        among = q @ q.T
        start = np.full(len(new), self.entry)
        for h in range(self.top, -1, -1):
            here = level[new] >= h
            ids = np.full((len(new), beam), -1, dtype=np.int64)
            if old:
                if h > 0 and not here.any():
                    start = self._greedy(q, start, h)
                    continue
                ids, _ = self._beam(q, start, h, beam, old)
                start = np.where(ids[:, 0] >= 0, ids[:, 0], start)
            mates = new[here]
            if not len(mates):
                continue
            k = min(len(mates), beam // 2)
            close = among[np.ix_(here, here)].copy()
            np.fill_diagonal(close, -9)
            near = mates[np.argsort(-close, axis=1, kind="stable")[:, :k]]
            if k == len(mates):
                near = np.where(near == mates[:, None], -1, near)
            chosen = self._select(mates, np.concatenate([ids[here], near], 1), self.degree)
            self.next[h][mates, : self.degree] = chosen
            a, b = np.repeat(mates, self.degree), chosen.ravel()
            self._back(h, b[b >= 0], a[b >= 0])

    def _select(self, nodes: np.ndarray, cand: np.ndarray, most: int) -> np.ndarray:
        """Up to ``most`` of each node's candidates: those nearer to it than to one already chosen, then the nearest others."""
        sim = np.where(cand >= 0, np.einsum("nd,nkd->nk", self.x[nodes], self.x[cand]), -9)
        order = np.argsort(-sim, axis=1, kind="stable")
        cand, sim = np.take_along_axis(cand, order, 1), np.take_along_axis(sim, order, 1)
        v = self.x[cand]
        pair = np.einsum("nkd,njd->nkj", v, v)
        good, taken = cand >= 0, np.zeros(cand.shape, dtype=bool)
        for k in range(cand.shape[1]):
            covered = ((pair[:, k, :k] > sim[:, k, None]) & taken[:, :k]).any(1) if k else np.zeros(len(nodes), bool)
            taken[:, k] = good[:, k] & ~covered & (taken.sum(1) < most)
        rank = np.argsort(~taken * 2 + ~good, axis=1, kind="stable")[:, :most]
        return np.where(np.take_along_axis(good, rank, 1), np.take_along_axis(cand, rank, 1), -1)

    def _back(self, h: int, at: np.ndarray, other: np.ndarray) -> None:
        table_, width = self.next[h], self.next[h].shape[1]
        order = np.argsort(at, kind="stable")
        at, other = at[order], other[order]
        known = (table_[at] == other[:, None]).any(1)
        at, other = at[~known], other[~known]
        if not len(at):
            return
        nodes, first, many = np.unique(at, return_index=True, return_counts=True)
        used = (table_[nodes] >= 0).sum(1)
        place = np.arange(len(at)) - np.repeat(first, many) + np.repeat(used, many)
        wide = np.full((len(nodes), width + int(many.max())), -1, dtype=np.int64)
        wide[:, :width] = np.sort(table_[nodes], axis=1)[:, ::-1]
        wide[np.repeat(np.arange(len(nodes)), many), place] = other
        full = used + many > width
        table_[nodes[~full]] = wide[~full, :width]
        for lo in range(0, int(full.sum()), BATCH):
            part = np.flatnonzero(full)[lo : lo + BATCH]
            table_[nodes[part]] = self._select(nodes[part], wide[part], width)

    def _greedy(self, q: np.ndarray, at: np.ndarray, h: int) -> np.ndarray:
        best = np.einsum("nd,nd->n", q, self.x[at])
        live = np.arange(len(q))
        while len(live):
            near = self.next[h][at[live]]
            sim = np.where(near >= 0, np.einsum("nd,nkd->nk", q[live], self.x[near]), -9)
            k = sim.argmax(1)
            s = sim[np.arange(len(live)), k]
            up = s > best[live]
            live, s, to = live[up], s[up], near[np.arange(len(near)), k][up]
            at[live], best[live] = to, s
        return at

    def _beam(self, q: np.ndarray, start: np.ndarray, h: int, beam: int, n: int, over: float = 9.0, spread: int = 4) -> tuple[np.ndarray, list]:
        """The best found, best first, among the first ``n`` vectors; and all pairs met whose cosine is ``over`` or more."""
        m, found = len(q), []
        seen = np.zeros((m, len(self.x)), dtype=bool)
        ids, sim, done = np.full((m, beam), -1, dtype=np.int64), np.full((m, beam), -9.0, dtype=np.float32), np.ones((m, beam), dtype=bool)
        ids[:, 0], done[:, 0] = start, False
        sim[:, 0] = np.einsum("nd,nd->n", q, self.x[start])
        seen[np.arange(m), start] = True
        hit = np.flatnonzero(sim[:, 0] >= over)
        found.append((hit, start[hit]))
        live = np.arange(m)
        while len(live):
            open_ = np.where(done[live], -9.0, sim[live])
            k = np.argpartition(-open_, min(spread, beam) - 1, axis=1)[:, :spread]
            take = np.take_along_axis(open_, k, 1) > -9
            np.put_along_axis(dl := done[live], k, True, 1)
            done[live] = dl
            near = self.next[h][np.where(take, np.take_along_axis(ids[live], k, 1), 0)]
            good = (near >= 0) & take[:, :, None]
            rows, _, _ = np.nonzero(good)
            code = np.unique(live[rows] * np.int64(len(self.x)) + near[good])
            row, col = np.divmod(code, len(self.x))
            fresh = ~seen[row, col]
            row, col = row[fresh], col[fresh]
            if len(row):
                seen[row, col] = True
                s = np.einsum("nd,nd->n", q[row], self.x[col])
                hit = s >= over
                found.append((row[hit], col[hit]))
                some, first, many = np.unique(row, return_index=True, return_counts=True)
                place = np.arange(len(row)) - np.repeat(first, many)
                more_i, more_s = np.full((len(some), int(many.max())), -1, dtype=np.int64), np.full((len(some), int(many.max())), -9.0, dtype=np.float32)
                at = np.repeat(np.arange(len(some)), many)
                more_i[at, place], more_s[at, place] = col, s
                all_i, all_s, all_d = np.concatenate([ids[some], more_i], 1), np.concatenate([sim[some], more_s], 1), np.concatenate([done[some], more_i < 0], 1)
                best = np.argpartition(-all_s, beam - 1, axis=1)[:, :beam]
                ids[some], sim[some], done[some] = np.take_along_axis(all_i, best, 1), np.take_along_axis(all_s, best, 1), np.take_along_axis(all_d, best, 1)
            live = live[~done[live].all(1)]
        order = np.argsort(-sim, axis=1, kind="stable")
        self.worst = np.take_along_axis(sim, order, 1)[:, -1]
        return np.take_along_axis(ids, order, 1), found

    def near(self, q: np.ndarray, over: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, vector) whose cosine is about ``over`` or more; a beam that lies over it entirely doubles."""
        out = []
        for lo in range(0, len(q), BATCH):
            part, todo, width = q[lo : lo + BATCH].astype(np.float32), np.arange(len(q[lo : lo + BATCH])), beam
            while len(todo):
                width = min(width, len(self.x))
                start = np.full(len(todo), self.entry)
                for h in range(self.top, 0, -1):
                    start = self._greedy(part[todo], start, h)
                _, found = self._beam(part[todo], start, 0, width, len(self.x), over, max(4, width // 16))
                again = (self.worst >= over) & (width < len(self.x))
                a, b = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
                ok = ~again[a]
                out.append((todo[a[ok]] + lo, b[ok]))
                todo, width = todo[again], 2 * width
        return (np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])) if out else (np.zeros(0, int), np.zeros(0, int))


def _exact(q: np.ndarray, x: np.ndarray, a: np.ndarray, b: np.ndarray, over: float) -> tuple[np.ndarray, np.ndarray]:
    keep = np.concatenate([np.einsum("nd,nd->n", q[a[k : k + 65536]], x[b[k : k + 65536]]) >= over for k in range(0, len(a), 65536)]) if len(a) else np.zeros(0, bool)
    return a[keep], b[keep]


def planted(x: np.ndarray, over: float, many: int) -> np.ndarray:
    """Unit vectors that each have one of ``x`` (unit vectors) a little over the threshold."""
    rng = np.random.default_rng(17)
    at = x[rng.integers(0, len(x), many)]
    side = rng.normal(size=at.shape)
    side -= np.einsum("nd,nd->n", side, at)[:, None] * at
    length = np.sqrt((side * side).sum(1, keepdims=True))
    near = min(1.0, over + 0.1 * (1 - over))
    out = near * at + np.sqrt(1 - near * near) * side / np.maximum(length, 1e-12)
    return np.where(length > 1e-9, out, at)


def audited(graph: Graph, x: np.ndarray, q: np.ndarray, over: float, beam: int, audit: int) -> tuple[np.ndarray, np.ndarray, int, int, int]:
    """All links of queries ``q`` to the graph's vectors ``x`` (both in double precision), the beam that passed the audit, and
    how many links the audit knew of and found with the first beam."""
    check = np.concatenate([q[np.unique(np.linspace(0, len(q) - 1, min(audit, len(q))).astype(int))], planted(x, over, audit)])
    truth = np.concatenate([(check[k : k + BATCH] @ x.T >= over).sum(1) for k in range(0, len(check), BATCH)])
    at_first = None
    while True:
        a, _ = _exact(check, x, *graph.near(check, over - 1e-4, beam), over)
        found = np.bincount(a, minlength=len(check))
        at_first = int(found.sum()) if at_first is None else at_first
        if beam >= len(x) or (found >= truth).all():
            break
        beam *= 2
    a, b = _exact(q, x, *graph.near(q, over - 1e-4, beam), over)
    return a, b, beam, int(truth.sum()), at_first


def _unit(rows: np.ndarray) -> np.ndarray:
    x = rows.astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _result(ids: np.ndarray, many: np.ndarray, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    """Per vector: links to others' copies, and the smallest id of its group; each unordered pair stands once in a, b."""
    links = np.zeros(len(ids), dtype=np.int64)
    np.add.at(links, a, many[b])
    np.add.at(links, b, many[a])
    rank = np.argsort(ids, kind="stable")
    place = np.empty_like(rank)
    place[rank] = np.arange(len(ids))
    low = ids[rank][local_components(len(ids), place[a], place[b])[place]]
    some = links > 0
    return pd.DataFrame({"id": ids[some], "links": links[some], "low": low[some]})


def _pairs(graph_a, graph_b, over: float, beam: int, audit: int, tally) -> pd.DataFrame:
    """Result rows of the links between two shards, or within one; ``tally`` gets the audits' figures."""
    (ids_a, many_a, x_a, g_a), (ids_b, many_b, x_b, g_b) = graph_a, graph_b
    a, b, _, truth, found = audited(g_b, x_b, x_a, over, beam, audit)
    tally(truth, found)
    if graph_a is graph_b:
        code = np.unique(np.minimum(a, b) * np.int64(len(ids_b)) + np.maximum(a, b))
        a, b = np.divmod(code, len(ids_b))
        return _result(ids_a, many_a, a[a != b], b[a != b])
    c, d, _, truth, found = audited(g_a, x_a, x_b, over, beam, audit)
    tally(truth, found)
    code = np.unique(np.concatenate([a * np.int64(len(ids_b)) + b, d * np.int64(len(ids_b)) + c]))
    a, b = np.divmod(code, len(ids_b))
    return _result(np.r_[ids_a, ids_b], np.r_[many_a, many_b], a, b + len(ids_a))


def _sent(ids: np.ndarray, many: np.ndarray, e: np.ndarray, graph: Graph) -> bytes:
    """A shard with its graph, the vectors as they came and neighbours in as few bytes as hold them."""
    small = np.int16 if len(ids) < 1 << 15 else np.int32
    return pickle.dumps((ids, many, e, graph.top, graph.entry, graph.degree, [x.astype(small) for x in graph.next]), protocol=5)


def _received(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, Graph]:
    ids, many, e, top, entry, degree, near = pickle.loads(data)
    x, graph = _unit(e), Graph.__new__(Graph)
    graph.x, graph.top, graph.entry, graph.degree, graph.next = x.astype(np.float32), top, entry, degree, [n.astype(np.int32) for n in near]
    return ids, many, x, graph


def _nodes(rows: DataFrame) -> DataFrame:
    """A row for each different vector of a label that can link: ``id``, ``h`` and ``i`` (its digest), ``label``, ``e``, ``low``, ``many``."""
    alike = rows.where("h is not null").groupBy("h", "i").agg(F.first("label").alias("label"), F.first("e").alias("e"), F.min("vec_id").alias("low"), F.count("*").alias("many"))
    return materialize(alike.withColumn("id", F.monotonically_increasing_id()), "nodes")


def _dealt(nodes: DataFrame, shard_rows: int) -> tuple[DataFrame, DataFrame]:
    """The nodes with their ``shard`` and the ``shards`` of their label; and the labels that have several."""
    alive = nodes.select("label", F.size("e").alias("dim"), "id", "many", "e", "h")
    wide = alive.groupBy("label", "dim").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("shards")).where("shards > 1")
    wide = materialize(wide, "labels")
    near = F.broadcast(wide) if wide.count() <= BROADCAST_LABELS else wide
    shards = F.coalesce("shards", F.lit(1))
    return alive.join(near, ["label", "dim"], "left").withColumn("shards", shards).withColumn("shard", F.pmod("h", "shards").cast("int")).drop("h"), wide


def link(vectors: DataFrame, over: float = 0.93, shard_rows: int = 4096, beam: int = 64, audit: int = 64) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of each row of ``vectors`` (``vec_id``, ``embedding``, ``label``)."""
    e = F.col("embedding")
    numbers = lambda a: a.isNotNull() & F.forall(a, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(a, lambda x: x != 0)
    fine = F.coalesce(F.col("label").isNotNull() & numbers(e), F.lit(False))
    digest = lambda salt: F.when(fine, F.xxhash64(F.lit(salt), "label", e))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", e.alias("e"), digest(1).alias("h"), digest(2).alias("i"))
    slim = materialize(rows.select("vec_id", "h", "i"), "rows")
    nodes = _nodes(rows)
    dealt, wide = _dealt(nodes, shard_rows)
    context = vectors.sparkSession.sparkContext
    known_of, found_of = context.accumulator(0), context.accumulator(0)

    def tally(truth: int, found: int) -> None:
        known_of.add(truth)
        found_of.add(found)

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        raw = np.stack(pdf["e"].to_numpy())
        x = _unit(raw)
        own = (pdf["id"].to_numpy(), pdf["many"].to_numpy(), x, Graph(x))
        out = _pairs(own, own, over, beam, audit, tally)
        graph = _sent(own[0], own[1], raw, own[3]) if pdf["shards"].iat[0] > 1 else None
        return pd.DataFrame({"label": [pdf["label"].iat[0]], "dim": [pdf["dim"].iat[0]], "shard": [pdf["shard"].iat[0]], "graph": [graph], "out": [list(out.itertuples(index=False, name=None))]})

    kind = dict(dealt.dtypes)["label"]
    schema = f"label {kind}, dim int, shard int, graph binary, out array<struct<id:long,links:long,low:long>>"
    built = materialize(dealt.groupBy("label", "dim", "shard").applyInPandas(build, schema), "graphs")
    within = built.select(F.explode("out").alias("o")).select("o.*")

    # Shard i meets the next half of the shards in a circle: every pair once, every shard equally often.
    turn = F.explode(F.sequence(F.lit(1), (F.col("shards") / 2).cast("int"))).alias("turn")
    pairs = wide.select("label", "dim", "shards", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard")).select("*", turn)
    pairs = pairs.where("2 * turn < shards or shard < turn").select("label", "dim", "shard", ((F.col("shard") + F.col("turn")) % F.col("shards")).alias("other"))
    graphs = built.where("graph is not null").select("label", "dim", "shard", "graph")
    others = graphs.select("label", "dim", F.col("shard").alias("other"), F.col("graph").alias("graph_b"))

    def cross(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.concat([_pairs(_received(g), _received(h), over, beam, audit, tally) for g, h in zip(pdf["graph"], pdf["graph_b"])])

    met = pairs.join(graphs, ["label", "dim", "shard"]).join(others, ["label", "dim", "other"])
    between = met.groupBy("label", "dim", "shard", "other").applyInPandas(cross, "id long, links long, low long")
    parts = materialize(within.unionByName(between), "links")
    log.info("audits knew %d links, the first beam found %d", known_of.value, found_of.value)

    group = components(parts.select(F.col("id").alias("a"), F.col("low").alias("b")))
    count = parts.groupBy("id").agg(F.sum("links").alias("links"))
    known = nodes.drop("label", "e").join(count, "id", "left").join(group, "id", "left")
    known = materialize(known.select("h", "i", "many", "low", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "id").alias("component")), "known")
    least = materialize(known.groupBy("component").agg(F.min("low").alias("least"), F.count("*").alias("c")), "least")
    broad = hot_keys(least, ["component"], "c", known.count())
    known = materialize(spread_join(known, least.drop("c"), ["component"], broad), "known")
    remove(parts, built, nodes, wide, group, least)
    often = hot_keys(known, ["h", "i"], "many", slim.count())
    out = spread_join(slim, known.select("h", "i", "many", "links", "least"), ["h", "i"], often, "left")
    top = F.when(F.col("many").isNull(), F.col("vec_id")).otherwise(F.col("least"))
    links = F.coalesce(F.col("links") + F.col("many") - 1, F.lit(0)).cast("long")
    return out.select("vec_id", links.alias("n_links"), top.alias("component_id"), F.col("vec_id").eqNullSafe(top).alias("kept"))


#: The same rows in DuckDB SQL: all pairs of a label, then transitive closure.
ORACLE_SQL = r"""WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
 l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
 t(id, m) AS (SELECT DISTINCT a, a FROM l UNION SELECT l.b, t.m FROM t JOIN l ON l.a = t.id WHERE t.m < l.b), g AS (SELECT id, min(m) AS m FROM t GROUP BY id), n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(g.m, vec_id) AS component_id, vec_id = coalesce(g.m, vec_id) AS kept FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN g ON g.id = vec_id"""


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "embeddings"))
