"""Near-duplicate documents by MinHash with tensored banding, verified on full shingle sets.

Two collections of ``TABLES`` short bands, each of ``HALF`` minhashes, are computed for every distinct shingle set; the keys of
``TABLES`` squared tables are all pairs of a band of the first collection and one of the second, so 2 x 10 x 2 minhashes fill 100
tables of 4-minhash keys.  A pair meets in a table if a band of either collection agrees: at similarity s it is missed with
chance 2 m - m², where m = (1 - s²)^10; that is 0.00007 at 0.8 and 0.0000001 at 0.9.  What is missed directly, links through
other copies mostly join.  A 128-bit sketch of one bit a minhash leaves out pairs far from the threshold; at similarity
0.8 it loses 2 in a million, and fewer above (``tests`` compute it).

Documents with equal sets are one node.  No group is expanded into all pairs: first each node is compared with a few
leaders of the tables it is in, and linked ones become components; then only members of different components that share a
table are compared, small ones by pairs, large ones in blocks of up to ``BLOCK`` nodes or ``BLOCK_BYTES`` of sets, two of which a
task compares at a time.  Every link is confirmed on whole sets, and components are found by star steps.  Tables, leaders and
sets with very many documents are dealt to several tasks.

Defined results for odd input: a null, empty or blank text has no shingles and links with nothing; a text of fewer words
than a shingle is one shingle of all its words.  Rows that share an id are one node of all their sets; rows equal in id and
text have equal results, so all of them are kept or none.  A null id links with nothing and keeps a null component.  Texts are
read whole; a task holds the sets of two blocks, which a single very long text can exceed by its own set.  An empty table
gives an empty result.  Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import ngrams
from llm.common import hot_keys, materialize, remove, sliced, spread_join, table
from llm.graph import components

TABLES, HALF, SKETCH = 10, 2, 128
#: At similarity 0.8 bits differ with chance 0.1; over this many of 128 is five deviations off.
FAR = 30
LEADERS, LARGE = 5, 48
#: Nodes and bytes of sets of a block, and nodes whose sets are compared by one matrix product.
BLOCK, BLOCK_BYTES, STEP = 2048, 8 << 20, 256
#: Ids up to this number (8 bytes each) are broadcast to the scan of texts, more are joined by shuffle.
BROADCAST_IDS = 1_000_000
_RNG = np.random.Generator(np.random.PCG64(20240229))
_FACTORS = _RNG.integers(0, 2**63, 2 * TABLES * HALF + SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None, width: int = 2) -> np.ndarray:
    """The distinct shingles of ``width`` words of a whole text as sorted 64-bit hashes; A-Z count as lower case."""
    w = ngrams.word_hashes((text or "").encode("utf-8", "replace").lower())
    if not len(w):
        return w
    if len(w) < width:
        h = np.uint64(len(w))
        for x in w:
            h = ngrams.mix(np.array([h]) * np.uint64(0x9E3779B97F4A7C15) + x)[0]
        return np.array([h], dtype=np.uint64)
    h = w[: len(w) - width + 1]
    for k in range(1, width):
        h = ngrams.mix(h * np.uint64(0x9E3779B97F4A7C15) + w[k : len(w) - width + 1 + k])
    return np.unique(h)


def _minhashes(x: np.ndarray) -> np.ndarray:
    out = np.empty(len(_FACTORS), dtype=np.uint64)
    step = max(1, (1 << 18) // len(x))
    for lo in range(0, len(_FACTORS), step):
        y = x[None, :] * _FACTORS[lo : lo + step, None]
        y ^= y >> np.uint64(32)
        out[lo : lo + step] = y.min(1)
    return out


SIGNATURE = "id long, n long, f long, g long, a array<long>, b array<long>, s long, t long"


def _signature(x: np.ndarray) -> tuple:
    """Of a set: its size, two sums that tell it from other sets, the keys of both collections' bands, and the sketch."""
    if not len(x):
        return (0, 0, 0, None, None, 0, 0)
    m = _minhashes(x)
    band = m[: 2 * TABLES * HALF].reshape(2 * TABLES, HALF)
    key = ngrams.mix(band[:, 0] + np.arange(2 * TABLES, dtype=np.uint64))
    for k in range(1, HALF):
        key = ngrams.mix(key * np.uint64(0x9E3779B97F4A7C15) + band[:, k])
    bits = np.packbits((ngrams.mix(m[2 * TABLES * HALF :]) & np.uint64(1)).astype(np.uint8)).view("<i8")
    key = key.view(np.int64)
    return (len(x), x.sum().view(np.int64), ngrams.mix(x).sum().view(np.int64), key[:TABLES], key[TABLES:], bits[0], bits[1])


def _signatures(width: int):
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64()]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, "text", 1024):
            rows = [_signature(shingles(t.as_py(), width)) for t in b.column("text")]
            columns = [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([b.column("id"), *columns], ["id", "n", "f", "g", "a", "b", "s", "t"])

    return of


def _sets(width: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, "text", 64):
            sets = [shingles(t.as_py(), width).tobytes() for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(sets, pa.binary())], ["id", "set"])

    return of


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = _shared(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def _verify(percent: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [_linked(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent) for x, y in zip(b.column("x"), b.column("y"))]
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("p").filter(keep), b.column("q").filter(keep)], ["a", "b"])

    return of


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``p``, ``q``) whose whole sets are as similar as asked, as ``a`` and ``b``; one ``q`` may have very many."""
    pairs = materialize(pairs.select("p", "q"), "pairs")
    hot = materialize(hot_keys(pairs.groupBy("q").agg(F.count("*").alias("c")), ["q"], "c", pairs.count()), "hot")
    x, y = sets.select(F.col("id").alias("p"), F.col("set").alias("x")), sets.select(F.col("id").alias("q"), F.col("set").alias("y"))
    found = spread_join(pairs, y, ["q"], hot).join(x, "p").select("p", "q", "x", "y").mapInArrow(_verify(percent), "a long, b long")
    found = materialize(found, "links")
    remove(pairs, hot)
    return found


def _close(percent: int, far: int) -> Column:
    """Of structs or aliased rows x and y: sizes and sketches allow the similarity."""
    sizes = 100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n")
    return sizes & (F.bit_count(F.col("x.s").bitwiseXOR(F.col("y.s"))) + F.bit_count(F.col("x.t").bitwiseXOR(F.col("y.t"))) <= far)


def _overlaps(rows: list[np.ndarray], columns: list[np.ndarray], cells: int = 1 << 24) -> np.ndarray | None:
    """Sizes of all intersections by one matrix product, or None where the sets are too many and long for that."""
    known = np.unique(np.concatenate(columns))
    if len(known) * (len(rows) + len(columns)) > cells:
        return None
    out = []
    for sets in (rows, columns):
        flags = np.zeros((len(sets), len(known)), dtype=np.float32)
        for row, x in zip(flags, sets):
            at = np.searchsorted(known, x)
            at[at == len(known)] = 0
            row[at[known[at] == x]] = 1
        out.append(flags)
    return out[0] @ out[1].T


def _blocks(percent: int, far: int):
    """Links between two blocks of nodes, a spanning set of them: nodes that links of these blocks already join are skipped."""

    def of(pdf: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int]] = []
        for queries, members in zip(pdf["queries"], pdf["members"]):
            parent: dict[int, int] = {}
            for lo in range(0, len(queries), STEP):
                for at in range(0, len(members), STEP):
                    _compare(queries[lo : lo + STEP], members[at : at + STEP], percent, far, parent, found)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return of


def _compare(queries: list, members: list, percent: int, far: int, parent: dict[int, int], found: list[tuple[int, int]]) -> None:
    """Add the links between some queries and members that join components which ``parent`` has apart."""

    def root(c: int) -> int:
        while (up := parent.get(c, c)) != c:
            c = up
        return c

    ids, comps = [int(m["id"]) for m in members], [m["comp"] for m in members]
    size = np.array([m["n"] for m in members])
    bits = np.array([[m["s"], m["t"]] for m in members], dtype=np.int64)
    sets, own = ([np.frombuffer(m["set"], np.uint64) for m in x] for x in (members, queries))
    both = _overlaps(own, sets)
    for i, q in enumerate(queries):
        apart = np.bitwise_count((bits ^ np.array([q["s"], q["t"]], dtype=np.int64)).view(np.uint64)).sum(1)  # of signed numbers it takes the absolute
        fit = (apart <= far) & (100 * np.minimum(size, q["n"]) >= percent * np.maximum(size, q["n"]))
        if both is not None:
            fit &= 100 * both[i] >= percent * (size + q["n"] - both[i])
        for k in np.flatnonzero(fit):
            if root(comps[k]) != root(q["comp"]) and (both is not None or _linked(own[i], sets[k], percent)):
                parent[root(comps[k])] = root(q["comp"])
                found.append((int(q["id"]), ids[k]))


def _in_blocks(ask: DataFrame, told: DataFrame, sets: DataFrame, percent: int, far: int) -> DataFrame:
    """Links between the nodes of ``ask`` and ``told`` of equal ``g``; where a group's name begins with k both are the same.

    A group's nodes are dealt to its blocks, and each block is sent to the pairs of blocks that it is in: no task gets more of
    a group than two blocks."""
    used = []

    def blocks(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        rows = materialize(df, name)
        sizes = rows.groupBy("g").agg(F.count("*").alias("c"), F.sum("n").alias("n"))
        hot = materialize(hot_keys(sizes, ["g"], "c", rows.count()), f"{name}-hot")
        count = sizes.select("g", F.greatest(F.ceil(F.col("c") / BLOCK), F.ceil(F.col("n") * 8 / BLOCK_BYTES)).alias("k"))
        cut = spread_join(rows, count, ["g"], hot).withColumn("k", F.pmod(F.xxhash64("id"), F.col("k"))).join(sets, "id")
        listed = F.collect_list(F.struct("id", "comp", "n", "s", "t", "set"))  # bounded by a block
        used.extend((rows, hot))
        return cut.groupBy("g", "k").agg(listed.alias(name)).select("g", F.col("k").alias(name[0]), name), count

    (queries, many), (members, some) = blocks(ask, "queries"), blocks(told, "members")
    twice = F.col("g").like("k%")
    count = many.withColumnRenamed("k", "ks").join(some.withColumnRenamed("k", "ms"), "g")
    left = queries.join(count, "g").select("g", "q", F.explode(F.sequence(F.when(twice, F.col("q")).otherwise(0), F.col("ms") - 1)).alias("m"), "queries")
    right = members.join(count, "g").select("g", F.explode(F.sequence(F.lit(0), F.when(twice, F.col("m")).otherwise(F.col("ks") - 1))).alias("q"), "m", "members")
    compared = left.join(right, ["g", "q", "m"])
    links = materialize(compared.groupBy("g", "q", "m").applyInPandas(_blocks(percent, far), "a long, b long"), "links")
    remove(*used)
    return links


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of each row of ``docs`` (``doc_id``, ``text``)."""
    far = FAR if percent >= 80 else SKETCH
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    base = materialize(rows.mapInArrow(_signatures(width), SIGNATURE), "signatures")
    of = ["n", "f", "g"]
    reps = base.where("n > 0 and id is not null").groupBy(*of).agg(F.min("id").alias("rep"), F.count("*").alias("many"))
    reps = materialize(reps, "sets")
    once = base.where("n > 0").dropDuplicates(["id", *of])
    nodes = materialize(once.join(reps.select(F.col("rep").alias("id"), *of), ["id", *of], "left_semi"), "nodes")

    # Tables: only keys that several nodes share go on.
    key = nodes.select("id", "n", "s", "t", F.posexplode("a").alias("i", "x"), "b")
    key = key.select("id", "n", "s", "t", "i", "x", F.posexplode("b").alias("j", "y"))
    key = key.select(F.xxhash64("i", "j", "x", "y").alias("key"), "id", "n", "s", "t")
    several = key.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("c"))
    several = materialize(several.where("lo <> hi").select("key", "c"), "keys")
    hot = materialize(hot_keys(several, ["key"], "c", several.agg(F.sum("c")).first()[0] or 0), "hot")
    shared = materialize(spread_join(key, several.select("key"), ["key"], hot), "shared")

    wanted = shared.select("id").distinct()
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    sets = rows.join(wanted, "id").mapInArrow(_sets(width), "id long, set binary")
    repeated = not base.where("n > 0").groupBy("id").count().where("count > 1").isEmpty()
    sets = materialize(sets.distinct() if repeated else sets, "sets")

    # Each node with the first of a few orders among all that share a table with it and may be similar.
    order = [F.struct(F.xxhash64(F.lit(r), "id").alias("h"), "id", "n", "s", "t") for r in range(LEADERS)]
    lead = shared.groupBy("key").agg(F.array(*[F.min(o) for o in order]).alias("l"))
    met = spread_join(shared.withColumnRenamed("id", "p"), lead, ["key"], hot).select("p", "n", "s", "t", F.posexplode("l").alias("r", "y"))
    met = met.select("p", "r", F.struct("n", "s", "t").alias("x"), "y").where((F.col("p") != F.col("y.id")) & _close(percent, far))
    best = met.groupBy("p", "r").agg(F.min(F.struct("y.h", F.col("y.id").alias("q"))).alias("m"))
    links = _verified(best.select("p", F.col("m.q").alias("q")).distinct(), sets, percent)

    # What is left: nodes of different components that share a table.
    group = components(links)
    labels = materialize(wanted.join(group, "id", "left").select("id", F.coalesce("component", "id").alias("comp")), "labels")
    large = labels.groupBy("comp").count().where(F.col("count") > LARGE).select("comp", F.lit(True).alias("large"))
    label = labels.join(large, "comp", "left").select("id", "comp", F.coalesce("large", F.lit(False)).alias("large"))
    here = materialize(shared.join(label, "id"), "labelled")
    # Tables that have the same large components are one hand: a node with a hundred such tables asks these components once.
    per = here.groupBy("key", "comp", "large").agg(F.count("*").alias("c"))
    hand = F.bit_xor(F.when(F.col("large"), F.xxhash64("comp"))).alias("hand")
    mixed = per.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.coalesce(F.sum(F.when(~F.col("large"), F.col("c"))), F.lit(0)).alias("small"), hand)
    mixed = mixed.where("lo <> hi").select("key", "small", "hand")
    labelled, here = here, materialize(spread_join(here, mixed, ["key"], hot), "mixed")
    few = here.where(~F.col("large") & (F.col("small") <= LARGE))
    near = (F.col("x.id") < F.col("y.id")) & (F.col("x.comp") != F.col("y.comp")) & _close(percent, far)
    pairs = few.alias("x").join(few.alias("y"), F.col("x.key") == F.col("y.key")).where(near)
    second = _verified(pairs.select(F.col("x.id").alias("p"), F.col("y.id").alias("q")).distinct(), sets, percent)

    # Large components, and tables of many small ones, in blocks.  Such tables that have nodes in common are one group.
    links = links.union(second)
    node, more = ["id", "comp", "n", "s", "t"], []
    if not here.where(F.col("large") | (F.col("small") > LARGE)).isEmpty():
        dealt = materialize(here.where("hand is not null").select("hand", *node).distinct(), "hands")
        asked = here.where("large").select("hand", F.col("comp").alias("of")).distinct()
        held = materialize(hot_keys(dealt.groupBy("hand").agg(F.count("*").alias("c")), ["hand"], "c", dealt.count()), "held")
        ask = spread_join(dealt, asked, ["hand"], held).where("comp <> of").select(F.concat(F.lit("c"), "of").alias("g"), *node).distinct()
        told = shared.select("id", "n", "s", "t").distinct().join(label.where("large"), "id").select(F.concat(F.lit("c"), "comp").alias("g"), *node)
        crowded = here.where(~F.col("large") & (F.col("small") > LARGE))
        hub = crowded.groupBy("key").agg(F.min("id").alias("b"))
        crowd = components(spread_join(crowded.select("key", F.col("id").alias("a")), hub, ["key"], hot).select("a", "b"))
        many = crowded.select(*node).distinct().join(crowd, "id", "left").select(F.concat(F.lit("k"), F.coalesce("component", "id")).alias("g"), *node)
        queries, members = ask.union(many), told.join(ask.select("g").distinct(), "g", "left_semi").select("g", *node).union(many)
        links = links.union(_in_blocks(queries, members, sets, percent, far))
        more = [dealt, held]
    group = components(links)
    known = reps.join(group, F.col("rep") == F.col("id"), "left").select(*of, "many", F.coalesce("component", "rep").alias("component"))
    known = materialize(known, "known")
    remove(sets, here, labelled, shared, several, hot, nodes, labels, reps, group, *more)
    # The exact copies of a common text are many rows of one key.
    often = hot_keys(known, of, "many", base.count())
    own = base.withColumns({c: F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col(c)) for c in ("f", "g")})
    out = spread_join(own.select("id", *of), known.select(*of, "component"), of, often, "left")
    top = F.coalesce("component", "id")
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), top.alias("component_id"), F.coalesce(F.col("id") == top, F.lit(True)).alias("kept"))


#: The same rows in DuckDB SQL: a prefix-filtered join on rare shingles, verified, then transitive closure.
ORACLE_SQL = r"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
 s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]] ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM d),
 u AS (SELECT min(doc_id) AS id, list_sort(s) AS s, len(s) AS n FROM s WHERE len(s) > 0 GROUP BY 2, 3),
 x AS (SELECT id, n, unnest(s) AS g FROM u), f AS (SELECT g, count(*) AS c FROM x GROUP BY g),
 r AS (SELECT id, n, g, row_number() OVER (PARTITION BY id ORDER BY c, g) AS k FROM x JOIN f USING (g)),
 p AS (SELECT id, n, g FROM r WHERE k <= n - (4 * n + 4) // 5 + 1),
 c AS (SELECT DISTINCT a.id AS a, b.id AS b FROM p a JOIN p b ON a.g = b.g AND a.id < b.id AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)),
 e AS (SELECT a, b FROM c JOIN u x ON x.id = a JOIN u y ON y.id = b WHERE 100 * len(list_intersect(x.s, y.s)) >= 80 * (x.n + y.n - len(list_intersect(x.s, y.s)))),
 both_ AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
 t(id, m) AS (SELECT a, a FROM both_ UNION SELECT both_.b, t.m FROM t JOIN both_ ON both_.a = t.id WHERE t.m < both_.b),
 g AS (SELECT id, min(m) AS m FROM t GROUP BY id)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(g.m, u.id, s.doc_id) AS component_id, s.doc_id = coalesce(g.m, u.id, s.doc_id) AS kept
FROM s LEFT JOIN u ON u.s = list_sort(s.s) LEFT JOIN g ON g.id = u.id"""


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=2)
