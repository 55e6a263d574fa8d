"""Queries over the driver's tables, one for each operator family, each beside its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from cairn.functions import boxes as B
from cairn.operators import balance
from cairn.operators import boxes as O
from cairn.operators import similarity as S
from cairn.plans.tables import BOXES, CLASSES, DETECTIONS, DROP, HASHES, LOOSE, MAPPING, SPLITS, STRICT, boxes, detections, hashes, read

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def of(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return of


c = F.col


def xywh() -> tuple:
    return c("x"), c("y"), c("w"), c("h")


REMAP = "CASE cls WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 0 WHEN 3 THEN 2 WHEN 4 THEN 1 END"

# --- label text ------------------------------------------------------------------------------------------------------

LINES = """lines AS (SELECT l_orderkey AS image, l_linestatus AS split, CASE l_orderkey % 9
  WHEN 0 THEN l_linenumber::VARCHAR || ' 0.5 0.25' WHEN 1 THEN 'a 0.5 0.5 0.25 0.25' WHEN 2 THEN '1 1.0f 0.5 0.25 0.25' WHEN 3 THEN '-1.7 0.5 0.5 0.25 0.25'
  WHEN 4 THEN '   ' WHEN 5 THEN '  ' || l_linenumber::VARCHAR || '   0.5 0.25 1e-1 .5 extra' ELSE l_linenumber::VARCHAR || ' 0.5 0.75 0.125 0.0625' END AS line FROM lineitem)"""


def _lines(spark: SparkSession, d: str) -> DataFrame:
    n, k = c("l_linenumber").cast("string"), c("l_orderkey") % 9
    line = (
        F.when(k == 0, F.concat(n, F.lit(" 0.5 0.25"))).when(k == 1, "a 0.5 0.5 0.25 0.25").when(k == 2, "1 1.0f 0.5 0.25 0.25").when(k == 3, "-1.7 0.5 0.5 0.25 0.25")
        .when(k == 4, "   ").when(k == 5, F.concat(F.lit("  "), n, F.lit("   0.5 0.25 1e-1 .5 extra"))).otherwise(F.concat(n, F.lit(" 0.5 0.75 0.125 0.0625")))
    )
    return read(spark, d, "lineitem").select(c("l_orderkey").alias("image"), c("l_linestatus").alias("split"), line.alias("line"))


PARSED = LINES + """, toks AS (SELECT image, split, string_split_regex(trim(line), '\\s+') AS t FROM lines WHERE trim(line) <> ''),
 nums AS (SELECT image, split, len(t) AS n, CASE WHEN regexp_full_match(t[1], '[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN trunc(try_cast(t[1] AS DOUBLE))::INT END AS cls,
  list_transform(t[2:5], lambda s: CASE WHEN regexp_full_match(s, '[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN try_cast(s AS DOUBLE) END) AS v FROM toks),
 parsed AS (SELECT image, split, CASE WHEN n < 5 THEN 'too_few_columns' WHEN cls IS NULL OR len(list_filter(v, lambda s: s IS NULL)) > 0 THEN 'parse_error' END AS error, cls, v FROM nums)"""


@query(f"WITH {PARSED} SELECT split, cls, count(*)::BIGINT AS boxes, round(sum(v[1] + v[2] + v[3] + v[4]), 6) AS total FROM parsed WHERE error IS NULL GROUP BY ALL")
def parse_label_text(spark, d):
    b = _lines(spark, d).select("split", B.parse_line(c("line")).alias("b")).where("b is not null and b.error is null").select("split", "b.*")
    return b.groupBy("split", "cls").agg(F.count("*").alias("boxes"), F.round(F.sum(c("x") + c("y") + c("w") + c("h")), 6).alias("total"))


@query(f"WITH {PARSED} SELECT split, error, count(*)::BIGINT AS lines, count(DISTINCT image)::BIGINT AS files FROM parsed WHERE error IS NOT NULL GROUP BY ALL")
def parse_error_counts(spark, d):
    b = _lines(spark, d).select("image", "split", B.parse_line(c("line")).alias("b")).where("b.error is not null")
    return b.groupBy("split", c("b.error").alias("error")).agg(F.count("*").alias("lines"), F.countDistinct("image").alias("files"))


@query(f"""WITH {LINES}, f AS (SELECT split, image, trunc(try_cast(string_split_regex(trim(line), '\\s+')[1] AS DOUBLE))::INT AS cls FROM lines WHERE trim(line) <> '')
SELECT split, cls, count(*)::BIGINT AS lines, count(DISTINCT image)::BIGINT AS files FROM f WHERE cls IS NOT NULL GROUP BY ALL""")
def class_only_scan(spark, d):
    f = _lines(spark, d).select("split", "image", B.number(F.get(B.tokens(c("line")), 0)).try_cast("int").alias("cls")).where("cls is not null")
    return f.groupBy("split", "cls").agg(F.count("*").alias("lines"), F.countDistinct("image").alias("files"))


# --- validity and rejects --------------------------------------------------------------------------------------------


@query(f"WITH {BOXES} SELECT split, cls, count(*)::BIGINT AS boxes, round(sum(w * h), 6) AS area FROM boxes WHERE {STRICT} GROUP BY ALL")
def strict_valid(spark, d):
    return boxes(spark, d).where(B.strict_valid(*xywh())).groupBy("split", "cls").agg(F.count("*").alias("boxes"), F.round(F.sum(B.area(c("w"), c("h"))), 6).alias("area"))


@query(f"WITH {BOXES} SELECT split, cls, count(*)::BIGINT AS boxes, round(max(CASE WHEN h <= 0 THEN 'inf'::DOUBLE ELSE w / h END), 6) AS widest FROM boxes WHERE {LOOSE} GROUP BY ALL")
def loose_valid(spark, d):
    return boxes(spark, d).where(B.loose_valid(*xywh())).groupBy("split", "cls").agg(F.count("*").alias("boxes"), F.round(F.max(B.aspect_ratio(c("w"), c("h"))), 6).alias("widest"))


@query(f"WITH {BOXES} SELECT source, count_if({LOOSE} AND NOT {STRICT})::BIGINT AS loose_only, count_if({STRICT})::BIGINT AS both, count_if(NOT {LOOSE})::BIGINT AS neither FROM boxes GROUP BY source")
def validity_gap(spark, d):
    s, l = B.strict_valid(*xywh()), B.loose_valid(*xywh())
    return boxes(spark, d).groupBy("source").agg(F.count_if(l & ~s).alias("loose_only"), F.count_if(s).alias("both"), F.count_if(~l).alias("neither"))


CATEGORY = f"CASE WHEN {STRICT} THEN NULL WHEN w <= 0 OR h <= 0 THEN 'zero_area' WHEN x < 0 OR y < 0 THEN 'negative_coordinates' ELSE 'out_of_bounds' END"


@query(f"WITH {BOXES} SELECT cls, {CATEGORY} AS category, count(*)::BIGINT AS boxes FROM boxes WHERE NOT {STRICT} GROUP BY ALL")
def reject_category(spark, d):
    return boxes(spark, d).select("cls", B.reject_category(*xywh()).alias("category")).where("category is not null").groupBy("cls", "category").agg(F.count("*").alias("boxes"))


@query(f"""WITH {BOXES}, t AS (SELECT unnest(list_filter([CASE WHEN w > 1 OR h > 1 THEN 'width_or_height_exceeds_1' END, CASE WHEN x - w / 2 < -1e-6 THEN 'extends_past_left' END,
 CASE WHEN y - h / 2 < -1e-6 THEN 'extends_past_top' END, CASE WHEN x + w / 2 > 1 + 1e-6 THEN 'extends_past_right' END, CASE WHEN y + h / 2 > 1 + 1e-6 THEN 'extends_past_bottom' END], lambda s: s IS NOT NULL)) AS tag
 FROM boxes WHERE NOT {STRICT}) SELECT tag, count(*)::BIGINT AS boxes FROM t GROUP BY tag""")
def reject_subtags(spark, d):
    return boxes(spark, d).where(~B.strict_valid(*xywh())).select(F.explode(B.subtags(*xywh())).alias("tag")).groupBy("tag").agg(F.count("*").alias("boxes"))


@query(f"""WITH {BOXES} SELECT source, round(max(greatest(0, w / 2 - x)), 9) AS "left", round(max(greatest(0, x + w / 2 - 1)), 9) AS "right", round(max(greatest(0, h / 2 - y)), 9) AS top,
 round(max(greatest(0, y + h / 2 - 1)), 9) AS bottom FROM boxes GROUP BY source""")
def overflow(spark, d):
    return boxes(spark, d).select("source", B.overflow(*xywh()).alias("o")).groupBy("source").agg(*[F.round(F.max(f"o.{k}"), 9).alias(k) for k in ("left", "right", "top", "bottom")])


@query(f"""WITH {BOXES}, f AS (SELECT image, count_if({STRICT}) AS good, count_if(NOT {STRICT}) AS bad FROM boxes GROUP BY image)
SELECT CASE WHEN bad = 0 THEN 'valid' WHEN good = 0 THEN 'invalid' ELSE 'mixed' END AS mix, count(*)::BIGINT AS files, sum(bad)::BIGINT AS bad FROM f GROUP BY 1""")
def file_valid_mix(spark, d):
    return O.file_mix(boxes(spark, d)).groupBy("mix").agg(F.count("*").alias("files"), F.sum("bad").alias("bad"))


# --- remapping, counters, distributions --------------------------------------------------------------------------------


@query(f"WITH {BOXES} SELECT source, {REMAP} AS cls, count(*)::BIGINT AS boxes FROM boxes WHERE cls <> 5 AND {REMAP} IS NOT NULL AND {STRICT} GROUP BY ALL")
def remap_drop(spark, d):
    return O.remap(boxes(spark, d), MAPPING, DROP).where(B.strict_valid(*xywh())).groupBy("source", "cls").agg(F.count("*").alias("boxes"))


@query(f"""WITH {BOXES}, f AS (SELECT source, image, count(*) AS raw, count_if(cls <> 5 AND {REMAP} IS NOT NULL AND {STRICT}) AS kept, count_if(cls = 5) AS dropped FROM boxes GROUP BY ALL)
SELECT source, count(*)::BIGINT AS images, sum(raw)::BIGINT AS raw_boxes, sum(kept)::BIGINT AS kept_boxes, sum(dropped)::BIGINT AS dropped_boxes, sum(raw - kept - dropped)::BIGINT AS invalid_boxes,
 count_if(kept = 0)::BIGINT AS images_without_box FROM f GROUP BY source""")
def clean_counters(spark, d):
    return O.clean_counters(boxes(spark, d), MAPPING, DROP)


@query(f"WITH {BOXES} SELECT split, cls, count(*)::BIGINT AS instances, count(DISTINCT image)::BIGINT AS images FROM boxes GROUP BY GROUPING SETS ((split, cls), (cls))")
def class_distribution_rollup(spark, d):
    return O.distribution(boxes(spark, d))


@query(f"""WITH {BOXES}, b AS (SELECT split, {REMAP} AS cls, image FROM boxes WHERE cls <> 5 AND {STRICT}), n AS (SELECT split, cls, count(*) AS instances, count(DISTINCT image) AS images FROM b GROUP BY ALL)
SELECT g.split, g.cls, coalesce(instances, 0)::BIGINT AS instances, coalesce(images, 0)::BIGINT AS images FROM (SELECT * FROM (VALUES ('F'), ('O')) s(split), (VALUES (0), (1), (2)) k(cls)) g LEFT JOIN n USING (split, cls)""")
def dense_split_grid(spark, d):
    kept = O.remap(boxes(spark, d).where(B.strict_valid(*xywh())), MAPPING, DROP)
    counts = kept.groupBy("split", "cls").agg(F.count("*").alias("instances"), F.countDistinct("image").alias("images"))
    return O.dense_grid(counts, SPLITS, CLASSES, ["instances", "images"])


@query(f"""WITH {BOXES} SELECT source, count_if({REMAP} = 0)::BIGINT AS class_0, count_if({REMAP} = 1)::BIGINT AS class_1, count_if({REMAP} = 2)::BIGINT AS class_2, count(*)::BIGINT AS total
FROM boxes WHERE cls <> 5 AND {REMAP} IS NOT NULL GROUP BY source""")
def source_pivot(spark, d):
    p = O.remap(boxes(spark, d), MAPPING, DROP).groupBy("source").pivot("cls", CLASSES).count()
    n = [F.coalesce(c(str(k)), F.lit(0)).alias(f"class_{k}") for k in CLASSES]
    return p.select("source", *n).withColumn("total", c("class_0") + c("class_1") + c("class_2"))


@query(f"""WITH {BOXES} SELECT split, count(DISTINCT image)::BIGINT AS images, count(*)::BIGINT AS boxes, count_if(cls - 1 < 0)::BIGINT AS negative_classes, count_if(cls - 1 >= 0 AND NOT {LOOSE})::BIGINT AS loose_invalid,
 count_if(NOT {STRICT})::BIGINT AS strict_invalid FROM boxes GROUP BY split""")
def label_health(spark, d):
    return O.health(boxes(spark, d).withColumn("cls", c("cls") - 1))


@query(f"""WITH {BOXES} SELECT source, {', '.join(f'round(quantile_cont(w * h, {p / 100}), 9) AS p{p}' for p in (1, 5, 10, 25, 50, 75, 90, 95, 99))} FROM boxes WHERE {LOOSE} GROUP BY source""")
def bbox_percentiles(spark, d):
    return O.percentiles(boxes(spark, d).where(B.loose_valid(*xywh())), c("w") * c("h"), ["source"], [1, 5, 10, 25, 50, 75, 90, 95, 99])


@query(f"WITH {BOXES} SELECT source, array_to_string(list_sort(list(DISTINCT cls)), ',') AS classes, count(DISTINCT cls)::BIGINT AS n FROM boxes GROUP BY source")
def observed_classes(spark, d):
    s = boxes(spark, d).groupBy("source").agg(F.array_sort(F.collect_set("cls")).alias("s"))
    return s.select("source", F.array_join(c("s").cast("array<string>"), ",").alias("classes"), F.size("s").cast("long").alias("n"))


@query(f"""WITH {BOXES}, p AS (SELECT image, cls, count(*) AS n, min(ord) AS f FROM boxes GROUP BY ALL), r AS (SELECT image, cls, row_number() OVER (PARTITION BY image ORDER BY n DESC, f) AS k FROM p)
SELECT image, cls FROM r WHERE k = 1""")
def dominant_class(spark, d):
    return O.dominant_class(boxes(spark, d), c("ord"))


@query(f"""WITH {BOXES}, m AS (SELECT image, count(*) AS n, bit_or(CASE WHEN cls BETWEEN 2 AND 5 THEN 1 << (cls - 2)::INT ELSE 0 END)::INT AS mask FROM boxes GROUP BY image)
SELECT image, mask, (n + 2.0 * bit_count(mask))::DOUBLE AS score FROM m""")
def type_mask_score(spark, d):
    bit = F.when(c("cls").between(2, 5), F.pow(F.lit(2), c("cls") - 2).cast("int")).otherwise(0)
    m = boxes(spark, d).groupBy("image").agg(F.count("*").alias("n"), F.bit_or(bit).alias("mask"))
    return m.select("image", "mask", (c("n") + 2.0 * F.bit_count("mask")).cast("double").alias("score"))


# --- duplicates and leakage --------------------------------------------------------------------------------------------

SPLIT_OF = "CASE WHEN doc_id % 10 < 7 THEN 'train' WHEN doc_id % 10 < 9 THEN 'val' ELSE 'test' END"


def _documents(spark: SparkSession, d: str) -> DataFrame:
    split = F.when(c("doc_id") % 10 < 7, "train").when(c("doc_id") % 10 < 9, "val").otherwise("test")
    return read(spark, d, "documents").select(c("doc_id").alias("id"), F.sha1(c("text").cast("binary")).alias("sha"), split.alias("split"))


@query("SELECT sha1(text) AS digest, count(*)::BIGINT AS members, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(*) > 1")
def exact_dup_groups(spark, d):
    return S.duplicate_groups(_documents(spark, d), c("sha"))


@query("SELECT sha1(text) AS digest, count(*)::BIGINT AS members, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(*) > 1 ORDER BY 2 DESC, 3 LIMIT 5")
def largest_dup_groups(spark, d):
    return S.duplicate_groups(_documents(spark, d), c("sha")).orderBy(F.desc("members"), "first_id").limit(5)


@query(f"SELECT sha1(text) AS digest, count(*)::BIGINT AS members, min(doc_id) AS first_id, count(DISTINCT {SPLIT_OF})::BIGINT AS splits FROM documents GROUP BY 1 HAVING count(*) > 1 AND count(DISTINCT {SPLIT_OF}) > 1")
def exact_cross_split(spark, d):
    return S.duplicate_groups(_documents(spark, d), c("sha"), "split").where("splits > 1")


BITS = 20
PAIRS = f"""{HASHES}, pairs AS (SELECT a.id AS a, b.id AS b, (bit_count(xor(a.hi, b.hi)) + bit_count(xor(a.lo, b.lo)))::INT AS distance FROM hashes a JOIN hashes b ON a.id < b.id
 WHERE bit_count(xor(a.hi, b.hi)) + bit_count(xor(a.lo, b.lo)) <= {BITS})"""
#: Sequential leader clustering: items in order, with the list of leaders so far.
LEADERS = f"""{PAIRS}, near AS (SELECT b AS id, list(a) AS earlier FROM pairs GROUP BY b), seq AS (SELECT h.id, row_number() OVER (ORDER BY h.id) AS k, coalesce(earlier, []) AS earlier FROM hashes h LEFT JOIN near USING (id)),
 walk(k, lead, id, leader) AS (SELECT 0::BIGINT, []::BIGINT[], NULL::BIGINT, NULL::BIGINT UNION ALL
  SELECT s.k, CASE WHEN len(list_intersect(s.earlier, w.lead)) = 0 THEN list_append(w.lead, s.id) ELSE w.lead END, s.id,
   CASE WHEN len(list_intersect(s.earlier, w.lead)) = 0 THEN s.id ELSE list_min(list_intersect(s.earlier, w.lead)) END FROM walk w JOIN seq s ON s.k = w.k + 1),
 clusters AS (SELECT id, leader FROM walk WHERE k > 0)"""


def _clusters(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    h = hashes(spark, d)
    return h, S.clusters(h, BITS)


@query(f"WITH {PAIRS} SELECT a, b, distance FROM pairs")
def hamming_pairs(spark, d):
    return S.hamming_pairs(hashes(spark, d), BITS).select("a", "b", c("distance").cast("int").alias("distance"))


@query(f"WITH RECURSIVE {LEADERS} SELECT id, leader FROM clusters")
def leader_clusters(spark, d):
    return _clusters(spark, d)[1]


@query(f"""WITH RECURSIVE {LEADERS}, r AS (SELECT leader, id, count(*) OVER (PARTITION BY leader) AS members, row_number() OVER (PARTITION BY leader ORDER BY label DESC, id) AS k FROM clusters JOIN hashes USING (id))
SELECT leader, id AS keep, members::BIGINT AS members FROM r WHERE k = 1""")
def dedup_best(spark, d):
    h, k = _clusters(spark, d)
    return S.representatives(h, k, c("label"))


@query(f"WITH RECURSIVE {LEADERS} SELECT leader, count(*)::BIGINT AS members, count(DISTINCT split)::BIGINT AS splits FROM clusters JOIN hashes USING (id) GROUP BY leader HAVING count(DISTINCT split) > 1")
def near_cross_split(spark, d):
    return S.cross_split(*_clusters(spark, d))


# --- splits and subsets ------------------------------------------------------------------------------------------------

#: Ranked by hash within a class; cut at 70 and 90 percent, rounded half to even.
SPLITTED = """ranked AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id) AS k, count(*) OVER (PARTITION BY lang) AS n FROM documents),
 cut AS (SELECT *, round_even(n * 0.7, 0) AS a, round_even(n * 0.2, 0) AS b FROM ranked), splitted AS (SELECT doc_id, lang, CASE WHEN k <= a THEN 'train' WHEN k <= a + b THEN 'val' ELSE 'test' END AS split FROM cut)"""


def _ranked(df: DataFrame, group: list[str], order: list, buckets: int = 512) -> DataFrame:
    """``df`` with ``k``, the rank in each group by hash ``order[0]`` (a hex digest), and ``n``, the group's size.

    A group's rows are dealt to ranges of the digest, ranked there, and shifted by what the ranges before hold, so that
    no group has to fit one task."""
    part = F.conv(F.substring(order[0], 1, 4), 16, 10).cast("int") % 65536
    cut = df.withColumn("_d", order[0]).withColumn("_b", F.floor(part * buckets / 65536).cast("int"))
    sizes = cut.groupBy(*group, "_b").agg(F.count("*").alias("_c"))
    w = W.partitionBy(*group)
    sizes = sizes.select(*[c(g).alias(f"_{g}") for g in group], c("_b").alias("_bb"), (F.sum("_c").over(w.orderBy("_b")) - c("_c")).alias("_before"), F.sum("_c").over(w).alias("n"))
    ranked = cut.withColumn("_r", F.row_number().over(W.partitionBy(*group, "_b").orderBy("_d", *order[1:])))
    on = [c(g).eqNullSafe(c(f"_{g}")) for g in group]
    cond = c("_b") == c("_bb")
    for o in on:
        cond = cond & o
    return ranked.join(sizes, cond).withColumn("k", c("_r") + c("_before")).drop("_d", "_b", "_bb", "_r", "_before", *[f"_{g}" for g in group])


def stratified(docs: DataFrame, group: str, seed: int = 42, train: float = 0.7, val: float = 0.2) -> DataFrame:
    """Each row's split: groups are cut in hash order at rounded shares, the remainder is for testing."""
    r = _ranked(docs, [group], [F.md5(F.concat(F.lit(f"{seed}:"), c("doc_id").cast("string"))), c("doc_id")])
    a, b = F.bround(c("n") * train), F.bround(c("n") * val)
    return r.withColumn("split", F.when(c("k") <= a, "train").when(c("k") <= a + b, "val").otherwise("test")).drop("k", "n")


@query(f"WITH {SPLITTED} SELECT doc_id, lang, split FROM splitted")
def stratified_split(spark, d):
    return stratified(read(spark, d, "documents").select("doc_id", "lang"), "lang")


@query(f"WITH {SPLITTED} SELECT lang, split, count(*)::BIGINT AS rows FROM splitted GROUP BY ALL")
def split_counts(spark, d):
    return stratified_split(spark, d).groupBy("lang", "split").agg(F.count("*").alias("rows"))


MOST = 2000
CASE_A = f"""d AS (SELECT lang, doc_id, n_chars // 100 AS density FROM documents), t AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY density, doc_id) AS k FROM d), picked AS (SELECT * FROM t WHERE k <= 200),
 w AS (SELECT *, sum(density) OVER (PARTITION BY lang) AS total, count(*) OVER (PARTITION BY lang) AS n, row_number() OVER p AS r, coalesce(sum(density) OVER (p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM picked WINDOW p AS (PARTITION BY lang ORDER BY density DESC, k))"""


@query(f"WITH {CASE_A} SELECT lang, doc_id, density::BIGINT AS density FROM w WHERE NOT (total - before > {MOST} AND r <= n - 1)")
def band_subset_case_a(spark, d):
    """The 200 least dense documents of a language, less the densest of them while their sum is over the limit."""
    docs = read(spark, d, "documents").select("lang", "doc_id", F.expr("n_chars div 100").alias("density"))
    lang = W.partitionBy("lang")
    picked = docs.withColumn("k", F.row_number().over(lang.orderBy("density", "doc_id"))).where("k <= 200")
    dense = lang.orderBy(F.desc("density"), "k")
    w = picked.select("*", F.sum("density").over(lang).alias("total"), F.count("*").over(lang).alias("n"), F.row_number().over(dense).alias("r"), F.coalesce(F.sum("density").over(dense.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return w.where(~((c("total") - c("before") > MOST) & (c("r") <= c("n") - 1))).select("lang", "doc_id", "density")


@query("""WITH RECURSIVE d AS (SELECT lang, doc_id, n_chars // 100 AS density FROM documents), t AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY density, doc_id) AS k FROM d),
 arr AS (SELECT lang, list(density ORDER BY k) FILTER (WHERE k <= 50) AS sel, coalesce(list(density ORDER BY k) FILTER (WHERE k > 50), []) AS rest FROM t GROUP BY lang),
 st(lang, i, j, total) AS (SELECT lang, 0::BIGINT, len(rest)::BIGINT, list_sum(sel)::BIGINT FROM arr UNION ALL
  SELECT s.lang, CASE WHEN s.total - sel[i + 1] + rest[j] <= 1600 THEN i + 1 ELSE i END, j - 1, CASE WHEN s.total - sel[i + 1] + rest[j] <= 1600 THEN s.total - sel[i + 1] + rest[j] ELSE s.total END
  FROM st s JOIN arr a ON a.lang IS NOT DISTINCT FROM s.lang WHERE s.total < 1500 AND i < len(sel) AND j >= 1 AND rest[j] > sel[i + 1])
SELECT st.lang, arg_min(st.total, j)::BIGINT AS total, any_value(len(sel))::BIGINT AS kept FROM st JOIN arr ON arr.lang IS NOT DISTINCT FROM st.lang GROUP BY st.lang""")
def band_subset_full(spark, d):
    """50 documents of each language whose densities sum to 1,500 to 1,600, by swapping picks for denser documents."""
    docs = read(spark, d, "documents").select("lang", c("doc_id").alias("id"), F.expr("n_chars div 100").alias("density"), c("doc_id").alias("ord"))
    return balance.band_subset(docs, "lang", 50, 1500, 1600).groupBy("lang").agg(F.sum("density").alias("total"), F.count("*").alias("kept"))


# --- names, joins ------------------------------------------------------------------------------------------------------


@query("""SELECT doc_id, coalesce(source, 'x') || '_' || coalesce(lang, 'x') || '_' || printf('%06d', row_number() OVER (PARTITION BY source ORDER BY md5(doc_id::VARCHAR), doc_id) - 1) AS stem FROM documents""")
def stage_names(spark, d):
    r = _ranked(read(spark, d, "documents").select("doc_id", "lang", "source"), ["source"], [F.md5(c("doc_id").cast("string")), c("doc_id")])
    return r.select("doc_id", F.format_string("%s_%s_%06d", F.coalesce("source", F.lit("x")), F.coalesce("lang", F.lit("x")), c("k") - 1).alias("stem"))


@query("""WITH taken AS (SELECT DISTINCT o_custkey AS stem, o_orderkey % 8 AS n FROM orders), free AS (SELECT c_custkey AS stem, unnest(range(0, 9)) AS n FROM customer)
SELECT stem, min(n)::BIGINT AS suffix FROM free ANTI JOIN taken USING (stem, n) GROUP BY stem""")
def free_suffix(spark, d):
    """The smallest number not yet taken by a stem; at most as many numbers are tried as can be taken, and one more."""
    taken = read(spark, d, "orders").select(c("o_custkey").alias("stem"), (c("o_orderkey") % 8).alias("n")).distinct()
    free = read(spark, d, "customer").select(c("c_custkey").alias("stem"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(8).cast("long"))).alias("n"))
    return free.join(taken, ["stem", "n"], "left_anti").groupBy("stem").agg(F.min("n").alias("suffix"))


@query("""WITH r AS (SELECT p_partkey, s_suppkey, row_number() OVER (PARTITION BY p_partkey ORDER BY s_acctbal DESC, s_suppkey) AS k FROM part JOIN supplier ON p_size % 25 = s_nationkey) SELECT p_partkey, s_suppkey FROM r WHERE k = 1""")
def first_match_join(spark, d):
    """One match by priority for each row: the partner with the best rank, found by aggregation instead of a sort."""
    s = read(spark, d, "supplier").groupBy("s_nationkey").agg(F.min_by("s_suppkey", F.struct(-c("s_acctbal"), c("s_suppkey"))).alias("s_suppkey"))
    return read(spark, d, "part").join(s, c("p_size") % 25 == c("s_nationkey")).select("p_partkey", "s_suppkey")


@query("SELECT source, count(*)::BIGINT AS images, count_if(q IS NULL)::BIGINT AS missing FROM documents LEFT JOIN (SELECT DISTINCT doc_id, 1 AS q FROM labels) USING (doc_id) GROUP BY source")
def unmatched_left(spark, d):
    labels = read(spark, d, "labels").select("doc_id", F.lit(1).alias("q")).distinct()
    return read(spark, d, "documents").select("doc_id", "source").join(labels, "doc_id", "left").groupBy("source").agg(F.count("*").alias("images"), F.count_if(c("q").isNull()).alias("missing"))


@query("SELECT doc_id FROM documents ANTI JOIN labels USING (doc_id)")
def pending_anti(spark, d):
    return read(spark, d, "documents").select("doc_id").join(read(spark, d, "labels"), "doc_id", "left_anti")


@query("SELECT doc_id, lang, source FROM documents SEMI JOIN (SELECT doc_id FROM labels WHERE quality = 1) USING (doc_id)")
def kept_semi(spark, d):
    return read(spark, d, "documents").select("doc_id", "lang", "source").join(read(spark, d, "labels").where("quality = 1"), "doc_id", "left_semi")


# --- mining ------------------------------------------------------------------------------------------------------------


def accept_target(target: str, conf: float):
    return (c("cls") == target) & (c("conf") >= conf)


def accept_uncertain(target: str, conf: float, uncertain: str, floor: float, upper: float):
    if not 0 <= floor < upper <= 1:
        raise ValueError("0 <= floor < upper <= 1 is asked for")
    return accept_target(target, conf) | ((c("cls") == uncertain) & (c("conf") >= floor) & (c("conf") < upper))


@query(f"WITH {DETECTIONS} SELECT video, count(*)::BIGINT AS accepted FROM dets WHERE frame % 3 = 0 AND cls = 'purchase' AND conf >= 0.5 GROUP BY video")
def mine_accept_target(spark, d):
    return detections(spark, d).where((F.pmod("frame", F.lit(3)) == 0) & accept_target("purchase", 0.5)).groupBy("video").agg(F.count("*").alias("accepted"))


@query(f"WITH {DETECTIONS} SELECT cls, count(*)::BIGINT AS accepted, round(max(conf), 4) AS top FROM dets WHERE (cls = 'purchase' AND conf >= 0.5) OR (cls = 'error' AND conf >= 0.25 AND conf < 0.6) GROUP BY cls")
def mine_accept_uncertain(spark, d):
    return detections(spark, d).where(accept_uncertain("purchase", 0.5, "error", 0.25, 0.6)).groupBy("cls").agg(F.count("*").alias("accepted"), F.round(F.max("conf"), 4).alias("top"))


CLAMPED = """clamped AS (SELECT image, greatest(0, least(round_even((x - w / 2) * 640, 0)::INT, 639)) AS x1, greatest(0, least(round_even((y - h / 2) * 480, 0)::INT, 479)) AS y1,
 greatest(0, least(round_even((x + w / 2) * 640, 0)::INT, 640)) AS x2, greatest(0, least(round_even((y + h / 2) * 480, 0)::INT, 480)) AS y2 FROM boxes)"""


@query(f"WITH {BOXES}, {CLAMPED} SELECT count(*)::BIGINT AS boxes, count_if(x2 - x1 < 20 OR y2 - y1 < 20)::BIGINT AS small, sum(x1)::BIGINT AS x1, sum(y1)::BIGINT AS y1, sum(x2)::BIGINT AS x2, sum(y2)::BIGINT AS y2 FROM clamped")
def clamp_box(spark, d):
    x, y, w, h = xywh()
    k = boxes(spark, d).select(B.clamp((x - w / 2) * 640, F.lit(640), 1).alias("x1"), B.clamp((y - h / 2) * 480, F.lit(480), 1).alias("y1"), B.clamp((x + w / 2) * 640, F.lit(640)).alias("x2"), B.clamp((y + h / 2) * 480, F.lit(480)).alias("y2"))
    small = (c("x2") - c("x1") < 20) | (c("y2") - c("y1") < 20)
    return k.agg(F.count("*").alias("boxes"), F.count_if(small).alias("small"), *[F.sum(n).alias(n) for n in ("x1", "y1", "x2", "y2")])


@query(f"""WITH {DETECTIONS}, n AS (SELECT *, row_number() OVER (PARTITION BY video, frame ORDER BY id) - 1 AS k FROM dets WHERE conf >= 0.2)
SELECT id, 'v' || video || printf('_f%06d_d%02d_c%03d.jpg', frame, k, round_even(conf * 100, 0)::BIGINT) AS crop, round(frame / 30.0, 3) AS time_sec FROM n""")
def crop_names(spark, d):
    """Names of the saved detections, which alone are numbered within a frame."""
    k = F.row_number().over(W.partitionBy("video", "frame").orderBy("id")) - 1
    saved = detections(spark, d).where("conf >= 0.2")
    name = B.crop_name(F.concat(F.lit("v"), c("video").cast("string")), c("frame"), k, c("conf"))
    return saved.select("id", name.alias("crop"), B.time_sec(c("frame"), F.lit(0.0)).alias("time_sec"))


BITS_T, COOLDOWN = 1, 200
#: One video's detections in order, with the list of those saved so far.
SAVED = f"""{DETECTIONS}, seq AS (SELECT *, row_number() OVER (PARTITION BY video ORDER BY frame, id) AS k FROM dets),
 walk(video, k, id, kept, saved) AS (SELECT DISTINCT video, 0::BIGINT, NULL::BIGINT, FALSE, []::STRUCT(f BIGINT, h BIGINT)[] FROM dets UNION ALL
  SELECT s.video, s.k, s.id, len(list_filter(w.saved, lambda z: s.frame - z.f <= {COOLDOWN} AND bit_count(xor(z.h, s.hash)) <= {BITS_T})) = 0,
   CASE WHEN len(list_filter(w.saved, lambda z: s.frame - z.f <= {COOLDOWN} AND bit_count(xor(z.h, s.hash)) <= {BITS_T})) = 0
    THEN list_append(list_filter(w.saved, lambda z: s.frame - z.f <= {COOLDOWN}), {{'f': s.frame, 'h': s.hash}}) ELSE list_filter(w.saved, lambda z: s.frame - z.f <= {COOLDOWN}) END
  FROM walk w JOIN seq s ON s.video = w.video AND s.k = w.k + 1)"""


def _temporal(spark: SparkSession, d: str) -> DataFrame:
    return S.temporal_kept(detections(spark, d), BITS_T, COOLDOWN)


@query(f"WITH RECURSIVE {SAVED} SELECT video, id FROM walk WHERE kept")
def temporal_dedup(spark, d):
    return _temporal(spark, d).where("kept").select("video", "id")


@query(f"""WITH RECURSIVE {SAVED}, n AS (SELECT cls, count(*) AS considered, count_if(kept) AS saved FROM walk JOIN dets USING (id) GROUP BY cls)
SELECT cls, considered::BIGINT AS considered, saved::BIGINT AS saved, (considered - saved)::BIGINT AS skipped, round((considered - saved) * 100.0 / considered, 6)::DOUBLE AS reduction FROM n""")
def mining_summary(spark, d):
    n = _temporal(spark, d).groupBy("cls").agg(F.count("*").alias("considered"), F.count_if("kept").alias("saved"))
    skipped = c("considered") - c("saved")
    return n.select("cls", "considered", "saved", skipped.alias("skipped"), F.round(F.coalesce(F.try_divide(skipped * 100.0, c("considered")), F.lit(0.0)), 6).cast("double").alias("reduction"))


# --- review log --------------------------------------------------------------------------------------------------------

LOG = "log AS (SELECT user_id AS crop, event_id AS seq, event_type AS decision FROM events)"
MAPPED = "CASE lower(trim(decision)) WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 END"


def _log(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").select(c("user_id").alias("crop"), c("event_id").alias("seq"), c("event_type").alias("decision"))


@query(f"WITH {LOG} SELECT crop, arg_max(decision, seq) AS decision FROM log GROUP BY crop")
def review_last_wins(spark, d):
    return _log(spark, d).groupBy("crop").agg(F.max_by("decision", "seq").alias("decision"))


@query(f"WITH {LOG} SELECT crop, arg_min({MAPPED}, seq)::INT AS cls FROM log WHERE {MAPPED} IS NOT NULL GROUP BY crop")
def review_export_first(spark, d):
    """The first decision of a crop that names a class; synonyms, case and spaces around don't matter."""
    classes = F.create_map(F.lit("purchase"), F.lit(0), F.lit("signup"), F.lit(1))
    return _log(spark, d).withColumn("cls", F.try_element_at(classes, F.lower(F.trim("decision")))).where("cls is not null").groupBy("crop").agg(F.min_by("cls", "seq").alias("cls"))


@query(f"WITH {LOG}, l AS (SELECT crop, arg_max(decision, seq) AS decision FROM log GROUP BY crop) SELECT decision, count(*)::BIGINT AS crops FROM l GROUP BY decision")
def decision_counts(spark, d):
    return review_last_wins(spark, d).groupBy("decision").agg(F.count("*").alias("crops"))


@query(f"""WITH RECURSIVE {LOG}, s AS (SELECT crop, decision = 'error' AS undo, decision, seq, sum(CASE WHEN decision = 'error' THEN -1 ELSE 1 END) OVER (PARTITION BY crop ORDER BY seq) AS level,
  sum(CASE WHEN decision = 'error' THEN -1 ELSE 1 END) OVER (PARTITION BY crop ORDER BY seq) - min(0) OVER (PARTITION BY crop) AS z FROM log),
 f AS (SELECT crop, seq, decision, undo, level, min(level) OVER (PARTITION BY crop ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS floor FROM s),
 g AS (SELECT crop, seq, decision, undo, level - least(floor, 0) AS depth FROM f), m AS (SELECT *, min(depth) OVER (PARTITION BY crop ORDER BY seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS later FROM g)
SELECT crop, arg_max(decision, seq) AS decision, count(*)::BIGINT AS standing FROM m WHERE NOT undo AND (later IS NULL OR later >= depth) GROUP BY crop""")
def review_undo(spark, d):
    """Decisions that stand after undo events, each of which takes back the last standing one of its crop: as brackets do."""
    w = W.partitionBy("crop").orderBy("seq")
    undo = c("decision") == "error"
    s = _log(spark, d).withColumn("level", F.sum(F.when(undo, -1).otherwise(1)).over(w))
    g = s.withColumn("depth", c("level") - F.least(F.min("level").over(w.rowsBetween(W.unboundedPreceding, 0)), F.lit(0)))
    m = g.withColumn("later", F.min("depth").over(w.rowsBetween(1, W.unboundedFollowing)))
    return m.where(~undo & (c("later").isNull() | (c("later") >= c("depth")))).groupBy("crop").agg(F.max_by("decision", "seq").alias("decision"), F.count("*").alias("standing"))


# --- grid, confidence, merge ---------------------------------------------------------------------------------------------


@query("""WITH n AS (SELECT event_id, 'e' || event_id || '_c' || lpad((event_id % 101)::VARCHAR, 3, '0') || '.jpg' AS name FROM events), m AS (SELECT event_id, round_even(value / 500, 4) AS conf FROM events WHERE event_id % 3 = 0)
SELECT name, coalesce(conf, try_cast(regexp_extract(regexp_replace(name, '\\.[^.]*$', ''), '_c(\\d+)$', 1) AS DOUBLE) / 100) AS conf FROM n LEFT JOIN m USING (event_id)""")
def confidence_fallback(spark, d):
    e = read(spark, d, "events")
    name = F.concat(F.lit("e"), c("event_id").cast("string"), F.lit("_c"), F.lpad((c("event_id") % 101).cast("string"), 3, "0"), F.lit(".jpg"))
    known = e.where("event_id % 3 = 0").select("event_id", B.round_even(c("value") / 500, 4).alias("conf"))
    return e.select("event_id", name.alias("name")).join(known, "event_id", "left").select("name", F.coalesce("conf", B.confidence_from_name(c("name"))).alias("conf"))


@query("""WITH r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) - 1 AS k FROM events)
SELECT user_id, event_id, (k // 12)::BIGINT AS page, (k % 12 // 4)::BIGINT AS "row", (k % 4)::BIGINT AS col, (4 + k % 4 * 132)::BIGINT AS x0, (4 + k % 12 // 4 * 132)::BIGINT AS y0 FROM r""")
def grid_pages(spark, d):
    """Pages of 3 rows by 4 columns, by value, with pixel places of cells of 128 pixels and gaps of 4."""
    k = c("k")
    r = read(spark, d, "events").select("user_id", "event_id", (F.row_number().over(W.partitionBy("user_id").orderBy(F.desc("value"), "event_id")) - 1).cast("long").alias("k"))
    row = F.floor(k % 12 / 4)
    return r.select("user_id", "event_id", F.floor(k / 12).alias("page"), row.alias("row"), (k % 4).alias("col"), (4 + k % 4 * 132).alias("x0"), (4 + row * 132).alias("y0"))


@query("""WITH u AS (SELECT doc_id, 'train' AS split, n_chars % 4 AS cls FROM documents WHERE doc_id % 10 < 7 UNION ALL SELECT doc_id, 'train', n_chars % 3 FROM documents WHERE doc_id % 10 = 9)
SELECT split, count_if(cls = 0)::BIGINT AS class_0, count_if(cls = 1)::BIGINT AS class_1, count_if(cls NOT IN (0, 1))::BIGINT AS other, count(*)::BIGINT AS total FROM u GROUP BY split""")
def merge_append_counts(spark, d):
    docs = read(spark, d, "documents").select("doc_id", "n_chars")
    old = docs.where("doc_id % 10 < 7").select(F.lit("train").alias("split"), (c("n_chars") % 4).alias("cls"))
    u = old.unionByName(docs.where("doc_id % 10 = 9").select(F.lit("train").alias("split"), (c("n_chars") % 3).alias("cls")))
    return u.groupBy("split").agg(F.count_if(c("cls") == 0).alias("class_0"), F.count_if(c("cls") == 1).alias("class_1"), F.count_if(~c("cls").isin(0, 1)).alias("other"), F.count("*").alias("total"))
