"""Quality rules by distribution divergence, with DataFrame functions only.

Each document gets two histograms: its non-space characters by class, and its common words (fixed lists of function words)
plus one bin for all other words.  Both are compared by Jensen-Shannon distance with the reference of every language; the
reference is the mean histogram of all long enough documents of that language, found in a first pass over the whole table.
A document is far from natural text if its nearest reference is farther than a threshold.  For the classes that is a fixed
distance; for the common words it is a share of what a text without any common word reaches, for each reference its own.

Defined results for odd input: a null or empty text has no words, fails the base rules and has null distances.  A document
below ``min_words`` or ``min_chars`` is too short for stable histograms, so the divergence verdict leaves it alone.  Rows
are judged on their own: repeated rows give repeated results.  Extra columns are ignored, unless listed in ``keep``.  An
empty table gives an empty result.  A missing or unknown language leaves a row out of the references; one that is named but
has no word list leaves it out of the common-word verdict too, which has nothing to hold it against.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import WS, let, materialize, table, words

# Frequent function words of each language.
COMMON_WORDS = {
    "en": "the of and to in a is that for it as with was on be by at this are or an from not have which".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se avec il ce".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero".split(),
}
CLASSES = ("lower", "upper", "digit", "punctuation", "symbol")
#: Regular expressions of the character classes, each applied to what the ones before it left.
CLASS_PATTERNS = ("\\p{Ll}+", "\\p{L}+", "\\p{N}+", "[\\p{P}&&[^#*%&]]+")


def _word_list() -> list[str]:
    return sorted({w for ws in COMMON_WORDS.values() for w in ws})


def _repeated(ws: Column) -> Column:
    """How many words lie in 8-word windows that occur twice or more in the list ``ws``; windows are compared by 64-bit hash."""

    def covered(h: Column) -> Column:
        # Sorted (hash, place); those with an equal neighbour are repeated, and each covers 8 places from its own.
        def places(s: Column) -> Column:
            near = F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]))
            return F.sort_array(F.transform(near, lambda x: x["i"]))

        def total(p: Column) -> Column:
            return F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(8), F.get(p, i + 1) - x)), F.lit(0), lambda a, x: a + x)

        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(let(pairs, places), total)

    # A window's hash from those of its halves, and theirs likewise: three steps instead of eight words each time.
    step = lambda h, k: F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + k)))
    halves = let(let(F.transform(ws, lambda w: F.xxhash64(w)), lambda h: step(h, 1)), lambda h: step(h, 2))
    windows = let(halves, lambda h: F.slice(step(h, 4), 1, F.greatest(F.lit(0), F.size(h) - 7)))
    return let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h)))


def features(docs: DataFrame, keep: tuple[str, ...] = ("doc_id", "lang")) -> DataFrame:
    """``keep`` plus counts of every whole text: ``n_words word_chars n_symbols n_dup_lines n_repeat_words``, ``classes``
    (characters by class) and ``common`` (place in the word list and count of each common word present)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    listed = F.array(*[F.lit(w) for w in _word_list()])

    def common(ws: Column) -> Column:
        found = F.sort_array(F.filter(F.transform(ws, lambda w: F.lower(w)), lambda w: w.isin(_word_list())))

        def runs(s: Column) -> Column:
            starts = F.transform(F.array_distinct(s), lambda w: F.struct(F.array_position(s, w).alias("at"), (F.array_position(listed, w) - 1).cast("int").alias("k")))
            return let(starts, lambda d: F.transform(d, lambda x, i: F.struct(x["k"].alias("k"), (F.coalesce(F.get(d, i + 1)["at"], F.size(s) + 1) - x["at"]).alias("n"))))

        return let(found, runs)

    out = docs.select(*keep, text.alias("_t")).select(
        *keep,
        F.regexp_replace("_t", f"[{WS}]+", "").alias("_c"),
        (F.length("_t") - F.length(F.regexp_replace("_t", "[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        let(F.filter(F.split("_t", "\n"), lambda x: x.rlike(f"[^{WS}]")), lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("n_dup_lines"),
        let(words(F.col("_t")), lambda ws: F.struct(F.size(ws).alias("n"), _repeated(ws).alias("rep"), common(ws).alias("common"))).alias("_w"),
    )
    rest = F.col("_c")

    def chain(t: Column, left: tuple[str, ...]) -> Column:
        """Lengths of what remains of ``t`` after each pattern, the longest first."""
        if not left:
            return F.array(F.length(t))
        return F.concat(F.array(F.length(t)), let(F.regexp_replace(t, left[0], ""), lambda u: chain(u, left[1:])))

    remain = let(rest, lambda t: chain(t, CLASS_PATTERNS))
    counted = out.select(*keep, "n_symbols", "n_dup_lines", "_w", remain.alias("_r"))
    classes = F.array(*[F.col("_r")[i] - (F.col("_r")[i + 1] if i + 1 < len(CLASSES) else F.lit(0)) for i in range(len(CLASSES))])
    return counted.select(
        *keep,
        F.col("_w.n").cast("long").alias("n_words"),
        F.col("_r")[0].cast("long").alias("word_chars"),
        "n_symbols",
        "n_dup_lines",
        F.col("_w.rep").cast("long").alias("n_repeat_words"),
        classes.alias("classes"),
        F.col("_w.common").alias("common"),
    )


def references(feats: DataFrame, min_words: int, min_chars: int) -> dict[str, tuple[list[float], dict[int, float]]]:
    """Mean histograms by language.  What comes to the driver is one row for each language of ``COMMON_WORDS``."""
    k = len(_word_list())
    good = feats.where(F.col("lang").isin(*COMMON_WORDS) & (F.col("n_words") >= min_words) & (F.col("word_chars") >= min_chars))
    share = good.select(
        "lang",
        *[(F.col("classes")[i] / F.col("word_chars")).alias(f"c{i}") for i in range(len(CLASSES))],
        F.transform("common", lambda x: F.struct(x["k"].alias("k"), (x["n"] / F.col("n_words")).alias("p"))).alias("p"),
    )
    means = share.groupBy("lang").agg(F.count("*").alias("n"), *[F.avg(f"c{i}").alias(f"c{i}") for i in range(len(CLASSES))])
    common = share.select("lang", F.explode("p").alias("x")).groupBy("lang", "x.k").agg(F.sum("x.p").alias("p"))
    out = {r["lang"]: ([r[f"c{i}"] for i in range(len(CLASSES))], {}, r["n"]) for r in means.collect()}
    for r in common.collect():  # at most the languages times the word list
        if r["k"] < k:
            out[r["lang"]][1][r["k"]] = r["p"] / out[r["lang"]][2]
    return {lang: (c, w) for lang, (c, w, _) in sorted(out.items())}


def _term(p: Column, q: Column) -> Column:
    """What a bin of probabilities p and q adds to twice the Jensen-Shannon divergence in bits."""
    m = p + q
    return F.when(p > 0, p * F.log2(2 * p / m)).otherwise(F.lit(0.0)) + F.when(q > 0, q * F.log2(2 * q / m)).otherwise(F.lit(0.0))


def _char_distance(ref: list[float]) -> Column:
    total = sum((_term(F.col("classes")[i] / F.col("word_chars"), F.lit(float(q))) for i, q in enumerate(ref)), F.lit(0.0))
    return F.sqrt(F.greatest(F.lit(0.0), total / 2))


def _word_distance(ref: dict[int, float]) -> Column:
    k = len(_word_list())
    qs = F.array(*[F.lit(float(ref.get(i, 0.0))) for i in range(k)])
    rest = max(0.0, 1 - math.fsum(ref.values()))
    seen = F.aggregate(
        "common",
        F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("q"), F.lit(0.0).alias("p")),
        lambda a, x: let(
            F.struct((x["n"] / F.col("n_words")).alias("p"), F.get(qs, x["k"]).alias("q")),
            lambda y: F.struct((a["d"] + _term(y["p"], y["q"])).alias("d"), (a["q"] + y["q"]).alias("q"), (a["p"] + y["p"]).alias("p")),
        ),
    )
    absent = lambda s: F.lit(1 - rest) - s["q"]  # noqa: E731  words of the reference that the document lacks
    return F.sqrt(F.greatest(F.lit(0.0), let(seen, lambda s: (s["d"] + absent(s) + _term(1 - s["p"], F.lit(float(rest)))) / 2)))


def empty_distance(ref: dict[int, float]) -> float:
    """Word distance from the reference to a text without any common word; 0 if the reference has none either."""
    common = math.fsum(ref.values())
    rest = max(0.0, 1 - common)
    return math.sqrt(max(0.0, (common + math.log2(2 / (1 + rest)) + (rest and rest * math.log2(2 * rest / (1 + rest)))) / 2))


def apply(docs: DataFrame, min_words: int = 50, min_chars: int = 200, max_char_distance: float = 0.3, max_word_share: float = 0.9, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Counts, distances and verdict of each row of ``docs``, see the module's text.

    ``char_distance`` and ``word_distance`` are those to the nearest reference, null where a text is too short to judge.
    ``kept`` is false if ``base_failed``, if ``char_distance`` is over ``max_char_distance``, or if the word distance to every
    reference is over ``max_word_share`` of its ``empty_distance``."""
    with_lang = docs if "lang" in docs.columns else docs.withColumn("lang", F.lit(None).cast("string"))
    feats = materialize(features(with_lang, tuple(dict.fromkeys((*keep, "lang")))), "features")
    refs = references(feats, min_words, min_chars)
    long_enough = (F.col("n_words") >= min_words) & (F.col("word_chars") >= min_chars)
    null = F.lit(None).cast("double")
    limits = [max_word_share * empty_distance(w) if w else None for _, w in refs.values()]  # without common words a reference says nothing
    judged = F.col("lang").isNull() | F.col("lang").isin(*COMMON_WORDS)
    few_common = F.lit(False)
    if any(x is not None for x in limits):
        over = [F.col("_words")[i] > x for i, x in enumerate(limits) if x is not None]
        few_common = judged & F.coalesce(F.array_min(F.array(*over)), F.lit(False))
    nearest = lambda cols: F.array_min(F.array(*cols)) if cols else null
    return (
        feats.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
        .withColumn("char_distance", F.when(long_enough, nearest([_char_distance(c) for c, _ in refs.values()])))
        .withColumn("_words", F.when(long_enough, F.array(*[_word_distance(w) for _, w in refs.values()]).cast("array<double>")))
        .withColumn("word_distance", F.array_min("_words"))
        .withColumn("kept", ~F.col("base_failed") & (F.coalesce("char_distance", F.lit(0.0)) <= max_char_distance) & ~few_common)
        .select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "char_distance", "word_distance")
    )


def oracle_sql(min_words: int = 50, min_chars: int = 200, max_char_distance: float = 0.3, max_word_share: float = 0.9) -> str:
    """The rows of ``op9_quality_rules`` in DuckDB SQL."""
    listed = ", ".join(f"({k}, '{w}')" for k, w in enumerate(_word_list()))
    langs = ", ".join(f"'{x}'" for x in COMMON_WORDS)
    term = lambda p, q: f"(CASE WHEN {p} > 0 THEN {p} * log2(2 * {p} / ({p} + {q})) ELSE 0 END + CASE WHEN {q} > 0 THEN {q} * log2(2 * {q} / ({p} + {q})) ELSE 0 END)"
    names = [f"k{i}" for i in range(len(CLASSES))]
    return rf"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
 w AS MATERIALIZED (SELECT *, regexp_extract_all(t, '[^{WS}]+') AS ws, regexp_replace(t, '[{WS}]+', '', 'g') AS c0,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{WS}]')) AS ls FROM d),
 g1 AS (SELECT rid, regexp_replace(c0, '\p{{Ll}}+', '', 'g') AS c FROM w), g2 AS (SELECT rid, regexp_replace(c, '\p{{L}}+', '', 'g') AS c FROM g1),
 g3 AS (SELECT rid, regexp_replace(c, '\p{{N}}+', '', 'g') AS c FROM g2), g4 AS (SELECT rid, regexp_replace(c, '[^\P{{P}}#*%&]+', '', 'g') AS c FROM g3),
 k AS (SELECT rid, length(c0) - length(g1.c) AS k0, length(g1.c) - length(g2.c) AS k1, length(g2.c) - length(g3.c) AS k2, length(g3.c) - length(g4.c) AS k3, length(g4.c) AS k4
  FROM w JOIN g1 USING (rid) JOIN g2 USING (rid) JOIN g3 USING (rid) JOIN g4 USING (rid)),
 win AS (SELECT rid, unnest(list_transform(range(1, greatest(1, len(ws) - 6)), lambda i: {{'i': i, 'g': array_to_string(ws[i:i + 7], ' ')}})) AS x FROM w),
 rep AS (SELECT rid, x.i AS i FROM win QUALIFY count(*) OVER (PARTITION BY rid, x.g) > 1),
 cov AS (SELECT rid, least(8, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, 8)) AS n FROM rep), covered AS (SELECT rid, sum(n)::BIGINT AS n FROM cov GROUP BY rid),
 f AS MATERIALIZED (SELECT w.rid, doc_id, lang, len(ws)::BIGINT AS n_words, length(c0)::BIGINT AS word_chars, (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words, k.* EXCLUDE (rid)
  FROM w JOIN k USING (rid) LEFT JOIN covered USING (rid)),
 list(k, word) AS (VALUES {listed}), said AS (SELECT rid, unnest(list_transform(ws, lambda x: lower(x))) AS word FROM w),
 common AS MATERIALIZED (SELECT rid, k, count(*) AS n FROM said JOIN list USING (word) GROUP BY ALL),
 good AS (SELECT * FROM f WHERE lang IN ({langs}) AND n_words >= {min_words} AND word_chars >= {min_chars}),
 means AS (SELECT lang, count(*) AS docs, {', '.join(f'avg({x} / word_chars) AS q_{x}' for x in names)} FROM good GROUP BY lang),
 q AS MATERIALIZED (SELECT lang, c.k, sum(c.n / n_words) / any_value(docs) AS q FROM good JOIN common c USING (rid) JOIN means USING (lang) GROUP BY lang, c.k),
 ref AS MATERIALIZED (SELECT means.*, coalesce((SELECT sum(q) FROM q WHERE q.lang = means.lang), 0) AS s FROM means),
 far AS (SELECT lang, CASE WHEN s > 0 THEN sqrt(greatest(0, (s + log2(2 / (1 + greatest(0, 1 - s))) + CASE WHEN s < 1 THEN (1 - s) * log2(2 * (1 - s) / (2 - s)) ELSE 0 END) / 2)) END AS far FROM ref),
 long AS (SELECT * FROM f WHERE n_words >= {min_words} AND word_chars >= {min_chars}),
 seen AS (SELECT l.rid, r.lang, sum({term('(c.n / n_words)', 'coalesce(q.q, 0)')}) AS d, sum(coalesce(q.q, 0)) AS q, sum(c.n / n_words) AS p
  FROM long l JOIN common c USING (rid) CROSS JOIN ref r LEFT JOIN q ON q.lang = r.lang AND q.k = c.k GROUP BY ALL),
 dist AS (SELECT l.rid, r.lang, sqrt(greatest(0, ({' + '.join(term(f'({x} / word_chars)', f'q_{x}') for x in names)}) / 2)) AS c,
  sqrt(greatest(0, (coalesce(seen.d, 0) + r.s - coalesce(seen.q, 0) + {term('(1 - coalesce(seen.p, 0))', 'greatest(0, 1 - r.s)')}) / 2)) AS w
  FROM long l CROSS JOIN ref r LEFT JOIN seen ON seen.rid = l.rid AND seen.lang = r.lang),
 near AS (SELECT rid, min(c) AS c, min(w) AS w, coalesce(bool_and(w > {max_word_share} * far) FILTER (WHERE far IS NOT NULL), FALSE) AS few FROM dist JOIN far USING (lang) GROUP BY rid),
 b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f LEFT JOIN near USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
 NOT base_failed AND coalesce(c, 0) <= {max_char_distance} AND NOT (coalesce(few, FALSE) AND (lang IS NULL OR lang IN ({langs}))) AS kept, round(c, 6) AS char_distance, round(w, 6) AS word_distance FROM b"""


ORACLE_SQL = oracle_sql()


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rounded = {c: F.round(c, 6) for c in ("char_distance", "word_distance")}
    return apply(table(spark, sf_dir, "documents")).withColumns(rounded)
