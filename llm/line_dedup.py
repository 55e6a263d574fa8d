"""Dropping lines that many documents share, by levelled sorted runs of line hashes, with DataFrame functions only.

``LineRuns`` keeps how many documents each line is found in.  A batch of documents adds one run, its line hashes with their
counts, sorted.  When a level holds ``fan`` runs they are merged into one of the next level, so a line's count is rewritten about
log(batches) times.  A run is a folder named by the batches it covers; it counts once its writer has finished, and one that lies
within a wider run is old, so a merge that is broken off changes nothing.  Cleaning merge-joins the lines of documents with
all runs and drops those that are frequent: only hashes are shuffled for it, and each text once for the result.

Lines are known by two 64-bit hashes of their key: the line stripped of white space at both ends, A-Z lower-cased.  Hot lines
and large groups of equal texts are dealt to several tasks.

Defined results for odd input: a null or empty text is one empty line.  Every row is a document of its own, whatever its id, so
repeated rows count once each.  A line repeated within a document counts once and is dropped everywhere.  Keys shorter than
``min_chars`` code points are never dropped.  A document that loses all lines keeps an empty text.  Ids can be null.  Columns
that aren't in ``keep`` are ignored, whatever their names.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import WS, hot_keys, let, materialize, remove, shared_dir, spread_join, table

BLANK = " \t\n\x0b\x0c\r"
TEXT, LINE = ["_t1", "_t2"], ["_h1", "_h2"]


def _lowered(text: Column) -> Column:
    """``text`` with A-Z in lower case and all else as it is."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def _hashed(x: Column) -> tuple[Column, Column]:
    return F.xxhash64(x), F.xxhash64(F.lit(1), x)


def line_keys(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """For every row of ``docs`` the two hashes of its text and ``_lines``: hashes, place and ``first`` (the first of its kind in
    the document) of each line whose key has ``min_chars`` code points or more, sorted by hash."""

    def sort(keys: Column) -> Column:
        each = F.transform(keys, lambda k, i: F.struct(*[h.alias(n) for h, n in zip(_hashed(k), LINE, strict=True)], i.alias("_i"), F.length(k).alias("_n")))
        return F.sort_array(F.filter(each, lambda x: x["_n"] >= min_chars))

    def mark(s: Column) -> Column:
        same = lambda x, y: (x["_h1"] == y["_h1"]) & (x["_h2"] == y["_h2"])
        return F.transform(s, lambda x, i: F.struct(x["_h1"].alias("_h1"), x["_h2"].alias("_h2"), x["_i"].alias("_i"), (~F.coalesce(same(F.get(s, i - 1), x), F.lit(False))).alias("_first")))

    text = docs.select(F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    keys = F.transform(F.split(_lowered(F.col("_text")), "\n"), lambda x: F.btrim(x, F.lit(BLANK)))
    return text.select(*[h.alias(n) for h, n in zip(_hashed(F.col("_text")), TEXT, strict=True)], let(let(keys, sort), mark).alias("_lines"))


class LineRuns:
    """Counts of lines below ``path`` (a folder that driver and executors share), in levels of sorted runs."""

    def __init__(self, spark: SparkSession, path: str, fan: int = 3):
        self.spark, self.path, self.fan = spark, path.rstrip("/"), fan
        self._at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        self._files = self._at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._files.mkdirs(self._at)

    def runs(self) -> list[tuple[int, int, int]]:
        """Level, first and last batch of each run that holds, by batch; a handful for any number of batches."""
        found = []
        for status in self._files.listStatus(self._at):
            name = re.fullmatch(r"run-(\d+)-(\d+)-(\d+)", status.getPath().getName())
            if name and self._files.exists(self._child(f"{status.getPath().getName()}/_SUCCESS")):
                found.append(tuple(int(x) for x in name.groups()))
        wide = [r for r in found if not any(o != r and o[1] <= r[1] and r[2] <= o[2] and o[0] > r[0] for o in found)]
        return sorted(wide, key=lambda r: r[1])

    def _child(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _put(self, counts: DataFrame, level: int, first: int, last: int) -> None:
        name = f"run-{level}-{first}-{last}"
        counts.groupBy(*LINE).agg(F.sum("_docs").alias("_docs")).sortWithinPartitions(*LINE).write.mode("overwrite").parquet(f"{self.path}/{name}")

    def _read(self, runs: list[tuple[int, int, int]]) -> DataFrame:
        return self.spark.read.schema("_h1 long, _h2 long, _docs long").parquet(*[f"{self.path}/run-{a}-{b}-{c}" for a, b, c in runs])

    def add(self, keys: DataFrame) -> int:
        """Add a batch (rows of ``line_keys``) as a run of its own and merge full levels; the batch's number."""
        held = self.runs()
        batch = held[-1][2] + 1 if held else 0
        rows = keys.select(F.explode("_lines").alias("x")).where("x._first").select(*[F.col(f"x.{c}").alias(c) for c in LINE], F.lit(1).cast("long").alias("_docs"))
        self._put(rows, 0, batch, batch)
        level = 0
        while len(full := [r for r in self.runs() if r[0] == level]) >= self.fan:
            self._put(self._read(full), level + 1, full[0][1], full[-1][2])
            for a, b, c in full:
                self._files.delete(self._child(f"run-{a}-{b}-{c}"), True)
            level += 1
        return batch

    def frequent(self, min_docs: int) -> DataFrame:
        """Lines found in ``min_docs`` documents or more, with their count."""
        held = self.runs()
        if not held:
            return self.spark.createDataFrame([], "_h1 long, _h2 long, _docs long")
        return self._read(held).groupBy(*LINE).agg(F.sum("_docs").alias("_docs")).where(F.col("_docs") >= min_docs)

    def clean(self, docs: DataFrame, keys: DataFrame, min_docs: int, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
        """``keep`` of every row of ``docs``, with ``n_lines n_dropped kept_text``: its text without lines that the runs have from
        ``min_docs`` documents or more.  ``docs`` is a written table and ``keys`` its written ``line_keys``."""
        taken = [c for c in keep if c.lower() in ("n_lines", "n_dropped", "kept_text")]
        if taken:
            raise ValueError(f"columns {taken} can't be kept: the result has others of these names")
        known = materialize(self.frequent(min_docs), "frequent")
        lines = keys.select(*TEXT, F.explode("_lines").alias("x")).select(*TEXT, *[F.col(f"x.{c}").alias(c) for c in (*LINE, "_i")])
        total = keys.agg(F.sum(F.size("_lines")).alias("n")).first()["n"] or 0
        found = spread_join(lines, known.select(*LINE), LINE, hot_keys(known, LINE, "_docs", total))
        drops = materialize(found.groupBy(*TEXT).agg(F.collect_set("_i").alias("_drops")), "drops")
        hot = materialize(hot_keys(keys.groupBy(*TEXT).agg(F.count("*").alias("_copies")).where(F.col("_copies") > 1), TEXT, "_copies", keys.count()), "copies")
        rows = docs.select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keep)], F.coalesce(F.col("text"), F.lit("")).alias("_text"))
        rows = rows.select("*", *[h.alias(n) for h, n in zip(_hashed(F.col("_text")), TEXT, strict=True)])
        joined = spread_join(rows, drops, TEXT, hot, "left")

        def cut(ls: Column) -> Column:
            left = F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.coalesce(F.col("_drops"), F.array().cast("array<int>")))
            text = F.when(F.col("_drops").isNull(), F.col("_text")).otherwise(F.array_join(F.transform(left, lambda i: F.get(ls, i)), "\n"))
            return F.struct(F.size(ls).cast("long").alias("n"), text.alias("text"))

        done = joined.select("*", let(F.split("_text", "\n"), cut).alias("_r"))
        n_dropped = F.coalesce(F.size("_drops"), F.lit(0)).cast("long")
        return done.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], F.col("_r.n").alias("n_lines"), F.when(F.col("_drops").isNull(), 0).otherwise(n_dropped).cast("long").alias("n_dropped"), F.col("_r.text").alias("kept_text"))


def apply(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = 4, fan: int = 3, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep n_lines n_dropped kept_text`` of every row of ``docs``: its text without lines found in ``min_docs`` documents or
    more.  The documents are added in ``batches``, dealt by a hash of their texts, and cleaned when all are known."""
    keys = materialize(line_keys(docs, min_chars), "lines")
    runs = LineRuns(docs.sparkSession, f"{shared_dir(docs.sparkSession)}-runs", fan)
    runs._files.deleteOnExit(runs._at)
    for b in range(batches):
        runs.add(keys.where(F.pmod("_t2", F.lit(batches)) == b))
    cleaned = runs.clean(docs, keys, min_docs, keep)
    remove(keys)
    return cleaned


ORACLE_SQL = f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
 l AS (SELECT rid, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d),
 k AS MATERIALIZED (SELECT *, translate(regexp_replace(line, '^[{WS}]+|[{WS}]+$', '', 'g'), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS key FROM l),
 f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT rid) >= 10),
 m AS (SELECT k.*, f.key IS NOT NULL AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m JOIN d USING (rid) GROUP BY rid, doc_id"""


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = apply(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
