"""Helpers that the operators share: tables, the shared scratch folder, null-safe columns, deterministic hashes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

WS = "\\x20\\x09-\\x0D"
WORD = f"[^{WS}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Table ``name`` of a data folder; only Spark's reader touches the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share.  Where that is unset, a session on one
    machine gets a folder of its own, and any other an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = held.get() if held.isDefined() else None
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "part") -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: lineage ends there, and lost executors cost nothing.

    The files go when ``remove`` is called, at the latest when the application ends."""
    spark, path = df.sparkSession, f"{shared_dir(df.sparkSession)}-{name}"
    df.write.parquet(path)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


def remove(*frames: DataFrame) -> None:
    """Delete what ``materialize`` wrote for these frames; they can't be used afterwards."""
    for df in frames:
        for file in df.inputFiles()[:1]:
            spark = df.sparkSession
            jvm = spark.sparkContext._jvm
            path = jvm.org.apache.hadoop.fs.Path(file).getParent()
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def held_out(doc_id: Column) -> Column:
    """True for the fold that no model learns from: crc32 of the id as text, modulo 3, is 1 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once a row, although ``body`` may use it many times or inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The runs of non-space characters of ``text`` as an array; null and blank texts give an empty one."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{WS}]+"), "")


def spare(name: str, columns: list[str]) -> str:
    """``name``, with underscores in front until no column of ``columns`` is called so, whatever its case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def sliced(batches: Iterator[pa.RecordBatch], text: str, rows: int = 256, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows, and of about ``size`` bytes of column ``text``; a single row can be longer."""
    for b in batches:
        held = b.column(text)
        ends = np.frombuffer(held.buffers()[1], dtype=np.int64 if pa.types.is_large_string(held.type) else np.int32)[held.offset : held.offset + len(held) + 1] if len(held) else [0]
        lo = 0
        while lo < b.num_rows:
            hi = int(np.searchsorted(ends, ends[lo] + size, "right")) - 1
            hi = max(lo + 1, min(hi, lo + rows, b.num_rows))
            yield b.slice(lo, hi - lo)
            lo = hi


#: A key with more than one in so many of a table's rows is dealt to several tasks; there can't be more such keys than this.
SHARE = 1000


def hot_keys(counts: DataFrame, on: list[str], many: str, total: int) -> DataFrame:
    """Of ``counts``, a row for each key ``on`` and its ``many`` rows among ``total``: the hot keys, ``SHARE`` at most, and
    in ``_parts`` how many tasks each should be dealt to."""
    hot = counts.where(F.col(many) * SHARE > total)
    return hot.select(*on, F.ceil(F.col(many) * (SHARE / max(1, total))).cast("int").alias("_parts"))


def spread_join(rows: DataFrame, known: DataFrame, on: list[str], hot: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` joined to ``known`` (few rows a key) on equal ``on``, where no task gets all rows of a hot key.

    ``hot`` (of ``hot_keys``) is broadcast to both sides: rows of a hot key are dealt to its parts by their place in the table,
    which must therefore be a written one, and ``known`` has a copy for each part.  Null keys find nothing and are dealt too."""
    few, keyless = F.broadcast(hot), F.lit(False)
    for c in on:
        keyless = keyless | F.col(c).isNull()
    place = F.monotonically_increasing_id()
    part = F.when(keyless, F.pmod(place, F.lit(SHARE))).otherwise(F.pmod(place, F.coalesce(F.col("_parts"), F.lit(1))))
    dealt = rows.join(few, on, "left").withColumn("_part", part.cast("int")).drop("_parts")
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)
    spread = known.join(few, on, "left").withColumn("_part", F.explode(copies)).drop("_parts")
    return dealt.join(spread, [*on, "_part"], how).drop("_part")


def bounded_sample(rows: DataFrame, by: str, key: Column, each: int) -> DataFrame:
    """``rows`` plus ``u``, the rank-deciding hash ``key`` as a number of 0 to 1: the ``each`` smallest of every value of ``by``.

    Rows equal in ``by`` and ``key`` count once, with their least values, so the result has ``each`` rows a value at most,
    however often a row is repeated.  One pass estimates how many keys there are, so few more than are wanted are shuffled."""
    u = F.pmod(key, F.lit(1 << 52)) / (1 << 52)
    dealt = rows.withColumn("u", u)
    about = {r[by]: r["n"] for r in rows.select(by, u.alias("u")).groupBy(by).agg(F.approx_count_distinct("u").alias("n")).collect()}
    share = F.lit(0.0)
    for value, n in about.items():
        share = F.when(F.col(by) == value, min(1.0, 2.0 * each / max(1, n) + 8 / max(1, n))).otherwise(share)
    others = [c for c in rows.columns if c != by]
    once = dealt.where(F.col("u") <= share).groupBy(by, "u").agg(*[F.min(c).alias(c) for c in others])
    first = once.withColumn("_k", F.row_number().over(W.partitionBy(by).orderBy("u"))).where(F.col("_k") <= each)
    return first.select(by, "u", *others)
