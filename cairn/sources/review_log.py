"""A review log that keeps the order of its events: CSV folders ``batch-<number>``, one for each append, and ``snapshot-<number>``
folders that stand for all batches up to their number.

An append claims its number by creating a file that nobody else can create, writes aside, and appears by one rename; so does a
snapshot.  What a failed job leaves is hidden, and its number stays unused.  Files that lie in the log's folder itself, or a log
that is one file, come before all batches, in order of time, then of the file."""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.sources import files

KINDS = r"^(batch|snapshot)-(\d{12})$"


def _at(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _parts(spark: SparkSession, path: str) -> tuple[list[str], dict[int, str], dict[int, str]]:
    """Single files of a log, its batches and its snapshots by number: a name for each append since they were last tidied up."""
    at, fs = _at(spark, path)
    single, found = [], {"batch": {}, "snapshot": {}}
    for status in fs.listStatus(at):
        name, full = status.getPath().getName(), status.getPath().toString()
        if known := re.match(KINDS, name):
            found[known[1]][int(known[2])] = full
        elif status.isFile() and name[0] not in "_.":
            single.append(full)
    return single, found["batch"], found["snapshot"]


def _claims(spark: SparkSession, path: str) -> list[int]:
    at, fs = _at(spark, f"{path}/_claims")
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(at) if s.getPath().getName().isdigit()) if fs.exists(at) else []


def _claim(spark: SparkSession, path: str) -> int:
    number = max([0, *_claims(spark, path)]) + 1
    while True:
        at, fs = _at(spark, f"{path}/_claims/{number:012d}")
        try:
            fs.create(at, False).close()
            return number
        except Py4JJavaError:
            if not fs.exists(at):
                raise
            number += 1


def _publish(rows: DataFrame, order: list[str], columns: list[str], path: str, name: str) -> None:
    """``rows`` in ``order`` over files whose numbers follow it, shown at once under ``name``."""
    spark, aside = rows.sparkSession, f"{path}/_new-{uuid.uuid4().hex}"
    rows.repartitionByRange(*order).sortWithinPartitions(*order).select(*columns).write.csv(aside, header=True)
    at, fs = _at(spark, aside)
    if not fs.rename(at, _at(spark, f"{path}/{name}")[0]):
        raise OSError(f"{path}/{name} can't be made")


def append(rows: DataFrame, order: list[str], columns: list[str], path: str) -> int:
    """Add ``columns`` of ``rows``, in ``order``, after all that was appended before; returns the batch's number."""
    number = _claim(rows.sparkSession, path)
    _publish(rows, order, columns, path, f"batch-{number:012d}")
    return number


def _read(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    file = F.col("_metadata.file_path")
    batch = F.coalesce(F.regexp_extract(file, r"/(?:batch|snapshot)-(\d{12})/[^/]*$", 1).try_cast("long"), F.lit(0)).alias("batch")
    part = F.coalesce(F.regexp_extract("_metadata.file_name", r"^part-(\d+)-", 1).try_cast("long"), F.lit(0)).alias("part")
    where = F.struct(batch, part, file.alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    read = files.read_csv(spark, paths, schema, where.alias("seq"))
    time = F.when(F.col("seq.batch") == 0, F.col("timestamp"))
    return read.withColumn("seq", F.struct("seq.batch", time.alias("time"), "seq.part", "seq.file", "seq.block", "seq.row"))


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The events of a log with ``seq``, which orders them as they were appended."""
    single, batches, snapshots = _parts(spark, path)
    last = max(snapshots, default=0)
    paths = [*single, *[p for n, p in sorted(batches.items()) if n > last], *([snapshots[last]] if last else [])]
    return _read(spark, paths, schema) if paths else spark.createDataFrame([], schema).withColumn("seq", F.struct(F.lit(0).alias("batch")))


def compact(spark: SparkSession, path: str, schema: str) -> int | None:
    """Make one snapshot of the last one and the batches after it, with every event; returns its number, None if there is nothing new.

    It ends before the first batch that is claimed and hasn't appeared, so no event can come to lie behind a snapshot."""
    _, batches, snapshots = _parts(spark, path)
    last = top = max(snapshots, default=0)
    for n in [n for n in _claims(spark, path) if n > last]:
        if n not in batches:
            break
        top = n
    if top == last:
        return None
    paths = [*([snapshots[last]] if last else []), *[p for n, p in batches.items() if last < n <= top]]
    rows = _read(spark, paths, schema)
    _publish(rows, ["seq"], [c for c in rows.columns if c != "seq"], path, f"snapshot-{top:012d}")
    return top


def tidy(spark: SparkSession, path: str) -> None:
    """Delete batches and snapshots that the last snapshot stands for; only while nobody reads the log as it was before."""
    _, batches, snapshots = _parts(spark, path)
    last = max(snapshots, default=0)
    for p in [*[p for n, p in batches.items() if n <= last], *[p for n, p in snapshots.items() if n < last]]:
        at, fs = _at(spark, p)
        fs.delete(at, True)
