"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def stage(df: DataFrame) -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read again, so that lineage ends there.

    Where that is unset, a session on one machine gets a folder of its own, and any other an error.  Files go when the
    application ends, or earlier by ``drop``."""
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="cairn-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/cairn-{uuid.uuid4().hex}"
    df.write.parquet(path)
    at, files = _path(spark, path)
    files.deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


def drop(*frames: DataFrame) -> None:
    """Delete what ``stage`` wrote for these frames; they can't be used afterwards."""
    for df in frames:
        for file in df.inputFiles()[:1]:
            at, files = _path(df.sparkSession, file.rsplit("/", 1)[0])
            files.delete(at, True)


def _path(spark, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
