"""How the driver's tables stand in for annotation data, in Spark and in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Known values of the stand-in: class map of the cleaning stage, dropped classes, splits and final classes.
MAPPING, DROP = {0: 0, 1: 1, 2: 0, 3: 2, 4: 1}, {5}
SPLITS, CLASSES = ["F", "O"], [0, 1, 2]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes from order lines: an order is an image, a line number a class; ``ord`` breaks ties."""
    c = F.col
    return read(spark, sf_dir, "lineitem").select(
        c("l_orderkey").alias("image"),
        (c("l_linenumber") - 1).alias("cls"),
        (c("l_quantity") / 50).alias("x"),
        (c("l_discount") / 0.1).alias("y"),
        c("l_tax").alias("w"),
        (c("l_extendedprice") % 1000 / 10000).alias("h"),
        c("l_returnflag").alias("source"),
        c("l_linestatus").alias("split"),
        F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate").alias("ord"),
    )


BOXES = """boxes AS (SELECT l_orderkey AS image, l_linenumber - 1 AS cls, l_quantity / 50 AS x, l_discount / 0.1 AS y, l_tax AS w,
  (l_extendedprice % 1000) / 10000 AS h, l_returnflag AS source, l_linestatus AS split,
  (l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate) AS ord FROM lineitem)"""
STRICT = """(w > 0 AND h > 0 AND w <= 1 AND h <= 1 AND x >= 0 AND x <= 1 AND y >= 0 AND y <= 1 AND x - w / 2 >= -1e-6 AND x + w / 2 <= 1 + 1e-6
  AND y - h / 2 >= -1e-6 AND y + h / 2 <= 1 + 1e-6)"""
LOOSE = "(x >= 0 AND x <= 1 AND y >= 0 AND y <= 1 AND w > 0 AND w <= 1 AND h > 0 AND h <= 1)"


def hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """64-bit hashes from embeddings: bit i is set where component i is above the median; ``ord`` is the id."""
    e = F.col("embedding")
    s = F.sort_array(e)
    mid = (F.get(s, 31).cast("double") + F.get(s, 32).cast("double")) / 2
    rows = read(spark, sf_dir, "embeddings").where(F.size(e) == 64).select("vec_id", "label", e, mid.alias("mid"))
    bits = [F.when(F.get("embedding", i).cast("double") > F.col("mid"), F.shiftleft(F.lit(1).cast("long"), 63 - i)).otherwise(F.lit(0).cast("long")) for i in range(64)]
    packed = bits[0]
    for b in bits[1:]:
        packed = packed.bitwiseOR(b)
    return rows.select(F.col("vec_id").alias("id"), F.col("vec_id").alias("ord"), "label", packed.alias("hash"), F.when(F.col("vec_id") % 10 < 7, "train").when(F.col("vec_id") % 10 < 9, "val").otherwise("test").alias("split"))


HASHES = """mids AS (SELECT vec_id, label, embedding, (list_sort(embedding)[32]::DOUBLE + list_sort(embedding)[33]::DOUBLE) / 2 AS mid FROM embeddings WHERE len(embedding) = 64),
 hashes AS (SELECT vec_id AS id, label, CASE WHEN vec_id % 10 < 7 THEN 'train' WHEN vec_id % 10 < 9 THEN 'val' ELSE 'test' END AS split,
  list_transform(range(1, 65), lambda i: CASE WHEN embedding[i]::DOUBLE > mid THEN 1 ELSE 0 END) AS bits,
  list_sum(list_transform(range(1, 33), lambda i: CASE WHEN embedding[i]::DOUBLE > mid THEN (1::BIGINT << (32 - i)) ELSE 0 END))::BIGINT AS hi,
  list_sum(list_transform(range(33, 65), lambda i: CASE WHEN embedding[i]::DOUBLE > mid THEN (1::BIGINT << (64 - i)) ELSE 0 END))::BIGINT AS lo FROM mids)"""


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections from events: a user is a video, minutes since the epoch are frames, the type is the class."""
    c = F.col
    return read(spark, sf_dir, "events").select(
        c("user_id").alias("video"),
        F.expr("timestampdiff(MINUTE, timestamp_ntz'1970-01-01 00:00:00', ts)").alias("frame"),
        c("event_id").alias("id"),
        c("event_type").alias("cls"),
        (c("value") / (c("value") + 50)).alias("conf"),
        c("value").alias("value"),
        F.pmod("event_id", F.lit(61)).cast("long").alias("hash"),
    ).withColumn("ord", F.struct("frame", "id"))


DETECTIONS = """dets AS (SELECT user_id AS video, (epoch_us(ts) // 60000000)::BIGINT AS frame, event_id AS id, event_type AS cls, value / (value + 50) AS conf, value,
  (event_id % 61)::BIGINT AS hash FROM events)"""
