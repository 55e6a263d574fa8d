import random
import time

import pytest
from pyspark.sql import functions as F

from cairn.operators import similarity as S
from cairn.streaming.temporal import deduplicate, sink

SCHEMA = "video long, frame long, id long, hash long"


def run(spark, tmp_path, batches, **options):
    """What a stream of one file a batch gives, in order of arrival."""
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in" / f"{k}"))
        time.sleep(0.01)
    stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    name = f"kept{abs(hash(str(tmp_path)))}"
    out = deduplicate(stream, **options).writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / "check"))
    q = out.outputMode("append").trigger(availableNow=True).start()
    assert q.awaitTermination(90)
    return spark.table(name)


def test_stream_equals_batch(spark, tmp_path):
    rng = random.Random(5)
    dets = sorted((rng.randrange(90), rng.randrange(3), rng.randrange(32)) for _ in range(150))
    rows = [(v, f, i, h) for i, (f, v, h) in enumerate(dets)]
    got = run(spark, tmp_path, [[r for r in rows if r[1] // 30 == k] for k in range(3)], bits=1, cooldown=10)
    batch = spark.createDataFrame(rows, SCHEMA).withColumn("ord", F.struct("frame", "id"))
    assert sorted(r["id"] for r in got.where("kept").collect()) == sorted(r["id"] for r in S.temporal_kept(batch, 1, 10).where("kept").collect())
    assert got.count() == len(rows) and got.where("late").count() == 0


def test_late_rows_are_told_and_judged(spark, tmp_path):
    got = run(spark, tmp_path, [[(1, 10, 0, 5), (1, 30, 1, 9)], [(1, 28, 2, 9), (1, 29, 3, 0xFF00), (1, 31, 4, 0xFF00), (1, 1, 5, 9)]], bits=0, cooldown=5)
    assert sorted((r["id"], r["kept"], r["late"]) for r in got.collect()) == [(0, True, False), (1, True, False), (2, False, True), (3, True, True), (4, False, False), (5, True, True)]


def test_sink_and_parameters(spark, tmp_path):
    spark.createDataFrame([(1, 15, 0, 5), (2, 16, 1, 5), (2, 30, 2, 5)], SCHEMA).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    q = sink(deduplicate(stream, 0, 5, stride=15, idle="1 hour"), str(tmp_path / "out"), str(tmp_path / "check")).trigger(once=True).start()
    assert q.awaitTermination(90)
    assert sorted((r["video"], r["id"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [(1, 0), (2, 2)]
    for wrong in ((-1, 0, 1), (0, -1, 1), (0, 0, 0)):
        with pytest.raises(ValueError):
            deduplicate(stream, *wrong)
