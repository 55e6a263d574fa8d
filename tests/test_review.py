import random

import pytest
from pyspark.sql import functions as F

from cairn.operators import names, review


def one_by_one(new, taken):
    held, out = set(taken), {}
    for s, i in sorted(new, key=lambda x: (x[1], x[0])):
        name, k = f"hc_{s}", 0
        while name in held:
            k += 1
            name = f"hc_{s}_{k}"
        held.add(name)
        out[s, i] = name
    return out


@pytest.mark.parametrize("stems, seed", [("a b c d", 1), ("a a_1 a_1_1 a_2 b", 2), ("a a_1 a_2 a_3 a_1_1 a_1_1_1 a_01 a_0 _1", 3)])
def test_free_stems(spark, stems, seed):
    """Random batches are named as one by one, in any order, and no name is given twice or was in use."""
    rng = random.Random(seed)
    for size in (25, 60):
        taken = {f"hc_{rng.choice(stems.split())}" for _ in range(2)} | {f"hc_{rng.choice(stems.split())}_{rng.randrange(6)}" for _ in range(6)}
        new = [(rng.choice(stems.split()), i) for i in rng.sample(range(1000), size)]
        got = names.free_stems(spark.createDataFrame(new, "stem string, ord long"), spark.createDataFrame([(t,) for t in taken], "stem string")).collect()
        found = {(r["stem"], r["ord"]): r["name"] for r in got}
        assert found == one_by_one(new, taken) and len(set(found.values())) == size == len(got)


def test_free_stems_of_two_bases_that_meet(spark):
    new = spark.createDataFrame([("a", 1, "x"), ("a_1", 2, None), (None, 3, "y"), ("a", 4, "z")], "stem string, ord long, name string")
    got = names.free_stems(new, spark.createDataFrame([("hc_a",)], "stem string"))
    assert got.columns == ["stem", "ord", "name", "name_"]
    assert {r["ord"]: r["name_"] for r in got.collect()} == {1: "hc_a_1", 2: "hc_a_1_1", 3: None, 4: "hc_a_2"}
    none = names.free_stems(new.limit(0), new.limit(0).select("stem"))
    assert none.count() == 0


def test_export_takes_the_first_mapped_decision(spark):
    log = spark.createDataFrame([("x.jpg", "civilian", 1), ("x.jpg", " Tank ", 2), ("x.jpg", "a", 3), ("y.jpg", "delete", 4), ("z.jpg", "A", 5), (" ", "t", 6)], "crop_file string, decision string, seq long")
    crops = spark.createDataFrame([("x.jpg", "base", "/base/x.jpg"), ("x.jpg", "tank", "/tank/x.jpg")], "crop_file string, place string, path string")
    got = {r["crop_file"]: (r["cls"], r["path"]) for r in review.export(log, crops, ["crops", "tank", "base"]).collect()}
    assert got == {"x.jpg": (0, "/tank/x.jpg"), "z.jpg": (1, None)}


def test_mining_counts(spark):
    rows = [("v", 15 * k, s, 0.9, "tank", 10.0, 10.0, 10.0 + size, 90.0, 640, 480, 7 if s else k // 4) for k in range(12) for s, size in ((0, 80.0), (1, 20.0))]
    df = spark.createDataFrame(rows, "video string, frame long, seq int, conf double, cls string, x1 double, y1 double, x2 double, y2 double, frame_w int, frame_h int, hash long")
    got = review.summary(review.mine(df, (F.col("cls") == "tank") & (F.col("conf") >= 0.5), bits=0, cooldown=30), ["cls"]).first()
    # frames 0, 15, 30 are one look of hash 0; the one at 45 is past the cooldown: 2 of 4 are saved for each hash
    assert (got["considered"], got["saved"], got["skipped_small"], got["skipped_temporal"], got["reduction"]) == (12, 6, 12, 6, 50.0)


def test_pages(spark):
    got = review.pages(spark.range(7).select(F.col("id")), [F.col("id")], rows=2, cols=2).orderBy("id").collect()
    assert [(r["page"], r["row"], r["col"], r["x0"], r["y0"]) for r in got][:6] == [(0, 0, 0, 4, 4), (0, 0, 1, 136, 4), (0, 1, 0, 4, 136), (0, 1, 1, 136, 136), (1, 0, 0, 4, 4), (1, 0, 1, 136, 4)]
