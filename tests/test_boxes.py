import random
import re

import pytest
from pyspark.sql import functions as F

from cairn.functions import boxes as B
from cairn.operators import boxes as O

#: line, class, strictly valid, loosely valid, category or error
LINES = [
    ("5 0.5 0.5725370370370371 1 0.8549444444444445", 5, False, True, "out_of_bounds"),
    ("4 0.3569 0.7839643652561247 0.7138166666666667 0.43207126948775054", 4, False, True, "out_of_bounds"),
    ("1 0.5 0.5 0.2 0.2", 1, True, True, None),
    ("1 0.5 0.5 0 0.2", 1, False, False, "zero_area"),
    ("1 -0.1 0.5 0.1 0.1", 1, False, False, "negative_coordinates"),
    ("1 0.5 0.5 -0.2 0.2", 1, False, False, "zero_area"),
    ("1.9 0.5 0.5 0.2 0.2 extra", 1, True, True, None),
    ("-1.7 0.5 0.5 0.2 0.2", -1, True, True, None),
    ("1 nan 0.5 0.2 0.2", 1, False, False, "out_of_bounds"),
    ("1 0.5 0.5", None, None, None, "too_few_columns"),
    ("a 0.5 0.5 0.2 0.2", None, None, None, "parse_error"),
    ("1 1.0f 0.5 0.2 0.2", None, None, None, "parse_error"),
    ("inf 0.5 0.5 0.2 0.2", None, None, None, "parse_error"),
]


def test_lines(spark):
    df = spark.createDataFrame([(i, x[0]) for i, x in enumerate(LINES)], "i int, line string").select("i", B.parse_line(F.col("line")).alias("b")).select("i", "b.*")
    xywh = [F.col(k) for k in "xywh"]
    got = {r["i"]: r for r in df.select("*", B.strict_valid(*xywh).alias("s"), B.loose_valid(*xywh).alias("l"), B.reject_category(*xywh).alias("k")).collect()}
    for i, (line, cls, strict, loose, kind) in enumerate(LINES):
        r = got[i]
        assert r["cls"] == cls, line
        if cls is None:
            assert r["error"] == kind, line
        else:
            assert (r["s"], r["l"], r["k"]) == (strict, loose, kind), line


@pytest.mark.parametrize("line", ["", "   ", "\t \n"])
def test_blank_lines_are_skipped(spark, line):
    assert spark.createDataFrame([(line,)], "line string").select(B.parse_line(F.col("line"))).first()[0] is None


def test_subtags_overlap(spark):
    r = spark.range(1).select(B.subtags(F.lit(0.1), F.lit(0.5), F.lit(0.4), F.lit(1.5)).alias("t"), B.overflow(F.lit(0.1), F.lit(0.5), F.lit(0.4), F.lit(1.5)).alias("o")).first()
    assert r["t"] == ["width_or_height_exceeds_1", "extends_past_left", "extends_past_top", "extends_past_bottom"]
    assert r["o"]["left"] == pytest.approx(0.1) and r["o"]["right"] == 0 and r["o"]["bottom"] == pytest.approx(0.25)


def test_names_masks_and_clamps(spark):
    r = spark.range(1).select(
        B.type_mask(F.array(*map(F.lit, [0, 2, 3, 3, 5, 9]))).alias("m"),
        B.confidence_from_name(F.lit("v_f000001_d00_c087.jpg")).alias("c"),
        B.confidence_from_name(F.lit("plain.jpg")).alias("n"),
        B.source_of(F.lit("abc_x_1.txt"), ["abc"]).alias("s"),
        B.source_of(F.lit("zz_x.txt"), ["abc"]).alias("u"),
        B.clamp(F.lit(-3.2), F.lit(10), 1).alias("a"),
        B.clamp(F.lit(99.0), F.lit(10), 1).alias("b"),
        B.clamp(F.lit(2.5), F.lit(10)).alias("e"),
    ).first()
    assert (r["m"], r["c"], r["n"], r["s"], r["u"], r["a"], r["b"], r["e"]) == (0b1011, 0.87, None, "abc", "unknown", 0, 9, 2)


@pytest.mark.parametrize("seed", range(3))
def test_percentiles_are_those_of_a_sorted_list(spark, seed):
    """Ties, nan, one row, nulls only, a null group, and a group with most of the rows; nothing at all gives nothing."""
    rng = random.Random(seed)
    rows = [("hot", rng.choice([1.0, 1.0, 2.5, rng.random()])) for _ in range(700)]
    rows += [(g, rng.choice([None, -0.5, 3.0, float("nan")])) for g in ("a", None) for _ in range(rng.randrange(1, 40))]
    rows += [("one", 7.25), ("none", None), ("none", None)]
    df, points = spark.createDataFrame(rows, "g string, v double"), [0, 1, 25, 50, 99, 100]
    want = df.groupBy("g").agg(F.percentile("v", F.array(*[F.lit(p / 100) for p in points])).alias("p"))
    want = {r["g"]: [None] * len(points) if r["p"] is None else [round(x, 9) for x in r["p"]] for r in want.collect()}
    got = {r["g"]: list(r)[1:] for r in O.percentiles(df, F.col("v"), ["g"], points).collect()}
    assert {g: list(map(str, x)) for g, x in got.items()} == {g: list(map(str, x)) for g, x in want.items()}
    assert got["one"] == [7.25] * len(points) and got["none"] == [None] * len(points)
    assert O.percentiles(df.where("v > 10 and not isnan(v)"), F.col("v"), ["g"], points).count() == 0


def test_distribution_deals_by_number_of_boxes(spark, monkeypatch, capsys):
    """Nulls, an image in several splits and one with most of the boxes; no partition is to hold more boxes as the table grows."""
    monkeypatch.setattr(O, "SHARE", 50, raising=False)
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice([0, 1, 2, None]), rng.choice([7, 7, 7, None, rng.randrange(90)])) for _ in range(2000)]
    got = O.distribution(spark.createDataFrame(rows, "split string, cls int, image long"))
    groups = [(s, k, [r for r in rows if r[:2] == (s, k)]) for s, k in {r[:2] for r in rows}]
    groups += [(None, k, [r for r in rows if r[1] == k]) for k in {r[1] for r in rows}]
    want = [(s, k, len(own), len({r[2] for r in own} - {None})) for s, k, own in groups]
    assert sorted(map(repr, want)) == sorted(repr((r["split"], r["cls"], r["instances"], r["images"])) for r in got.collect())
    got.explain()
    assert re.search(r"hashpartitioning\(cls#\w+, image#\w+, 40\)", capsys.readouterr().out)
