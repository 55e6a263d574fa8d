"""Order, snapshots and what failed jobs leave of a review log."""

import random

import pytest

from cairn.plans import hardcases as H
from cairn.sources import files, review_log


def strokes(spark, rows, parts=3):
    df = spark.createDataFrame([(k, c, d, 0.5, "2024-01-01T00:00:00") for k, (c, d) in enumerate(rows)], "stroke long, crop_file string, decision string, confidence double, timestamp string")
    return df.repartition(parts)


def replayed(rows):
    stacks = {}
    for crop, decision in rows:
        stack = stacks.setdefault(crop, [])
        if decision != "undo":
            stack.append(decision)
        elif stack:
            stack.pop()
    return {c: s[-1] for c, s in stacks.items() if s}


def told(spark, log):
    return [(r["crop_file"], r["decision"]) for r in H.read_log(spark, log).orderBy("seq").collect()]


@pytest.mark.parametrize("seed", range(2))
def test_events_of_one_second_are_replayed_in_order(spark, tmp_path, seed):
    rng, log, all_ = random.Random(seed), str(tmp_path / "log"), []
    for k in range(6):
        rows = [(f"c{rng.randrange(4)}", rng.choice(["tank", "delete", "undo"])) for _ in range(rng.randrange(1, 30))]
        assert H.append_events(strokes(spark, rows), log) == k + 1
        all_ += rows
        if k in (2, 4):  # undo goes on behind a snapshot
            assert review_log.compact(spark, log, files.REVIEWS) == k + 1
        if k == 4:
            review_log.tidy(spark, log)
        assert told(spark, log) == all_
    assert {r["crop_file"]: r["decision"] for r in H.current(H.read_log(spark, log)).collect()} == replayed(all_)
    names = sorted(p.name for p in (tmp_path / "log").iterdir() if p.name[0] not in "_.")
    assert names == ["batch-000000000006", "snapshot-000000000005"]


def test_a_claim_without_a_batch_ends_snapshots_before_it(spark, tmp_path):
    log = str(tmp_path / "log")
    H.append_events(strokes(spark, [("a", "tank")]), log)
    assert review_log._claim(spark, log) == 2  # a writer that is still at work, or died
    H.append_events(strokes(spark, [("a", "delete")]), log)
    (tmp_path / "log" / "_new-left").mkdir()
    assert review_log.compact(spark, log, files.REVIEWS) == 1 and review_log.compact(spark, log, files.REVIEWS) is None
    assert told(spark, log) == [("a", "tank"), ("a", "delete")]
    review_log._publish(strokes(spark, [("a", "undo")]), ["stroke"], H.REVIEW, log, "batch-000000000002")
    assert told(spark, log) == [("a", "tank"), ("a", "undo"), ("a", "delete")]


def test_files_of_other_programs_come_first(spark, tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "reviews.csv").write_text("crop_file,decision,confidence,timestamp\nb,tank,0.5,2030-01-01T00:00:00\nb,delete,0.5,2030-01-01T00:00:00\n")
    log = str(tmp_path / "log")
    H.append_events(strokes(spark, [("b", "undo")]), log)
    assert told(spark, log) == [("b", "tank"), ("b", "delete"), ("b", "undo")]
    assert told(spark, f"{log}/reviews.csv") == [("b", "tank"), ("b", "delete")]
    assert H.current(H.read_log(spark, log)).first()["decision"] == "tank"
