"""The committing file sink: whole sets, failures, crashes in the middle, equal paths."""

import json
import shutil

import pytest
from pyspark.sql import functions as F

from cairn.sources import named_files
from cairn.sources.named_files import recover, write_files


def held(folder):
    return {str(p.relative_to(folder)): p.read_text() for p in folder.rglob("*") if p.is_file() and not p.name.endswith(".crc")}


def frame(spark, files):
    return spark.createDataFrame([(k, v.encode()) for k, v in files.items()], "path string, content binary").repartition(3)


def failing(spark, files):
    """Files of which one can't be read, after others are written."""
    bad = F.when(F.col("path") == max(files), F.raise_error(F.lit("broken picture"))).otherwise(F.col("content"))
    return frame(spark, files).coalesce(1).sortWithinPartitions("path").withColumn("content", bad)


def test_replaces_whole_folders(spark, tmp_path):
    write_files(frame(spark, {"train/images/a.png": "1", "train/images/b.png": "2", "val/images/c.png": "3", "other/x": "4"}), str(tmp_path))
    write_files(frame(spark, {"train/images/b.png": "5", "val/labels/c.txt": "6"}), str(tmp_path), replaced=["train/images", "val/images", "val/labels"])
    assert held(tmp_path) == {"train/images/b.png": "5", "val/labels/c.txt": "6", "other/x": "4"}


def test_a_failed_job_leaves_the_old_set(spark, tmp_path):
    old = {"images/a.png": "1", "labels/a.txt": "2"}
    write_files(frame(spark, old), str(tmp_path), replaced=["images", "labels"])
    with pytest.raises(Exception, match="broken picture"):
        write_files(failing(spark, {"images/b.png": "3", "labels/b.txt": "4"}), str(tmp_path), replaced=["images", "labels"])
    assert held(tmp_path) == old
    with pytest.raises(Exception, match="broken picture"):
        write_files(failing(spark, {"images/b.png": "3", "labels/b.txt": "4"}), str(tmp_path))
    assert held(tmp_path) == old


def test_equal_paths_are_an_error(spark, tmp_path):
    rows = frame(spark, {"a": "1"}).union(frame(spark, {"a": "2", "b": "3"}))
    with pytest.raises(ValueError, match="'a'"):
        write_files(rows, str(tmp_path))
    assert held(tmp_path) == {}


@pytest.mark.parametrize("steps", range(5))
def test_a_crash_while_committing(spark, tmp_path, monkeypatch, steps):
    """The driver dies after some steps of the commit; the next use of the folder finishes it, or takes it back before its record."""
    old, new = {"images/a.png": "1", "labels/a.txt": "2"}, {"images/b.png": "3", "labels/b.txt": "4"}
    for k, v in old.items():
        (tmp_path / k).parent.mkdir(exist_ok=True)
        (tmp_path / k).write_text(v)
    for k, v in new.items():
        (tmp_path / ".new-j" / k).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / ".new-j" / k).write_text(v)
    if steps:
        (tmp_path / ".commit-j").write_text(json.dumps({"images": True, "labels": True}))
    moves = [("images", ".old-j/images"), (".new-j/images", "images"), ("labels", ".old-j/labels")]
    for a, b in moves[: max(0, steps - 1)]:
        (tmp_path / b).parent.mkdir(exist_ok=True)
        shutil.move(tmp_path / a, tmp_path / b)
    recover(str(tmp_path))
    assert held(tmp_path) == (new if steps else old)


def test_a_crash_while_adding(spark, tmp_path):
    """Files that tasks of a dead job have moved are known by their lists and go."""
    (tmp_path / ".new-j").mkdir()
    (tmp_path / ".new-j" / ".made-7").write_text(json.dumps(["images/b.png", "images/never.png"]))
    (tmp_path / "images").mkdir()
    (tmp_path / "images" / "a.png").write_text("1")
    (tmp_path / "images" / "b.png").write_text("2")
    named_files.recover(str(tmp_path))
    assert held(tmp_path) == {"images/a.png": "1"}
