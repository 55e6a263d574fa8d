import numpy as np
import pytest
from pyspark.sql import functions as F

from cairn.functions.images import hash_pixels
from cairn.sources import files, sinks


@pytest.fixture
def tree(tmp_path):
    for split, stem, text, ext in (("train", "a", "0 0.5 0.5 0.2 0.2\n\n1 0.5 0.5 9 x\n", "jpg"), ("val", "b", "2 0.25 0.5 0.125 0.5", "PNG"), ("test", "c", "", "txt2"), ("train", "a b", "1 0.5 0.5 0.1 0.1", "png")):
        (tmp_path / split / "labels").mkdir(parents=True, exist_ok=True)
        (tmp_path / split / "images").mkdir(parents=True, exist_ok=True)
        (tmp_path / split / "labels" / f"{stem}.txt").write_text(text)
        (tmp_path / split / "images" / f"{stem}.{ext}").write_bytes(stem.encode())
    (tmp_path / "train" / "images" / "a.png").write_bytes(b"second")
    (tmp_path / "data.yaml").write_text("nc: 2\nnames: ['x', \"y\"]\n")
    return str(tmp_path)


def test_scan_and_pair(spark, tree):
    rows = files.scan_labels(spark, tree).orderBy("split", "label_path", "line_no").collect()
    assert [(r["split"], r["line_no"], r["cls"], r["error"]) for r in rows] == [("train", 1, 1, None), ("train", 1, 0, None), ("train", 3, None, "parse_error"), ("valid", 1, 2, None)]
    pairs = files.pair(files.scan_label_files(spark, tree), files.scan_media(spark, tree, digest=True))
    assert sorted((r["split"], r["stem"], r["image_path"].rsplit("/", 1)[1]) for r in pairs.collect()) == [("train", "a", "a.jpg"), ("train", "a b", "a b.png"), ("valid", "b", "b.PNG")]
    assert [(r[0], r[1]) for r in files.class_names(spark, tree).collect()] == [(0, "x"), (1, "y")]


def test_label_round_trip(spark, tree, tmp_path):
    boxes = files.scan_labels(spark, tree).where("error is null").withColumn("stem", files.stem(F.col("label_path")))
    sinks.write_labels(boxes, str(tmp_path / "out"))
    again = files.scan_labels(spark, str(tmp_path / "out"))
    key = lambda df: sorted(map(tuple, df.select("split", "cls", "x", "y", "w", "h").collect()))
    assert key(again) == key(boxes)


def test_names_yaml_is_read_back(spark, tmp_path):
    (tmp_path / "data.yaml").write_text(sinks.names_yaml(["one", "two", "three"]))
    assert [r[1] for r in files.class_names(spark, str(tmp_path)).collect()] == ["one", "two", "three"]


def test_perceptual_hash_survives_small_changes():
    rng = np.random.default_rng(1)
    image = np.kron(rng.integers(0, 255, (8, 8)), np.ones((20, 20))).astype(np.uint8)
    near, far = np.clip(image.astype(int) + rng.integers(-4, 5, image.shape), 0, 255), np.kron(rng.integers(0, 255, (8, 8)), np.ones((20, 20)))
    apart = lambda a, b: ((hash_pixels(a) ^ hash_pixels(b)) & (2**64 - 1)).bit_count()
    assert apart(image, near) <= 4 < 16 < apart(image, far)
