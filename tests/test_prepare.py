"""Whole programs on small folders, their results worked out by hand or counted anew."""

import json

import numpy as np
import pytest

from cairn import __main__ as programs
from cairn.functions.images import png
from cairn.plans import prepare, reports
from cairn.sources import files, sinks

NAMES = ["a", "b"]


@pytest.fixture(scope="module")
def source(tmp_path_factory):
    rng = np.random.default_rng(4)
    root = tmp_path_factory.mktemp("in")
    for i in range(24):
        split = ("train", "val", "test")[i % 3]
        for kind in ("images", "labels"):
            (root / split / kind).mkdir(parents=True, exist_ok=True)
        if i % 6 != 5:  # every sixth image is nearly the one before, which lies in another split
            image = np.kron(rng.integers(0, 255, (8, 8)), np.ones((8, 8))).astype(np.uint8)
        (root / split / "images" / f"i{i}.png").write_bytes(png(np.clip(image.astype(int) + (i % 6 == 5), 0, 255).astype(np.uint8)))
        lines = ["3 0.5 0.5 0.2 0.2", "4 0.5 0.5 0.25 0.25", "9 0.5 0.5 0.2 0.2", "3 0.9 0.5 0.5 0.2"][: 1 + i % 4]
        (root / split / "labels" / f"i{i}.txt").write_text("" if i == 7 else "\n".join(lines))
    (root / "data.yaml").write_text("nc: 5\nnames: ['p', 'q', \"r|s\", 't', 'u']\n")
    return root


@pytest.fixture(scope="module")
def merged(spark, source, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out") / "set")
    s = prepare.Source("s", str(source), "p", {3: 0, 4: 1}, frozenset({9}))
    return out, s, prepare.prepare(spark, [s], out, NAMES)


def test_leakage(spark, source, tmp_path):
    exact, near = prepare.leakage(spark, str(source), out=str(tmp_path / "leak.md"))
    assert exact.count() == 0 and near.count() == 4
    text = (tmp_path / "leak.md").read_text()
    assert "by at most 8 of 64 bits: 4 clusters of 8 files" in text and "Equal bytes across splits: 0 groups" in text
    assert text.count("### Alike ") == 4 and all(f"`i{k}.png`" in text for k in (4, 5, 10, 11, 16, 17, 22, 23)) and "`i0.png`" not in text


def test_prepare(spark, merged, tmp_path):
    out, _, meta = merged
    k = meta["per_source"]["s"]
    assert (k["pairs_seen"], k["empty_labels_removed"], k["no_boxes_after_remap"], k["duplicates_removed"]) == (24, 1, 0, 4)
    assert k["invalid_boxes_dropped"] == 5 and k["kept_images"] == 19 == sum(meta["images"].values())
    again = files.scan_labels(spark, f"{out}/train").union(files.scan_labels(spark, f"{out}/val")).union(files.scan_labels(spark, f"{out}/test"))
    assert again.where("error is not null").count() == 0
    assert {str(r["cls"]): r["count"] for r in again.groupBy("cls").count().collect()} == meta["merged_instances"] == k["instances"]
    pairs = [(x.split("/")[-3], x.rsplit("/", 1)[1][:-4]) for x in (r["path"] for r in files.listing(spark, out).where("name like '%.png'").collect()) if "_staging" not in x]
    labels = [(r["label_path"].split("/")[-3], r["label_path"].rsplit("/", 1)[1][:-4]) for r in again.select("label_path").distinct().collect()]
    assert sorted(pairs) == sorted(labels) and len(pairs) == 19 and all(s.startswith("p_i") and s[-6:].isdigit() for _, s in pairs)
    assert files.dataset_names(spark, out) == {"yaml_path": f"{out}/data.yaml", "nc": 2, "names": NAMES}
    assert json.loads(spark.read.text(f"{out}/_meta/pipeline_metadata.json", wholetext=True).first()[0]) == json.loads(json.dumps(meta))
    manifest = spark.read.json(f"{out}/_staging/s/manifest").collect()
    assert len(manifest) == 19 and sum(r["instances"] for r in manifest) == sum(k["instances"].values()) and len({r["image"] for r in manifest}) == 19


def test_prepare_again_reuses_staging(spark, merged):
    out, s, meta = merged
    again = prepare.prepare(spark, [s], out, NAMES, only=[])
    assert again["per_source"] == {} and again["images"] == meta["images"] and again["merged_instances"] == meta["merged_instances"]


def test_reports_of_the_merged_set(spark, merged, tmp_path):
    out, _, meta = merged
    rows = reports.merged_distribution(spark, out, NAMES, ["p"], str(tmp_path))
    total = {r[1]: r[3] for r in rows if r[0] == "TOTAL"}
    assert {str(k): n for k, n in total.items()} == meta["merged_instances"] and all(r[4] is None for r in rows if r[0] == "TOTAL")
    text = (tmp_path / "merged_class_distribution.csv").read_text().splitlines()
    assert text[0] == "split,class_id,class_name,instances,images_with_class" and text[-1] == f"TOTAL,1,b,{total[1]}," and len(text) == 9
    assert f"| p | {total[0]} | {total[1]} | {sum(total.values())} |" in (tmp_path / "merged_class_distribution.md").read_text()
    stats = reports.final_statistics(spark, out, NAMES, str(tmp_path))
    assert stats["images"] == meta["images"] and stats["empty"] == {"train": 0, "val": 0, "test": 0} and stats["total"] == [["a", total[0]], ["b", total[1]]]
    assert f"| train | {meta['images']['train']} | 0 |" in (tmp_path / "final_statistics.md").read_text()


def test_class_distribution(spark, source, tmp_path):
    seen = reports.class_distribution(spark, {"My Set": str(source)}, str(tmp_path))["My Set"]
    rows = (tmp_path / "class_distribution_my_set_instances.csv").read_text().splitlines()
    assert rows[0] == "dataset,class_id,class_name,split,instances" and rows[-1] == "My Set,9,,TOTAL,11"
    count = lambda k: sum(1 + i % 4 > k for i in range(24) if i != 7)
    total = {r[0]: r[3] for r in seen["instances"] if r[2] == "TOTAL"}
    assert total == {0: 0, 1: 0, 2: 0, 3: count(0) + count(3), 4: count(1), 9: count(2)}
    assert {r[0]: r[3] for r in seen["images"] if r[2] == "TOTAL"}[3] == 23
    text = (tmp_path / "class_distribution.md").read_text()
    assert "| 24 | 1 | 0 |" in text and "| 2 | r\\|s | 0 | 0 |" in text


def test_analysis(spark, source, tmp_path):
    (x,) = reports.analysis(spark, {"My Set": str(source)}, str(tmp_path), hash_images=True)
    assert x["totals"] == {"num_images": 24, "num_label_files_present": 24, "num_images_missing_label_file": 0, "num_boxes": 56}
    assert x["label_health"] == {"missing_label_files": 0, "empty_label_files": 1, "invalid_boxes": 0, "negative_class_ids": 0, "parse_error_lines": 0}
    assert list(x["classes"]["class_counts"]) == ["3", "4", "9"] and x["splits"]["valid"]["num_images"] == 8 and x["yolo_yaml"]["nc"] == 5
    assert x["duplicates"]["label_groups"] == (4, 23) and x["duplicates"]["image_groups"] == (0, 0)
    groups = x["duplicates"]["largest_label_groups"]
    assert [g["size"] for g in groups] == [6, 6, 6, 5] and all(len(g["paths"]) == 3 and g["more"] == g["size"] - 3 for g in groups)
    assert json.loads((tmp_path / "dataset_analysis.json").read_text())[0]["valid_boxes"] == 56
    assert "| share of the image | 0.04 |" in (tmp_path / "dataset_report.md").read_text()


def test_invalid_boxes(spark, tmp_path):
    (tmp_path / "labels").mkdir()
    (tmp_path / "labels" / "a.txt").write_text("0 0.5 0.5 0.2 0.2\n1 0.95 0.5 0.2 0.2\n0 0.5 0.5\n")
    (tmp_path / "labels" / "b.txt").write_text("1 0.5 0.5 1.5 0.2\n1 0.5 0.5 0 0.2\nx 1 1 1 1\n")
    (tmp_path / "labels" / "c.txt").write_text("2 0.05 -0.1 0.2 0.2")
    got = reports.invalid_boxes(spark, str(tmp_path), ["p", "q"], str(tmp_path), shown=1)
    assert got["category"] == {"out_of_bounds": 2, "zero_area": 1, "negative_coordinates": 1} and (got["only"], got["mixed"], got["scanned"]) == (2, 1, 3)
    assert got["tags"] == {"extends_past_right": 2, "extends_past_left": 1, "width_or_height_exceeds_1": 1}
    assert got["classes"] == [("q", 3), ("2", 1)] and got["malformed"] == {"too_few_fields (3)": 1, "parse_error": 1} and got["shown"] == 3
    text = (tmp_path / "invalid_boxes.md").read_text()
    assert "class q: `1 0.95 0.5 0.2 0.2` `extends_past_right`" in text and "| right | 1.05 | 5.00e-02 |" in text and "| `extends_past_right` | ends right of it | 2 |" in text


@pytest.mark.parametrize("folders, rule, want", [
    ({"train": {"images", "labels"}, "valid": {"images", "labels"}, "val": {"images", "labels"}}, "both", [("train", "train"), ("val", "valid")]),
    ({"train": {"images", "labels"}, "valid": {"labels"}}, "both", [("train", "train")]),
    ({"train": {"labels"}, "test": {"labels"}}, "labels", [("test", "test"), ("train", "train")]),
    ({"X-trainval": {"images", "labels"}}, "both", [("X-trainval", "train"), ("X-trainval", "valid")]),
    ({"X-trainval": {"images", "labels"}}, "labels", [("X-trainval", "train")]),
    ({"A-train": {"images", "labels"}, "train": {"images", "labels"}}, "both", [("train", "train")]),
    ({"A-train": {"images", "labels"}, "train": {"images", "labels"}, "other": {"images", "labels"}}, "all", [("A-train", "train"), ("train", "train")]),
])
def test_split_rules(folders, rule, want):
    assert files.folder_splits(folders, rule) == want


def test_names_files(spark, tmp_path):
    for name, text in (("z.yml", "names: [z]\n"), ("b.yaml", "names:\n  - 'one'\n  - two\n"), ("empty.yaml", "path: x\n"), ("dataset.yaml", "nc: 3\n")):
        (tmp_path / name).write_text(text)
    assert files.dataset_names(spark, str(tmp_path)) == {"yaml_path": str(tmp_path / "dataset.yaml"), "nc": 3, "names": None}
    assert files.dataset_names(spark, str(tmp_path), preferred=())["names"] == ["one", "two"]
    assert files.parse_names("names: []\n") == {"nc": None, "names": []} and files.parse_names("names:\n  0: 'a'\n  1: b\n")["names"] == ["a", "b"]


def test_listing_has_empty_files(spark, tmp_path):
    for name in ("a/x.txt", "a/b/c/y.txt", "top.txt", "a/z.jpg", "sp ace/ü+%.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("")
    got = sorted(r["path"] for r in files.listing(spark, str(tmp_path), "*.txt").collect())
    assert got == sorted(str(tmp_path / n) for n in ("a/x.txt", "a/b/c/y.txt", "top.txt", "sp ace/ü+%.txt"))
    assert files.listing(spark, str(tmp_path), recursive=False).count() == 1


def test_numbers_are_rounded_by_their_exact_value(spark):
    values = [0.1234565, 0.1234575, 0.5, 1e-7, 2.5e-7, 0.9999995]
    got = spark.createDataFrame([(v,) for v in values], "v double").select(sinks.six_places(prepare.F.col("v"))).collect()
    assert [r[0] for r in got] == [f"{v:.6f}" for v in values] and got[0][0] == "0.123456"


def test_markdown_has_all_rows(spark):
    text = sinks.markdown("t", spark.range(1500).select(prepare.F.format_string("%04d|", "id").alias("a|b")))
    assert text.count("\n") == 1505 - 1 and "| 1499\\| |" in text and text.index("| 0000") < text.index("| 0700")


def test_programs(spark, source, tmp_path, capsys):
    config = tmp_path / "c.json"
    config.write_text(json.dumps({"names": NAMES, "sources": [{"name": "s", "root": str(source), "prefix": "p", "mapping": {"3": 0, "4": 1}, "drop": [9]}]}))
    assert programs.main(["run_prepare_pipeline", str(config), str(tmp_path / "o"), "--skip", "s"]) == 1
    assert programs.main(["class_distribution", "nothing"]) == 2
    assert "ERROR: no source is left" in (err := capsys.readouterr().err) and "NAME=ROOT" in err
    assert programs.main(["class_distribution", f"S={source}", "--out-dir", str(tmp_path)]) == 0
    assert json.loads(capsys.readouterr().out) == {"S": 24}
