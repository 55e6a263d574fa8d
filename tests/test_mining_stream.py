"""The frame source and the mining stream: equal to the batch form, ranges, restarts in the middle, growing and new videos."""

import pytest
from pyspark.errors import StreamingQueryException

from cairn.plans import hardcases as H
from cairn.sources import files, frames
from cairn.sources.frame_stream import _Stream, frame_source, in_order
from cairn.streaming import mining
from tests.test_hardcases import NAMES, SCENES, model


class Stub:
    """A video file of a line of scene numbers; it can be entered anywhere and tells which frames were handed over."""

    fps = 25.0

    def __init__(self, path):
        text = open(path).read()
        if not text.strip("0123456789"):
            self.scenes, self.frames = text, len(text)
            return
        raise OSError(path)

    def read(self, first, last, step):
        return (SCENES[int(k)] for k in self.scenes[first:last:step])


def decode(path):
    video = Stub(path)
    return video.fps, video.read(0, video.frames, 1)


def folder(tmp_path, **videos):
    (tmp_path / "videos" / "deep").mkdir(parents=True, exist_ok=True)
    for name, scenes in videos.items():
        (tmp_path / "videos" / f"{name}.mp4").write_text(scenes)
    (tmp_path / "videos" / "deep" / "x.MKV").write_text("2" * 7)
    (tmp_path / "videos" / "bad.avi").write_text("no video")
    (tmp_path / "videos" / "note.txt").write_text("000")
    return str(tmp_path / "videos")


RULE = H.mining_rule("hardcase_all", NAMES)


@pytest.mark.parametrize("opened", [Stub, in_order(decode)])
def test_batch_equals_detections(spark, tmp_path, opened):
    root = folder(tmp_path, a="0000111122", b="0" * 23)
    spark.dataSource.register(frame_source(opened))
    seen = spark.read.format("video_frames").option("stride", 3).option("span", 2).load(root)
    assert seen.rdd.getNumPartitions() == 2 + 4 + 2
    looks = mining.look(seen, model, 3, RULE)
    want = frames.detections(frames.scan_videos(spark, root), decode, model, 3, RULE)
    assert looks.columns == [*want.columns, "frames", "ended"]
    rows, held = looks.collect(), want.collect()
    assert sorted(repr(tuple(r)[:-2]) for r in rows if not r["ended"]) == sorted(repr(tuple(r)) for r in held) and held
    ends = {r["video"]: r["frame"] for r in rows if r["ended"]}
    assert ends == {"a.mp4": 9, "b.mp4": 21, "x.MKV": 6}


def stream(spark, root, tmp_path, sink, **options):
    spark.dataSource.register(frame_source(Stub))
    seen = spark.readStream.format("video_frames").option("stride", 2).option("span", 2).options(**options).load(root)
    return mining.mine_stream(seen, model, str(tmp_path / "out"), str(tmp_path / "check"), NAMES, "m.pt", 2, RULE, bits=4, cooldown=4, sink=sink).trigger(availableNow=True).start()


def batch(spark, root, tmp_path, k):
    H.mine(spark, root, str(tmp_path / f"batch{k}"), decode, model, NAMES, "m.pt", RULE, stride=2, bits=4, cooldown=4)
    rows = files.read_csv(spark, str(tmp_path / f"batch{k}" / "metadata"), files.CROPS)
    return sorted(tuple(r) for r in rows.select(*H.METADATA).collect()), {p.name: p.read_bytes() for p in (tmp_path / f"batch{k}" / "crops").iterdir()}


def streamed(spark, tmp_path):
    rows = mining.saved(spark, str(tmp_path / "out"))
    return sorted(tuple(r) for r in rows.collect()), {p.name: p.read_bytes() for p in (tmp_path / "out" / "crops").iterdir()}


class Dies(mining.CropSink):
    """A sink that dies once in batch 1 before it writes metadata, and once in batch 2 after that."""

    died = ()

    def put_metadata(self, rows, number):
        if number == 1 and number not in self.died:
            self.died = (1,)
            raise RuntimeError("killed")
        super().put_metadata(rows, number)
        if number == 2 and number not in self.died:
            self.died = (1, 2)
            raise RuntimeError("killed")


def test_restart_in_the_middle(spark, tmp_path):
    """Killed between crops and metadata, and between metadata and ledger; started again, every row is there once."""
    root = folder(tmp_path, a="0000111122", b="01" * 11)
    dies, seen = Dies(str(tmp_path / "out"), NAMES, "m.pt"), []
    pace = {"max_frames": 8, "progress": str(tmp_path / "progress.json")}
    for _ in range(5):  # a start runs one batch; each has a new reader, which knows only what is noted
        try:
            assert stream(spark, root, tmp_path, dies, **pace).awaitTermination(240)
            seen.append((mining.saved(spark, str(tmp_path / "out")).count(), sorted(r["video"] for r in mining.finished(spark, str(tmp_path / "out")).collect())))
        except StreamingQueryException as e:
            assert "killed" in str(e)
            seen.append("killed")
    rows, crops = batch(spark, root, tmp_path, 0)
    assert seen[1] == seen[3] == "killed" and [x[1] for x in seen[::2]] == [["x.MKV"], ["a.mp4", "x.MKV"], ["a.mp4", "b.mp4", "x.MKV"]]
    assert 0 < seen[0][0] < seen[2][0] < len(rows)
    assert streamed(spark, tmp_path) == (rows, crops)


def test_new_and_growing_videos(spark, tmp_path):
    """What is finished can be read before later videos are there; a video that grows goes on where it was."""
    root = folder(tmp_path, a="0000111122")
    sink = mining.CropSink(str(tmp_path / "out"), NAMES, "m.pt")
    assert stream(spark, root, tmp_path, sink).awaitTermination(240)
    assert {r[1] for r in streamed(spark, tmp_path)[0]} == {"a.mp4", "x.MKV"}
    folder(tmp_path, c="2200")
    (tmp_path / "videos" / "deep" / "x.MKV").write_text("2" * 7 + "0" * 6)
    assert stream(spark, root, tmp_path, sink).awaitTermination(240)
    rows, crops = streamed(spark, tmp_path)
    assert {r[1] for r in rows} == {"a.mp4", "c.mp4", "x.MKV"} and len(rows) == len(set(rows)) == len(crops)
    frames_of = {r[2] for r in rows if r[1] == "x.MKV"}
    assert max(frames_of) >= 8 and min(frames_of) == 0


def test_offsets(tmp_path):
    root = folder(tmp_path, a="0" * 10)
    reader = _Stream(Stub, {"path": root, "stride": "4", "span": "1", "max_frames": "6", "progress": str(tmp_path / "p.json")})
    path = f"{root}/a.mp4"
    assert reader.initialOffset() == {} and reader.latestOffset()[path] == 6
    parts = [(p.first, p.last) for p in reader.partitions({}, reader.latestOffset()) if p.path == path]
    assert parts == [(0, 4), (4, 6)]
    again = _Stream(Stub, {"path": root, "stride": "4", "span": "1", "max_frames": "6", "progress": str(tmp_path / "p.json")})
    assert again.latestOffset()[path] == 10
    assert [(p.first, p.last) for p in again.partitions({path: 6}, {path: 10})] == [(8, 10)]
    with pytest.raises(ValueError, match="progress"):
        _Stream(Stub, {"path": root, "max_frames": "6"})
