"""Frames of videos as a Spark source, batch and streaming.  A stream's offset is the number of frames read of each video; partitions
are ranges of frames of one video, so a long video is read by many tasks, and after a failure Spark reads the same ranges again."""

from __future__ import annotations

import json
import posixpath
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import islice
from typing import Protocol

import numpy as np
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from cairn.sources import files

FRAMES = "video string, stem string, path string, fps double, frame long, frames long, high int, wide int, pixels binary"


class Video(Protocol):
    """An open video; ``read`` goes to ``first`` and hands over every ``step``-th frame before ``last`` only."""

    fps: float
    frames: int

    def read(self, first: int, last: int, step: int) -> Iterable[np.ndarray]: ...


def in_order(decode: Callable[[str], tuple[float, Iterable[np.ndarray]]]) -> Callable[[str], Video]:
    """Opens videos by a decoder that can only go through them from the start; it is asked twice, once to count."""

    class _InOrder:
        def __init__(self, path: str):
            self.path = path
            self.fps, stream = decode(path)
            self.frames = sum(1 for _ in stream)

        def read(self, first: int, last: int, step: int) -> Iterator[np.ndarray]:
            return islice(decode(self.path)[1], first, last, step)

    return _InOrder


@dataclass
class FrameRange(InputPartition):
    path: str
    first: int
    last: int


class _Reader:
    def __init__(self, open_video: Callable[[str], Video], options):
        self.open_video, self.root = open_video, options["path"]
        self.stride, self.span = int(options.get("stride", 1)), int(options.get("span", 1000))
        if self.stride < 1 or self.span < 1:
            raise ValueError("stride and span must be 1 or more")

    def lengths(self) -> dict[str, int]:
        """Frames of each video below the folder, by path; those that can't be opened have none."""
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(self.root) if "://" in self.root else (fs.LocalFileSystem(), self.root)
        lead = self.root[: len(self.root) - len(base)] if self.root.endswith(base) else ""
        found = system.get_file_info(fs.FileSelector(base, allow_not_found=True, recursive=True))
        paths = sorted(lead + x.path for x in found if x.type == fs.FileType.File and x.extension.lower() in files.VIDEO_EXTENSIONS)
        return {p: self.length(p) for p in paths}

    def length(self, path: str) -> int:
        try:
            return self.open_video(path).frames
        except (OSError, ValueError):
            return 0

    def ranges(self, start: dict[str, int], end: dict[str, int]) -> list[FrameRange]:
        """Ranges of at most ``span`` frames that are handed over, beginning at one of them."""
        out, long = [], self.span * self.stride
        for path, last in sorted(end.items()):
            first = -(-start.get(path, 0) // self.stride) * self.stride
            out += [FrameRange(path, at, min(at + long, last)) for at in range(first, last, long)]
        return out

    def rows(self, part: FrameRange) -> Iterator[tuple]:
        video, name = self.open_video(part.path), posixpath.basename(part.path)
        for at, frame in zip(range(part.first, part.last, self.stride), video.read(part.first, part.last, self.stride)):
            yield (name, name.rsplit(".", 1)[0], part.path, float(video.fps), at, video.frames, *frame.shape[:2], frame.tobytes())


class _Batch(_Reader, DataSourceReader):
    def partitions(self) -> list[FrameRange]:
        return self.ranges({}, self.lengths())

    def read(self, partition: FrameRange) -> Iterator[tuple]:
        return self.rows(partition)


class _Stream(_Reader, DataSourceStreamReader):
    """``max_frames`` bounds what a batch takes of each video; the place that planning has come to is noted in ``progress``, a file
    beside the checkpoint, since Spark doesn't tell a restarted reader.  The note is written before a batch that is planned is run,
    so it is never behind one that Spark has recorded and planned."""

    def __init__(self, open_video: Callable[[str], Video], options):
        super().__init__(open_video, options)
        self.most, self.progress = int(options.get("max_frames", 0)), options.get("progress")
        if self.most and not self.progress:
            raise ValueError("max_frames asks for a progress file")
        self.planned: dict[str, int] = self.noted()

    def noted(self) -> dict[str, int]:
        if not self.most:
            return {}
        system, path = self.place()
        if system.get_file_info(path).type.name == "NotFound":
            return {}
        with system.open_input_stream(path) as held:
            return json.loads(held.read())

    def place(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.progress) if "://" in self.progress else (fs.LocalFileSystem(), self.progress)

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        now, before = self.lengths(), self.planned
        return {p: max(before.get(p, 0), min(now.get(p, 0), before.get(p, 0) + self.most) if self.most else now.get(p, 0)) for p in sorted({*now, *before})}

    def partitions(self, start: dict, end: dict) -> list[FrameRange]:
        self.planned = {p: max(n, self.planned.get(p, 0)) for p, n in end.items()}
        if self.most:
            system, path = self.place()
            system.create_dir(posixpath.dirname(path), recursive=True)
            with system.open_output_stream(path + ".new") as out:
                out.write(json.dumps(self.planned).encode())
            system.move(path + ".new", path)
        return self.ranges(start, end)

    def read(self, partition: FrameRange) -> Iterator[tuple]:
        return self.rows(partition)


def frame_source(open_video: Callable[[str], Video], name: str = "video_frames") -> type[DataSource]:
    """A source to register: ``spark.dataSource.register(frame_source(open_video))``, then ``spark.read`` or ``spark.readStream`` with
    ``.format("video_frames").option("stride", 15).load(folder)``.  Every ``stride``-th frame of the videos below the folder, with its
    pixels as bytes of rows, columns and channels; ``span`` is how many of them a task reads; for ``max_frames`` see the stream."""

    class VideoFrames(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return FRAMES

        def reader(self, schema) -> DataSourceReader:
            return _Batch(open_video, self.options)

        def streamReader(self, schema) -> DataSourceStreamReader:
            return _Stream(open_video, self.options)

    return VideoFrames
