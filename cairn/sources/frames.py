"""Frames of videos and detections in them, by callables that the caller supplies: this package ships no decoder and no model."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from cairn.functions.images import hash_pixels, png, resized
from cairn.sources import files

#: Opens a video: its frames a second (0 if unknown) and its frames in order, as rows by columns by blue, green and red.
Decoder = Callable[[str], tuple[float, Iterable[np.ndarray]]]
#: What is in a frame: class, confidence, and left, top, right and bottom in pixels, of each detection in the model's order.
Detector = Callable[[np.ndarray], Iterable[tuple[int, float, float, float, float, float]]]

DETECTIONS = (
    "video string, stem string, fps double, frame long, seq int, cls int, conf double, x1 double, y1 double, x2 double, y2 double, "
    "frame_w int, frame_h int, hash long, crop binary"
)


def scan_videos(spark: SparkSession, root: str) -> DataFrame:
    """``path``, ``name`` and ``stem`` of the videos below ``root``, by extension whatever its case."""
    found = files.listing(spark, root)
    return found.where(files.extension(found["path"]).isin(*files.VIDEO_EXTENSIONS)).select("path", "name", files.stem(found["path"]).alias("stem"))


def judged(frame: np.ndarray, detect: Detector, accept: Callable[[int, float], bool] | None, least_px: int, resize: int) -> Iterator[tuple]:
    """What ``accept`` takes of the detections in a frame, from ``seq`` on as in ``DETECTIONS``."""
    high, wide = frame.shape[:2]
    for seq, (cls, conf, x1, y1, x2, y2) in enumerate(detect(frame)):
        if accept is not None and not accept(cls, conf):
            continue
        a, b, c, d = (max(0, min(round(v), m)) for v, m in ((x1, wide - 1), (y1, high - 1), (x2, wide), (y2, high)))
        cut = frame[b:d, a:c] if c - a >= least_px and d - b >= least_px else None
        whole = cut is not None and cut.size > 0
        yield (seq, cls, conf, x1, y1, x2, y2, wide, high, hash_pixels(resized(cut, resize)) if whole else None, png(cut) if whole else None)


def detections(videos: DataFrame, decode: Decoder, model: Callable[[], Detector], stride: int = 15, accept: Callable[[int, float], bool] | None = None, least_px: int = 50, resize: int = 128, hash_size: int = 8) -> DataFrame:
    """Detections of every ``stride``-th frame of ``videos``, a task for a few videos at a time; ``model`` is made once a task.

    Only those that ``accept`` (class and confidence) takes are kept; large enough ones have their crop, as PNG, and its hash.
    A video that can't be decoded has none."""
    if stride < 1 or least_px < 0:
        raise ValueError("stride must be 1 or more, least_px 0 or more")
    if hash_size != 8:
        raise ValueError("hashes are of 64 bits, hash_size 8")

    def of(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        detect = model()
        columns = [c.split(" ")[0] for c in DETECTIONS.split(", ")]
        for name, stem, path in (r for pdf in pdfs for r in pdf[["name", "stem", "path"]].itertuples(index=False)):
            try:
                fps, stream = decode(path)
            except (OSError, ValueError):
                continue
            rows = []
            for at, frame in enumerate(stream):
                if at % stride:
                    continue
                rows += [(name, stem, fps, at, *x) for x in judged(frame, detect, accept, least_px, resize)]
                if len(rows) >= 64:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=columns)

    return videos.select("name", "stem", "path").repartition(max(1, videos.count()), "path").mapInPandas(of, DETECTIONS)
