"""Temporal deduplication of a detection stream: state for each video, the same result as the batch form on ordered input."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

OUT = "video long, frame long, id long, hash long, kept boolean, late boolean"


def deduplicate(stream: DataFrame, bits: int, cooldown: int, stride: int = 1, idle: str | None = None) -> DataFrame:
    """Each detection (``video``, ``frame``, ``id``, ``hash``) with ``kept``: false if one kept within ``cooldown`` frames before it
    is at most ``bits`` bits apart, and ``late``: true if its frame lies before one that an earlier batch had.

    Within a batch frames are put in order.  A late one is held against the kept ones still in memory, on either side, but can't
    undo what was decided.  State holds the kept frames of one cooldown; with ``idle`` (such as ``10 minutes``) that of a video
    without new frames for so long is dropped, so a finished video leaves nothing; one that goes on starts anew."""
    if stride < 1 or bits < 0 or cooldown < 0:
        raise ValueError("stride must be 1 or more, bits and cooldown 0 or more")
    wait = pd.Timedelta(idle) // pd.Timedelta("1ms") if idle else None

    def step(key: tuple, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        frames, hashes, last = state.get if state.exists else ([], [], None)
        saved, rows = list(zip(frames, hashes)), []
        batch = pd.concat(list(parts)).sort_values(["frame", "id"], kind="stable")
        for f, i, h in zip(batch["frame"].tolist(), batch["id"].tolist(), batch["hash"].tolist()):
            late = last is not None and f < last
            if not late:
                last = f
                saved = [s for s in saved if f - s[0] <= cooldown]
            kept = not any(abs(f - e) <= cooldown and ((h ^ g) & ((1 << 64) - 1)).bit_count() <= bits for e, g in saved)
            if kept and last - f <= cooldown:
                saved.append((f, h))
            rows.append((key[0], f, i, h, kept, late))
        state.update(([s[0] for s in saved], [s[1] for s in saved], last))
        if wait is not None:
            state.setTimeoutDuration(wait)
        yield pd.DataFrame(rows, columns=[c.split(" ")[0] for c in OUT.split(", ")])

    chosen = stream.where(F.pmod("frame", F.lit(stride)) == 0).select("video", "frame", "id", "hash")
    timeout = "ProcessingTimeTimeout" if idle else "NoTimeout"
    return chosen.groupBy("video").applyInPandasWithState(step, OUT, "frames array<long>, hashes array<long>, last long", "append", timeout)


def sink(kept: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """A writer that appends the kept detections as Parquet below ``path``, a folder a video."""
    return kept.where("kept").writeStream.format("parquet").partitionBy("video").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
