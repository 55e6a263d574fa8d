"""Mining of a frame stream: detections, temporal deduplication with keyed state, and a sink that writes crops and metadata of each
batch exactly once, so all of a video is there to read as soon as its last frame is done."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from cairn.functions import boxes as B
from cairn.plans.hardcases import METADATA, metadata
from cairn.plans.scratch import drop, stage
from cairn.sources import files, frames
from cairn.sources.named_files import write_files

LOOKS = frames.DETECTIONS + ", frames long, ended boolean"


def look(seen: DataFrame, model: Callable[[], frames.Detector], stride: int, accept: Callable[[int, float], bool] | None = None, least_px: int = 50, resize: int = 128) -> DataFrame:
    """Detections in the frames of ``seen`` (of ``frame_source``, with the same ``stride``), as ``frames.detections`` has them, and for the
    last frame of a video a row without a class that says so (``ended``)."""

    def of(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        detect, columns = model(), [c.split(" ")[0] for c in LOOKS.split(", ")]
        for part in parts:
            rows = []
            for r in part.itertuples(index=False):
                frame = np.frombuffer(r.pixels, np.uint8).reshape(r.high, r.wide, -1)
                rows += [(r.video, r.stem, r.fps, r.frame, *x, r.frames, False) for x in frames.judged(frame, detect, accept, least_px, resize)]
                if r.frame + stride >= r.frames:
                    rows.append((r.video, r.stem, r.fps, r.frame, None, *[None] * 6, r.wide, r.high, None, None, r.frames, True))
            yield pd.DataFrame(rows, columns=columns).astype({"seq": "Int32", "cls": "Int32", "hash": "Int64"})

    return seen.mapInPandas(of, LOOKS)


def mine(looks: DataFrame, least_px: int = 50, bits: int = 10, cooldown: int = 100) -> DataFrame:
    """``looks`` of a stream with a ``status``: small, temporal or saved, as the batch form judges them, or ended.

    State holds the kept hashes of one cooldown for each video, and nothing once the video has ended."""
    if least_px < 0 or bits < 0 or cooldown < 0:
        raise ValueError("least_px, bits and cooldown must be 0 or more")
    x1, y1 = B.clamp(F.col("x1"), F.col("frame_w"), 1), B.clamp(F.col("y1"), F.col("frame_h"), 1)
    x2, y2 = B.clamp(F.col("x2"), F.col("frame_w")), B.clamp(F.col("y2"), F.col("frame_h"))
    cut = looks.withColumns({"x1": x1, "y1": y1, "x2": x2, "y2": y2})
    small = (F.col("x2") - F.col("x1") < least_px) | (F.col("y2") - F.col("y1") < least_px)
    cut = cut.withColumn("status", F.when(F.col("ended"), "ended").when(small, "small").otherwise("saved"))

    def step(key: tuple, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        seen, hashes = state.get if state.exists else ([], [])
        saved, mask = list(zip(seen, hashes)), (1 << 64) - 1
        batch = pd.concat(list(parts)).sort_values(["frame", "seq"], kind="stable", na_position="last").reset_index(drop=True)
        status = batch["status"].tolist()
        for i, (f, h) in enumerate(zip(batch["frame"].tolist(), batch["hash"].tolist())):
            if status[i] != "saved" or pd.isna(h):
                continue
            h = int(h)
            saved = [s for s in saved if f - s[0] <= cooldown]
            if any(((h ^ g) & mask).bit_count() <= bits for _, g in saved):
                status[i] = "temporal"
            else:
                saved.append((f, h))
        if batch["ended"].any():
            state.remove()
        else:
            state.update(([s[0] for s in saved], [s[1] for s in saved]))
        yield batch.assign(status=status)

    return cut.withColumn("hash", F.col("hash")).groupBy("video").applyInPandasWithState(step, T.StructType([*cut.schema.fields]), "frames array<long>, hashes array<long>", "append", "NoTimeout")


class CropSink:
    """Writes a batch to ``out``: crops to ``crops/``, metadata to ``metadata/batch=<number>``, and last ``ledger/batch=<number>`` with the
    videos that ended, which makes the batch count.

    A batch that was broken off anywhere is written again under the same names, and one in the ledger isn't, so nothing is
    there twice or missing for those who read by ``saved`` and ``finished``."""

    def __init__(self, out: str, names: dict[int, str], model_name: str = "model"):
        self.out, self.names, self.model_name = out.rstrip("/"), names, model_name

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark, ledger = batch.sparkSession, f"{self.out}/ledger/batch={number}"
        at, system = files._hadoop(spark, f"{ledger}/_SUCCESS")
        if system.exists(at):
            return
        held = stage(batch)
        crops = metadata(held, self.names, self.model_name)
        self.put_crops(crops.select(F.concat(F.lit("crops/"), "crop_file").alias("path"), F.col("crop").alias("content")))
        self.put_metadata(crops.select(*METADATA), number)
        held.where("status = 'ended'").select("video", "frames").write.mode("overwrite").parquet(ledger)
        drop(held)

    def put_crops(self, rows: DataFrame) -> None:
        write_files(rows, self.out)

    def put_metadata(self, rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.out}/metadata/batch={number}")


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    at, system = files._hadoop(spark, path)
    return spark.read.schema(schema).parquet(path) if system.exists(at) else spark.createDataFrame([], schema)


def finished(spark: SparkSession, out: str) -> DataFrame:
    """``video`` and ``frames`` of the videos whose last frame is done; one that grew later has a row for each end."""
    return _read(spark, f"{out}/ledger", "video string, frames long, batch long").select("video", "frames")


def saved(spark: SparkSession, out: str) -> DataFrame:
    """Metadata of the crops of all batches that count."""
    rows = _read(spark, f"{out}/metadata", files.CROPS + ", batch long")
    base, system = files._hadoop(spark, f"{out}/ledger")
    done = [int(s.getPath().getName().removeprefix("batch=")) for s in (system.listStatus(base) if system.exists(base) else []) if system.exists(files._hadoop(spark, f"{s.getPath()}/_SUCCESS")[0])]
    last = max(done, default=-1)  # batches are run in order, so only one after the last can be half there
    return rows.where(F.col("batch") <= last).select(*METADATA)


def mine_stream(seen: DataFrame, model: Callable[[], frames.Detector], out: str, checkpoint: str, names: dict[int, str], model_name: str = "model", stride: int = 15, accept=None, least_px: int = 50, bits: int = 10, cooldown: int = 100, sink: CropSink | None = None) -> DataStreamWriter:
    """A writer that mines the frame stream ``seen`` into ``out``; start it with any trigger."""
    judged = mine(look(seen, model, stride, accept, least_px), least_px, bits, cooldown)
    return judged.writeStream.foreachBatch(sink or CropSink(out, names, model_name)).outputMode("append").option("checkpointLocation", checkpoint)
