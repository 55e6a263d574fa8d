"""Mining of hard cases and what follows: counters, review logs, export, collision-free merging, pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from cairn.functions import boxes as B
from cairn.operators import similarity as S
from cairn.plans.scratch import stage

# Words of a review log and the class they export.
SYNONYMS = {"tank": 0, "t": 0, "0": 0, "armored_vehicle": 1, "armored": 1, "a": 1, "1": 1}
#: Bits and frames of the two ways to deduplicate a stream.
MODES = {"standard": (10, 100), "aggressive": (18, 250)}


def mine(detections: DataFrame, accept: Column, stride: int = 15, least_px: int = 50, mode: str = "standard", bits: int | None = None, cooldown: int | None = None) -> DataFrame:
    """Accepted detections of every ``stride``-th frame with a ``status``: small, temporal or saved.

    Needs video, frame, seq (order in the frame), x1..y2 in pixels, frame_w, frame_h and hash; cheap tests come first."""
    if stride < 1 or least_px < 0 or mode not in MODES:
        raise ValueError("stride must be 1 or more, least_px 0 or more, mode standard or aggressive")
    t, wait = (a if a is not None else b for a, b in zip((bits, cooldown), MODES[mode]))
    if t < 0 or wait < 0:
        raise ValueError("bits and cooldown must be 0 or more")
    seen = detections.where((F.pmod("frame", F.lit(stride)) == 0) & accept)
    cut = seen.withColumns({"x1": B.clamp(F.col("x1"), F.col("frame_w"), 1), "y1": B.clamp(F.col("y1"), F.col("frame_h"), 1), "x2": B.clamp(F.col("x2"), F.col("frame_w")), "y2": B.clamp(F.col("y2"), F.col("frame_h"))})
    small = (F.col("x2") - F.col("x1") < least_px) | (F.col("y2") - F.col("y1") < least_px)
    cut = cut.withColumn("_small", small).withColumn("ord", F.struct("frame", "seq"))
    seen_small = cut.where("_small").withColumn("kept", F.lit(None).cast("boolean"))
    judged = S.temporal_kept(cut.where(~F.col("_small")), t, wait).unionByName(seen_small)
    status = F.when(F.col("_small"), "small").when(F.col("kept"), "saved").otherwise("temporal")
    return judged.withColumn("status", status).drop("_small", "kept", "ord")


def summary(mined: DataFrame, by: list[str]) -> DataFrame:
    """Considered (large enough), saved, skipped and reduction in percent by group."""
    n = mined.groupBy(*by).agg(F.count_if(F.col("status") != "small").alias("considered"), F.count_if(F.col("status") == "saved").alias("saved"), F.count_if(F.col("status") == "small").alias("skipped_small"), F.count_if(F.col("status") == "temporal").alias("skipped_temporal"))
    return n.withColumn("reduction", F.coalesce(F.try_divide(F.col("skipped_temporal") * 100.0, F.col("considered")), F.lit(0.0)))


def export(log: DataFrame, crops: DataFrame, places: list[str]) -> DataFrame:
    """The first decision of a crop that names a class, with the crop's file by priority of its folder; ``path`` is null if there is none."""
    classes = F.create_map(*[F.lit(v) for kv in SYNONYMS.items() for v in kv])
    first = log.where(F.trim("crop_file") != "").withColumn("cls", F.try_element_at(classes, F.lower(F.trim("decision")))).where("cls is not null").groupBy("crop_file").agg(F.min_by("cls", "seq").alias("cls"))
    rank = F.array_position(F.array(*map(F.lit, places)), F.col("place"))
    best = crops.where(rank > 0).groupBy("crop_file").agg(F.min_by("path", F.struct(rank, F.col("path"))).alias("path"))
    return first.join(best, "crop_file", "left")


def ranked(rows: DataFrame, order: list[Column], by: list[str] | None = None, parts: int = 200) -> DataFrame:
    """``rows`` with ``_n``, their place from 0 in ``order`` within groups ``by``.

    Without groups rows are dealt to ranges of the order, ranked there, and shifted by what the ranges before hold, so that no
    task sorts all of them."""
    if by:
        return rows.withColumn("_n", F.row_number().over(W.partitionBy(*by).orderBy(*order)) - 1)
    dealt = stage(rows.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("_c"))
    before = sizes.withColumn("_before", F.sum("_c").over(W.orderBy("_part")) - F.col("_c")).select("_part", "_before")  # a row a range
    place = F.row_number().over(W.partitionBy("_part").orderBy(*order)) - 1
    return dealt.withColumn("_k", place).join(F.broadcast(before), "_part").withColumn("_n", F.col("_k") + F.col("_before")).drop("_part", "_k", "_before")


def pages(crops: DataFrame, order: list[Column], rows: int = 10, cols: int = 10, cell: int = 128, pad: int = 4, by: list[str] | None = None, text: int = 0) -> DataFrame:
    """Page, row, column and pixel place of each crop in ``order`` within groups ``by``; ``text`` pixels below each are left free."""
    if rows < 1 or cols < 1:
        raise ValueError("rows and cols must be 1 or more")
    n = ranked(crops, order, by)
    at = n.withColumns({"page": F.floor(F.col("_n") / (rows * cols)), "row": F.floor(F.col("_n") % (rows * cols) / cols), "col": (F.col("_n") % cols).cast("long")})
    return at.withColumns({"x0": F.col("col") * (cell + pad) + pad, "y0": F.col("row") * (cell + text + pad) + pad}).drop("_n")
