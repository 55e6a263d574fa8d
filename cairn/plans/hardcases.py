"""The hard-case loop: mine detections, deduplicate crops, lay out pages, review, export, merge.

Files are copied, never moved or deleted: what a step decides is a column, and each step writes to a folder of its own."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from cairn.functions import boxes as B
from cairn.functions.images import _pixels, montage, perceptual_hash, png
from cairn.operators import names as names_of
from cairn.operators import review
from cairn.operators import similarity as S
from cairn.operators import wide as wide_hashes
from cairn.plans.scratch import stage
from cairn.sources import files, frames, review_log
from cairn.sources.named_files import write_files

METADATA = [c.split(" ")[0] for c in files.CROPS.split(", ")]
REVIEW = [c.split(" ")[0] for c in files.REVIEWS.split(", ")]
# The keys of a review, the decisions they stand for and the folders that the crops then belong to.
KEYS = {"t": "tank", "a": "armored_vehicle", "c": "civilian_vehicle", "d": "delete"}
PLACES = {"tank": "hardcase_tank", "armored_vehicle": "hardcase_armored", "delete": "hardcase_deleted"}
EXPORTED = ("tank", "armored_vehicle")


def resolve_class(names: dict[int, str], target: str, override: int | None = None) -> int:
    """The id of a class: ``override``, else that of the first name, in order of ids, equal to ``target`` whatever its case."""
    if override is not None:
        return override
    found = [k for k in sorted(names) if names[k].lower() == target.lower()]
    if not found:
        raise ValueError(f"class {target!r} is not among {names}; give its id")
    return found[0]


def mining_rule(mode: str, names: dict[int, str], target: str = "civilian_vehicle", class_id: int | None = None, conf: float = 0.5, uncertain: tuple[str, ...] = EXPORTED, below: float = 0.6, floor: float = 0.25):
    """What ``civilian`` and ``hardcase_all`` mining take: sure ones of the target, and in the second mode unsure ones of others."""
    if mode not in ("civilian", "hardcase_all"):
        raise ValueError("mode must be civilian or hardcase_all")
    if not 0 <= conf <= 1 or not 0 <= floor < below <= 1:
        raise ValueError("0 <= conf <= 1 and 0 <= floor < below <= 1 are asked for")
    wanted = resolve_class(names, target, class_id)
    others = frozenset(k for k, n in names.items() if n.lower() in uncertain) if mode == "hardcase_all" else frozenset()
    return lambda cls, c: (cls == wanted and c >= conf) or (cls in others and floor <= c < below)


def metadata(mined: DataFrame, names: dict[int, str], model: str) -> DataFrame:
    """Rows of crop metadata of the saved detections, numbered within a frame in the model's order, plus ``crop``."""
    index = F.row_number().over(W.partitionBy("video", "frame").orderBy("seq")) - 1
    known = F.create_map(*[F.lit(v) for kv in sorted(names.items()) for v in kv]) if names else F.create_map().cast("map<int,string>")
    name = F.coalesce(F.try_element_at(known, F.col("cls")), F.col("cls").cast("string"))
    saved = mined.where("status = 'saved'")
    return saved.select(
        B.crop_name(F.col("stem"), F.col("frame"), index, F.col("conf")).alias("crop_file"), "video", F.col("frame").cast("int").alias("frame_index"), B.time_sec(F.col("frame"), F.col("fps")).alias("time_sec"),
        F.col("cls").alias("class_id"), name.alias("class_name"), F.bround("conf", 4).alias("confidence"), "x1", "y1", "x2", "y2", (F.col("x2") - F.col("x1")).alias("box_w"), (F.col("y2") - F.col("y1")).alias("box_h"),
        "frame_w", "frame_h", F.lit(model).alias("model"), "crop",
    )


def mine(spark: SparkSession, videos: str, out: str, decode: frames.Decoder, model, names: dict[int, str], model_name: str = "model", rule=None, stride: int = 15, least_px: int = 50, dedup: str = "standard", bits: int | None = None, cooldown: int | None = None, resize: int = 128) -> dict:
    """Mine all videos below a folder; crops go to ``out/crops`` and their metadata to ``out/metadata``,
    written when all videos are done; ``streaming.mining`` writes as it goes.

    Returns the counters: considered, saved, skipped_small, skipped_temporal, their reduction, saved by class (most first, then
    by name), and whether the other way to deduplicate is worth trying."""
    rule = rule or mining_rule("civilian", names)
    found = stage(frames.detections(frames.scan_videos(spark, videos), decode, model, stride, rule, least_px, resize))
    mined = stage(review.mine(found, F.lit(True), stride, least_px, dedup, bits, cooldown))
    crops = stage(metadata(mined, names, model_name))
    write_files(crops.select(F.concat(F.lit("crops/"), "crop_file").alias("path"), F.col("crop").alias("content")), out)
    crops.select(*METADATA).write.mode("overwrite").csv(f"{out}/metadata", header=True)
    total = review.summary(mined, []).first().asDict()
    total["saved_by_class"] = [(r["class_name"], r["count"]) for r in crops.groupBy("class_name").count().orderBy(F.desc("count"), "class_name").collect()]
    total["try_aggressive"] = dedup == "standard" and total["reduction"] < 60
    return total


# --- crops -------------------------------------------------------------------------------------------------------------


def scan_crops(spark: SparkSession, folder: str, hashed: bool = False, hash_size: int = 8) -> DataFrame:
    """``crop_file``, ``path`` and ``size`` of the crops right in a folder, and their ``hash``, null where they can't be read."""
    found = files.listing(spark, folder, recursive=False)
    crops = found.where(files.extension(F.col("path")).isin(*files.IMAGE_EXTENSIONS)).select(F.col("name").alias("crop_file"), "path", F.col("length").alias("size"))
    if not hashed:
        return crops
    pixels = spark.read.format("image").option("dropInvalid", True).load(folder)
    hashes = pixels.select(F.regexp_extract(F.url_decode(F.regexp_replace("image.origin", r"\+", "%2B")), r"([^/]*)$", 1).alias("crop_file"), perceptual_hash(F.col("image"), size=hash_size).alias("hash"))
    return crops.join(hashes, "crop_file", "left")


def deduplicate(crops: DataFrame, confidences: DataFrame, bits: int = 5, hash_size: int = 8) -> DataFrame:
    """``crops`` (``crop_file``, ``size``, ``hash`` and more) with ``leader`` and ``kept``: of a cluster by hash, in order of names, the
    crop with the highest confidence stays (-1 without one), of equal ones the larger file, then the last by name."""
    items = stage(crops.join(confidences, "crop_file", "left").withColumns({"id": F.col("crop_file"), "ord": F.col("crop_file")}))
    wide = items.withColumnRenamed("hash", "words")
    lead = stage(S.clusters(items, bits) if hash_size == 8 else wide_hashes.clusters(wide, bits, hash_size * hash_size))
    best = items.join(lead, "id").groupBy("leader").agg(F.max(F.struct(F.coalesce("confidence", F.lit(-1.0)), "size", "id")).alias("b")).select(F.col("b.id").alias("best"))
    out = items.join(lead, "id").join(best, F.col("id") == F.col("best"), "left")
    return out.select(*crops.columns, "confidence", "leader", F.col("best").isNotNull().alias("kept"))


def deduplicate_folder(spark: SparkSession, folder: str, metadata_path: str | None, out: str, bits: int = 5, hash_size: int = 8) -> dict:
    """Deduplicate the crops of a folder: ``out/crops`` gets those that stay, ``out/duplicates`` the others, ``out/metadata_dedup`` the
    metadata of those that stay, and ``out/disposition`` what becomes of each."""
    if hash_size < 2:
        raise ValueError("hash_size must be 2 or more")
    crops = stage(scan_crops(spark, folder, hashed=True, hash_size=hash_size))
    table = files.read_csv(spark, metadata_path, files.CROPS) if metadata_path else None
    known = files.confidences(table) if table is not None else spark.createDataFrame([], "crop_file string, confidence double")
    done = stage(deduplicate(crops, known, bits, hash_size))
    action = F.when(F.col("kept"), "keep").otherwise("duplicate")
    done.select("crop_file", "leader", action.alias("disposition")).write.mode("overwrite").csv(f"{out}/disposition", header=True)
    content = files.contents(spark, folder, recursive=False).join(done.select("path", "crop_file", "kept"), "path")
    target = F.concat(F.when(F.col("kept"), F.lit("crops/")).otherwise(F.lit("duplicates/")), "crop_file")
    write_files(content.select(target.alias("path"), "content"), out, replaced=["crops", "duplicates"])
    if table is not None:
        table.join(done.where("kept").select("crop_file"), "crop_file", "left_semi").select(*METADATA).write.mode("overwrite").csv(f"{out}/metadata_dedup", header=True)
    clusters, kept, gone = done.agg(F.countDistinct("leader"), F.count_if("kept"), F.count_if(~F.col("kept"))).first()
    return {"clusters": clusters, "kept": kept, "duplicates": gone}


def crop_order(sort: str) -> list[Column]:
    """``name``, or by confidence, -1 without one: ``conf-asc`` with names rising, ``conf-desc`` with names falling."""
    conf = F.coalesce("confidence", F.lit(-1.0))
    orders = {"name": [F.col("crop_file")], "conf-asc": [conf, F.col("crop_file")], "conf-desc": [F.desc(conf), F.desc("crop_file")]}
    if sort not in orders:
        raise ValueError(f"sort must be one of {sorted(orders)}")
    return orders[sort]


def grid(crops: DataFrame, sort: str = "conf-asc", rows: int = 10, cols: int = 10, cell: int = 128, pad: int = 4, text: int = 16) -> DataFrame:
    """``crops`` with page, row, column, pixel place and ``label`` below: the confidence to two places, else the name's beginning."""
    placed = review.pages(crops, crop_order(sort), rows, cols, cell, pad, text=text)
    return placed.withColumn("label", B.grid_label(F.col("confidence"), F.col("crop_file")))


def write_grid(spark: SparkSession, folder: str, metadata_path: str | None, out: str, sort: str = "conf-asc", rows: int = 10, cols: int = 10, cell: int = 128, pad: int = 4, all_pages: bool = True) -> int:
    """Pages of crops as PNG files ``out/grid_001.png`` and so on (the first alone unless ``all_pages``), and ``out/layout`` with the
    place and label of each crop; returns the number of pages."""
    table = files.confidences(files.read_csv(spark, metadata_path, files.CROPS), None) if metadata_path else spark.createDataFrame([], "crop_file string, confidence double")
    placed = stage(grid(scan_crops(spark, folder).join(table, "crop_file", "left"), sort, rows, cols, cell, pad))
    if not all_pages:
        placed = placed.where("page = 0")
    placed.select("crop_file", "page", "row", "col", "x0", "y0", "label").write.mode("overwrite").csv(f"{out}/layout", header=True)
    pixels = spark.read.format("image").option("dropInvalid", True).load(folder)
    pixels = pixels.select(F.regexp_extract(F.url_decode(F.regexp_replace("image.origin", r"\+", "%2B")), r"([^/]*)$", 1).alias("crop_file"), "image.*")
    wide, high = cols * cell + (cols + 1) * pad, rows * (cell + 16) + (rows + 1) * pad

    def draw(pdf: pd.DataFrame) -> pd.DataFrame:
        whole = [None if pd.isna(r.height) else _pixels(int(r.height), int(r.width), int(r.nChannels), r.data) for r in pdf.itertuples()]
        page = montage(list(zip(pdf["x0"].astype(int), pdf["y0"].astype(int), whole)), wide, high, cell)
        return pd.DataFrame({"path": [f"grid_{int(pdf['page'].iat[0]) + 1:03d}.png"], "content": [png(page)]})

    joined = placed.select("crop_file", "page", "x0", "y0").join(pixels.select("crop_file", "height", "width", "nChannels", "data"), "crop_file", "left")
    write_files(joined.groupBy("page").applyInPandas(draw, "path string, content binary"), out)  # a page's crops a task
    return placed.select("page").distinct().count()


# --- review ------------------------------------------------------------------------------------------------------------


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """A review log, with ``seq`` in the order of appending; what wasn't appended here comes first, by time, then by the file."""
    return review_log.read(spark, path, files.REVIEWS)


def current(log: DataFrame) -> DataFrame:
    """The decision that holds for each crop: the last, ``undo`` events taking back the last standing one of their crop."""
    w = W.partitionBy("crop_file").orderBy("seq")
    undo = F.col("decision") == "undo"
    level = F.sum(F.when(undo, -1).otherwise(1)).over(w)
    depth = F.col("level") - F.least(F.min("level").over(w.rowsBetween(W.unboundedPreceding, 0)), F.lit(0))
    named = log.where("crop_file is not null and crop_file <> ''")
    deep = named.withColumn("level", level).withColumn("depth", depth)
    later = F.min("depth").over(w.rowsBetween(1, W.unboundedFollowing))
    standing = deep.withColumn("later", later).where(~undo & (F.col("later").isNull() | (F.col("later") >= F.col("depth"))))
    return standing.groupBy("crop_file").agg(F.max_by("decision", "seq").alias("decision"), F.max_by("confidence", "seq").alias("confidence"))


def pending(crops: DataFrame, log: DataFrame, metadata_table: DataFrame | None = None) -> DataFrame:
    """Crops without a decision, by name, with the confidence of their metadata, else that in their name."""
    left = crops.join(current(log).select("crop_file"), "crop_file", "left_anti")
    known = files.confidences(metadata_table, None) if metadata_table is not None else None
    left = left.join(known, "crop_file", "left") if known is not None else left.withColumn("confidence", F.lit(None).cast("double"))
    return left.withColumn("confidence", F.coalesce("confidence", B.confidence_from_name(F.col("crop_file")))).orderBy("crop_file")


def events(keys: DataFrame, crops: DataFrame) -> DataFrame:
    """Rows of a review log from key strokes (``crop_file``, ``key``): a decision each, ``undo`` for u, nothing for other keys; with
    the ``place`` that the crop then belongs to, null where it stays, and ``stroke``, which has the order of ``keys``."""
    keys = keys.withColumn("stroke", F.monotonically_increasing_id())
    known = F.create_map(*[F.lit(v) for kv in [*KEYS.items(), ("u", "undo")] for v in kv])
    places = F.create_map(*[F.lit(v) for kv in PLACES.items() for v in kv])
    said = keys.withColumn("decision", F.try_element_at(known, F.lower(F.trim("key")))).where("decision is not null")
    said = said.join(crops.select("crop_file", "confidence"), "crop_file", "left")
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    return said.select("crop_file", "decision", F.bround("confidence", 4).alias("confidence"), stamp.alias("timestamp"), F.try_element_at(places, F.col("decision")).alias("place"), "stroke")


def append_events(rows: DataFrame, path: str) -> int:
    """Add ``events`` to a log, after all that it has; see ``review_log``, also for making one snapshot of many appends."""
    return review_log.append(rows, ["stroke"], REVIEW, path)


def rewrite_log(spark: SparkSession, path: str, out: str) -> None:
    """A log without undone rows: the standing decision of each crop, written anew."""
    now = current(read_log(spark, path)).withColumn("timestamp", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss"))
    now.select(*REVIEW).write.mode("overwrite").csv(out, header=True)


def decision_counts(log: DataFrame) -> dict[str, int]:
    held = {r["decision"]: r["count"] for r in current(log).groupBy("decision").count().collect()}
    return {k: held.get(k, 0) for k in KEYS.values()}


# --- export and merge ----------------------------------------------------------------------------------------------------


def export(spark: SparkSession, log_path: str, places: list[str], out: str) -> dict:
    """Reviewed crops as a data set: the first decision that names a class decides, the crop comes from the first folder of ``places``
    that has it, and its label is one box over the whole image.  Returns the counts, and which crops no folder has."""
    log = stage(read_log(spark, log_path))
    found = None
    for p in places:
        crops = scan_crops(spark, p).select("crop_file", "path", F.lit(p).alias("place"))
        found = crops if found is None else found.union(crops)
    chosen = stage(review.export(log, found, places))
    have = chosen.where("path is not null")
    content = None
    for p in places:
        part = files.contents(spark, p, recursive=False)
        content = part if content is None else content.union(part)
    images = have.join(content, "path").select(F.concat(F.lit("images/"), "crop_file").alias("path"), "content")
    stem = F.regexp_replace("crop_file", r"\.[^.]*$", "")
    label = F.concat(F.col("cls").cast("string"), F.lit(" 0.5 0.5 1.0 1.0\n"))
    labels = have.select(F.concat(F.lit("labels/"), stem, F.lit(".txt")).alias("path"), label.cast("binary").alias("content"))
    write_files(images.union(labels), out, replaced=["images", "labels"])
    count = {r["cls"]: r["count"] for r in have.groupBy("cls").count().collect()}
    named = F.coalesce(F.trim("crop_file"), F.lit("")) != ""
    mapped = F.lower(F.trim(F.coalesce("decision", F.lit("")))).isin(*review.SYNONYMS)
    missing = chosen.where("path is null")
    first = [r["crop_file"] for r in missing.orderBy("crop_file").limit(10).collect()]  # for a message
    gone = missing.count()
    return {"tank": count.get(0, 0), "armored_vehicle": count.get(1, 0), "total": sum(count.values()), "skipped": log.where(named & ~mapped).count(), "missing": gone, "first_missing": first, "more_missing": max(0, gone - 10)}


def merge(spark: SparkSession, exported: str, merged: str, split: str = "train", prefix: str = "hc_") -> dict:
    """Add exported images with their labels to a split of a merged set, under names that no image or label there has.

    Returns how many images were added, their instances by class (0, 1, and others), and how many had no label."""
    images = files.listing(spark, f"{exported}/images", recursive=False)
    images = images.where(files.extension(F.col("path")).isin(*files.IMAGE_EXTENSIONS)).select(F.col("path").alias("image"), "name", files.stem(F.col("path")).alias("stem"), files.extension(F.col("path")).alias("ext"))
    labels = files.listing(spark, f"{exported}/labels", "*.txt", recursive=False).select(F.col("path").alias("label"), files.stem(F.col("path")).alias("stem"))
    both = stage(images.join(labels, "stem", "left"))
    held = files.listing(spark, f"{merged}/{split}/images", recursive=False).union(files.listing(spark, f"{merged}/{split}/labels", recursive=False))
    named = stage(names_of.free_stems(both.where("label is not null").withColumn("ord", F.col("name")), held.select(files.stem(F.col("path")).alias("stem")), prefix))
    text = spark.read.option("pathGlobFilter", "*.txt").format("binaryFile").load(f"{exported}/labels").select(files._path().alias("label"), "content")
    pictures = files.contents(spark, f"{exported}/images", recursive=False).withColumnRenamed("path", "image")
    new_images = named.join(pictures, "image").select(F.concat(F.lit("images/"), F.col("name_"), F.lit("."), "ext").alias("path"), "content")
    new_labels = named.join(text, "label", "left").select(F.concat(F.lit("labels/"), F.col("name_"), F.lit(".txt")).alias("path"), F.coalesce("content", F.lit(b"")).alias("content"))
    write_files(new_images.union(new_labels), f"{merged}/{split}")
    classes = files.scan_classes(spark, f"{exported}/labels", recursive=False).withColumnRenamed("label_path", "label").join(named.select("label"), "label").where("cls is not null")
    a, b, other = classes.agg(F.count_if(F.col("cls") == 0), F.count_if(F.col("cls") == 1), F.count_if(~F.col("cls").isin(0, 1))).first()
    return {"tank": a, "armored_vehicle": b, "other": other, "total": named.count(), "skipped_no_label": both.where("label is null").count()}
