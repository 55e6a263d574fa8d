"""From folders of images and label files to a clean, deduplicated, split training set, and the audits of such folders."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions import boxes as B
from cairn.functions.images import perceptual_hash
from cairn.operators import balance, review
from cairn.operators import boxes as O
from cairn.operators import similarity as S
from cairn.plans import reports
from cairn.plans.queries import stratified
from cairn.plans.scratch import stage
from cairn.sources import files, sinks
from cairn.sources.named_files import write_files


@dataclass(frozen=True)
class Source:
    """A data source: where it lies, its file prefix, its class map, dropped classes, and a subset's size and band if wanted."""

    name: str
    root: str
    prefix: str
    mapping: dict[int, int]
    drop: frozenset[int] = field(default_factory=frozenset)
    target: int | None = None
    low: int = 0
    high: int = 0


def image_hashes(spark: SparkSession, root: str) -> DataFrame:
    """``image_path``, content digest and perceptual hash of every image; the hash is null where it can't be decoded."""
    seen = files.scan_media(spark, root, digest=True).select(F.col("path").alias("image_path"), "split", "sha1")
    pixels = spark.read.format("image").option("recursiveFileLookup", True).option("dropInvalid", True).load(root)
    path = F.url_decode(F.regexp_replace(F.regexp_replace("image.origin", r"^[a-z]+:/+", "/"), r"\+", "%2B"))
    return seen.join(pixels.select(path.alias("image_path"), perceptual_hash(F.col("image")).alias("hash")), "image_path", "left")


def clean(spark: SparkSession, source: Source, bits: int = 8) -> tuple[DataFrame, dict[str, int]]:
    """Boxes kept of a source (``image_path``, ``line_no``, ``cls``, x, y, w, h) and its counters."""
    lines = files.scan_labels(spark, source.root)
    pairs = stage(files.pair(files.scan_label_files(spark, source.root), files.scan_media(spark, source.root)))
    good = lines.where("error is null").join(pairs.select("label_path", "image_path"), "label_path")
    mask = F.bit_or(F.when(F.col("cls").between(2, 5), F.pow(F.lit(2), F.col("cls") - 2).cast("int")).otherwise(0))
    raw = good.groupBy("image_path").agg(F.count("*").alias("raw"), mask.alias("mask"), F.count_if(F.col("cls").isin(*source.drop) if source.drop else F.lit(False)).alias("dropped"))
    kept = O.remap(good, source.mapping, set(source.drop)).where(B.strict_valid(*map(F.col, "xywh")))
    per = kept.groupBy("image_path").agg(F.count("*").alias("n"))
    images = stage(raw.join(per, "image_path", "left").fillna(0, ["n"]).join(image_hashes(spark, source.root).select("image_path", "hash"), "image_path", "left"))
    left = images.where("n > 0").select(F.col("image_path").alias("id"), F.col("image_path").alias("ord"), "hash", "n", "mask", F.col("n").alias("density"))
    best = S.representatives(left, S.clusters(left, bits), F.col("n") + 2.0 * F.bit_count("mask"))
    chosen = left.join(best.select(F.col("keep").alias("id")), "id", "left_semi")
    unique = stage(chosen)
    final = unique
    if source.target is not None:
        ranked = unique.select(F.lit(source.name).alias("g"), "id", "density", F.struct((-F.bit_count("mask")).alias("p"), F.col("id").alias("o")).alias("ord"))
        final = stage(balance.band_subset(ranked, "g", source.target, source.low, source.high).select("id"))
    total = images.agg(F.count("*"), F.count_if(F.col("n") == 0), F.sum(F.col("raw") - F.col("n") - F.col("dropped")), F.count_if(F.col("n") > 0)).first()
    seen, one, many = pairs.count(), unique.count(), final.count()
    counters = {"pairs_seen": seen, "empty_labels_removed": seen - total[0], "no_boxes_after_remap": total[1], "invalid_boxes_dropped": total[2] or 0, "duplicates_removed": total[3] - one, "subset_removed": one - many, "kept_images": many}
    boxes = kept.join(final.select(F.col("id").alias("image_path")), "image_path", "left_semi")
    return boxes.select("image_path", "line_no", "cls", "x", "y", "w", "h"), counters


def write_staging(spark: SparkSession, source: Source, boxes: DataFrame, root: str) -> dict[str, int]:
    """Write the kept images of a source and their labels below ``root/name``, numbered in order of paths, with a manifest.  What
    was there goes when all is written.  Returns instances by class."""
    folder = f"{root}/{source.name}"
    sizes = boxes.groupBy("image_path").agg(F.count("*").alias("instances"))
    ext = files.extension(F.col("image_path"))
    known = F.when(ext.isin(*files.IMAGE_EXTENSIONS), ext).otherwise("jpg")
    stem = F.format_string("%s_%s_%06d", F.lit(source.prefix), files.stem(F.col("image_path")), F.col("_n").cast("long"))
    named = stage(review.ranked(sizes, [F.col("image_path")]).select("image_path", "instances", stem.alias("stem"), known.alias("ext")))
    pictures = files.contents(spark, source.root).withColumnRenamed("path", "image_path")
    image = F.concat("stem", F.lit("."), "ext")
    new = named.join(pictures, "image_path").select(F.concat(F.lit("images/"), image).alias("path"), "content")
    lines = sinks.label_lines(boxes.join(named.select("image_path", "stem"), "image_path").withColumn("split", F.lit("")))
    texts = lines.select(F.concat(F.lit("labels/"), "stem", F.lit(".txt")).alias("path"), F.col("text").cast("binary").alias("content"))
    write_files(new.union(texts), folder, replaced=["images", "labels"])
    manifest = named.select(image.alias("image"), F.concat("stem", F.lit(".txt")).alias("label"), F.col("image_path").alias("source_image"), "instances")
    manifest.write.mode("overwrite").json(f"{folder}/manifest")
    return {str(r["cls"]): r["count"] for r in boxes.groupBy("cls").count().orderBy("cls").collect()}


def write_merged(spark: SparkSession, samples: DataFrame, staging: str, out: str) -> dict[str, int]:
    """Write staged ``samples`` (``split``, ``image_path``, ``label_path``) into ``out/split``; what was there goes when all is written.
    Returns instances by class."""
    pictures = files.contents(spark, staging).withColumnRenamed("path", "image_path")
    texts = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").format("binaryFile").load(staging).select(files._path().alias("label_path"), "content")
    place = lambda kind, column: F.concat_ws("/", "split", F.lit(kind), F.regexp_extract(column, r"([^/]*)$", 1)).alias("path")
    images = samples.join(pictures, "image_path").select(place("images", "image_path"), "content")
    labels = samples.join(texts, "label_path").select(place("labels", "label_path"), "content")
    write_files(images.union(labels), out, replaced=[f"{s}/{k}" for s in reports.SPLITS for k in ("images", "labels")])
    boxes = files.scan_labels(spark, staging).where("error is null").join(samples.select("label_path"), "label_path", "left_semi")
    return {str(r["cls"]): r["count"] for r in boxes.groupBy("cls").count().orderBy("cls").collect()}


def split_samples(spark: SparkSession, staging: str, seed: int = 42) -> DataFrame:
    """Staged samples with their ``split``: 70, 20 and 10 percent of the images of every dominant class, -1 for those without a box."""
    samples = files.staged(spark, staging)
    boxes = files.scan_labels(spark, staging).where("error is null").withColumnRenamed("label_path", "image")
    main = O.dominant_class(boxes, F.col("line_no")).select(F.col("image").alias("label_path"), F.col("cls").alias("stratum"))
    known = samples.join(main, "label_path", "left").withColumn("stratum", F.coalesce("stratum", F.lit(-1)))
    return stratified(known.withColumn("doc_id", F.col("label_path")), "stratum", seed).drop("doc_id")


def prepare(spark: SparkSession, sources: list[Source], out: str, names: list[str], bits: int = 8, seed: int = 42, only: list[str] | None = None) -> dict:
    """Clean every source (or those of ``only``, the others' staging staying as it is), split all that is staged 70/20/10 by dominant
    class, write images, labels, names, reports and counters below ``out``."""
    staging, counters = f"{out}/_staging", {}
    for s in sources:
        if only is None or s.name in only:
            boxes, counters[s.name] = clean(spark, s, bits)
            counters[s.name]["instances"] = write_staging(spark, s, stage(boxes), staging)
    samples = stage(split_samples(spark, staging, seed))
    instances = write_merged(spark, samples, staging, out)
    sinks.write_text(spark, f"{out}/data.yaml", sinks.names_yaml(names, out))
    images = {r["split"]: r["count"] for r in samples.groupBy("split").count().collect()}
    meta = {"staging": staging, "output": out, "seed": seed, "phash_threshold": bits, "per_source": counters, "merged_instances": instances, "images": images}
    sinks.write_json(spark, f"{out}/_meta/pipeline_metadata.json", meta)
    reports.merged_distribution(spark, out, names, [s.prefix for s in sources], f"{out}/_meta")
    reports.final_statistics(spark, out, names, f"{out}/_meta")
    return meta


def leakage(spark: SparkSession, root: str, bits: int = 8, out: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Groups of equal images and clusters of similar ones that lie in more than one split; with ``out`` a report of their members."""
    images = stage(image_hashes(spark, root))
    order = F.struct(F.when(F.col("split") == "train", 0).when(F.col("split") == "valid", 1).otherwise(2).alias("s"), F.col("image_path").alias("p"))
    items = images.select(F.col("image_path").alias("id"), "split", "sha1", "hash", order.alias("ord"))
    exact = S.duplicate_groups(items, F.col("sha1"), "split").where("splits > 1")
    clusters = stage(S.clusters(items, bits))
    near = S.cross_split(items, clusters)
    if out:
        reports.leakage_report(spark, root, items, exact, near, clusters, bits, out)
    return exact, near
