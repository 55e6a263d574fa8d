"""Reports on folders of images and label files: small tables, then Markdown, CSV and JSON that the driver writes."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from cairn.functions import boxes as B
from cairn.operators import boxes as O
from cairn.plans.scratch import stage
from cairn.sources import files, sinks

POINTS = [1, 5, 10, 25, 50, 75, 90, 95, 99]
SPLITS = ("train", "val", "test")
TOTAL = "TOTAL"
#: What the tags of a box that sticks out say, for readers of a report.
MEANING = {
    "width_or_height_exceeds_1": "larger than the image", "extends_past_left": "begins left of the image", "extends_past_right": "ends right of it",
    "extends_past_top": "begins above it", "extends_past_bottom": "ends below it",
}


def rows_of(df: DataFrame) -> list[list]:
    """A small aggregate's rows on the driver."""
    return [list(r) for r in df.toLocalIterator()]


def six(value: float | None) -> str:
    """A number to six significant digits; NA if there is none."""
    return "NA" if value is None or math.isnan(value) else f"{value:.6g}"


# --- classes by split ------------------------------------------------------------------------------------------------


def class_counts(lines: DataFrame) -> DataFrame:
    """``split``, ``cls``, ``instances`` and ``images`` of a class-only scan; a file counts once for each class it has."""
    one = lines.where("cls is not null").groupBy("split", "cls", "label_path").agg(F.count("*").alias("n"))
    return one.groupBy("split", "cls").agg(F.sum("n").alias("instances"), F.count("*").alias("images"))


def class_rows(counts: DataFrame, names: list[str] | None, splits: list[str], value: str) -> list[list]:
    """class_id, class_name, split and count: for each class a row for every split, then one in total.

    Classes are those named and those seen; a class without a name has an empty one."""
    held = {(r["cls"], r["split"]): r[value] for r in counts.collect()}  # classes times splits
    classes = sorted({k for k, _ in held} | set(range(len(names or []))))
    name = lambda k: names[k] if names and 0 <= k < len(names) else ""
    return [[k, name(k), s, held.get((k, s), 0) if s != TOTAL else sum(held.get((k, x), 0) for x in splits)] for k in classes for s in [*splits, TOTAL]]


def class_distribution(spark: SparkSession, datasets: dict[str, str], out: str) -> dict:
    """Instances and images of every class of each dataset (name and root), by the first field of label lines: two CSV files a
    dataset and a Markdown report below ``out``."""
    text = ["# Classes by data set", "", "Counted from the first field of every label line. A file adds one to a class's files however many boxes it has of it.", ""]
    seen = {}
    for dataset, root in datasets.items():
        names = files.dataset_names(spark, root, preferred=())
        found = files.discover_splits(spark, root, "labels")
        lines = stage(_in_splits(files.scan_classes(spark, root), spark, root, found))
        labels = _in_splits(files.listing(spark, root, "*.txt").withColumnRenamed("path", "label_path"), spark, root, found)
        per = lines.groupBy("label_path").agg(F.count_if(F.col("cls").isNull()).alias("bad"), F.count("cls").alias("good"))
        health = labels.join(per, "label_path", "left").agg(F.count("*"), F.count_if(F.coalesce("good", F.lit(0)) == 0), F.count_if(F.col("bad") > 0)).first()
        counts, splits = class_counts(lines), [s for _, s in found]
        seen[dataset] = {v: class_rows(counts, names.get("names"), splits, v) for v in ("instances", "images")}
        slug = dataset.lower().replace(" ", "_")
        for value, column in (("instances", "instances"), ("images", "images_with_class")):
            table = sinks.csv_text(["dataset", "class_id", "class_name", "split", column], [[dataset, *r] for r in seen[dataset][value]])
            sinks.write_text(spark, f"{out}/class_distribution_{slug}_{value}.csv", table)
        text += [f"## {dataset}", "", *sinks.table(["label files", "without a box", "with unreadable lines"], [list(health)], 3), ""]
        both = {k: [n, v] for k, n, s, v in seen[dataset]["instances"] if s == TOTAL}
        for k, _, s, v in seen[dataset]["images"]:
            if s == TOTAL:
                both.setdefault(k, ["", 0]).append(v)
        text += [*sinks.table(["id", "name", "boxes", "files"], [[k, *v] for k, v in both.items()], 2), "", f"Read from `{root}`, names from `{names.get('yaml_path')}`.", ""]
    sinks.write_text(spark, f"{out}/class_distribution.md", "\n".join(text) + "\n")
    return seen


def _in_splits(lines: DataFrame, spark: SparkSession, root: str, found: list[tuple[str, str]]) -> DataFrame:
    """Rows whose ``label_path`` lies in the labels folder of a discovered split, with that ``split``; a folder can serve several."""
    base = files._root(spark, root)
    of = F.array_compact(F.array(*[F.when(F.col("label_path").startswith(f"{base}{folder}/labels/"), F.lit(s)) for folder, s in found]).cast("array<string>"))
    return lines.withColumn("split", F.explode(of))


def split_stats(spark: SparkSession, root: str, names: list[str]) -> dict:
    """Of a merged set: images, empty label files and counts by class of each split, and instances by source prefix."""
    lines = stage(files.scan_classes(spark, root).withColumn("split", _merged_split("label_path")))
    labels = files.listing(spark, root, "*.txt").select(F.col("path").alias("label_path"), _merged_split("path").alias("split"))
    full = lines.where("cls is not null").select("label_path").distinct().withColumn("full", F.lit(True))
    sizes = labels.join(full, "label_path", "left").groupBy("split").agg(F.count("*").alias("images"), F.count_if(F.col("full").isNull()).alias("empty"))
    held = {r["split"]: r for r in sizes.collect()}
    counts = {(r["split"], r["cls"]): (r["instances"], r["images"]) for r in class_counts(lines).collect()}
    per = {s: [[i, n, *counts.get((s, i), (0, 0))] for i, n in enumerate(names)] for s in SPLITS}
    return {"images": {s: held[s]["images"] if s in held else 0 for s in SPLITS}, "empty": {s: held[s]["empty"] if s in held else 0 for s in SPLITS}, "classes": per, "lines": lines}


def _merged_split(path: str) -> Column:
    return F.regexp_extract(path, r"/(train|val|test)/labels/[^/]*$", 1)


def merged_distribution(spark: SparkSession, root: str, names: list[str], sources: list[str], out: str) -> list[list]:
    """Of a merged set: split, class_id, class_name, instances, images_with_class, with TOTAL rows that leave images blank, as CSV,
    and a Markdown report that has instances by source too."""
    stats = split_stats(spark, root, names)
    total = [sum(stats["classes"][s][i][2] for s in SPLITS) for i in range(len(names))]
    rows = [[s, *r] for s in SPLITS for r in stats["classes"][s]] + [[TOTAL, i, n, total[i], None] for i, n in enumerate(names)]
    sinks.write_text(spark, f"{out}/merged_class_distribution.csv", sinks.csv_text(["split", "class_id", "class_name", "instances", "images_with_class"], rows))
    by = source_counts(stats["lines"], sources, len(names)).collect()
    text = ["# Boxes of the merged set", "", "## Where they come from", "", *sinks.table(["prefix", *names, "all"], [list(r) for r in by], len(names) + 1), ""]
    for s in SPLITS:
        text += [f"## In `{s}`: {stats['images'][s]} pictures", "", *sinks.table(["id", "name", "boxes", "files"], stats["classes"][s], 2), ""]
    text += [f"## In all {sum(stats['images'].values())} pictures", "", *sinks.table(["id", "name", "boxes"], [[i, n, total[i]] for i, n in enumerate(names)], 1), ""]
    sinks.write_text(spark, f"{out}/merged_class_distribution.md", "\n".join(text) + "\n")
    return rows


def source_counts(lines: DataFrame, sources: list[str], classes: int) -> DataFrame:
    """Instances of each class and in all, by the source that a label's file name begins with."""
    source = B.source_of(F.regexp_extract("label_path", r"([^/]*)$", 1), sources)
    wide = lines.where(F.col("cls").between(0, classes - 1)).groupBy(source.alias("source")).agg(*[F.count_if(F.col("cls") == k).alias(f"c{k}") for k in range(classes)], F.count("*").alias("total"))
    return wide.orderBy("source")


def final_statistics(spark: SparkSession, root: str, names: list[str], out: str) -> dict:
    """Images, empty label files and counts by class of every split of a merged set, and in total, as Markdown."""
    stats = split_stats(spark, root, names)
    total = [[n, sum(stats["classes"][s][i][2] for s in SPLITS)] for i, n in enumerate(names)]
    sizes = [[s, stats["images"][s], stats["empty"][s]] for s in SPLITS]
    text = [f"# The set at `{root}`", "", *sinks.table(["split", "pictures", "labels without a box"], [*sizes, ["all", *[sum(r[i] for r in sizes) for i in (1, 2)]]], 2), ""]
    text += ["## Boxes of each class", "", *sinks.table(["name", "boxes"], total, 1), ""]
    for s in SPLITS:
        text += [f"## Boxes and files in `{s}`", "", *sinks.table(["name", "boxes", "files"], [r[1:] for r in stats["classes"][s]], 2), ""]
    sinks.write_text(spark, f"{out}/final_statistics.md", "\n".join(text) + "\n")
    return {"images": stats["images"], "empty": stats["empty"], "classes": stats["classes"], "total": total}


# --- profile of a source ---------------------------------------------------------------------------------------------


def most_common(counts: DataFrame, key: str, count: str, first: str) -> DataFrame:
    """The most frequent first, among equals the one seen first."""
    return counts.orderBy(F.desc(count), first).select(key, count)


def image_labels(spark: SparkSession, root: str) -> DataFrame:
    """``image``, ``label_path``, ``split`` and whether its label file is ``present``, of every image of a discovered split."""
    found, base = files.discover_splits(spark, root, "both"), files._root(spark, root)
    of = F.array_compact(F.array(*[F.when(F.col("path").startswith(f"{base}{f}/images/"), F.lit(s)) for f, s in found]).cast("array<string>"))
    known = files.listing(spark, root)
    images = known.where(files.extension(F.col("path")).isin("jpg", "jpeg", "png")).select(F.col("path").alias("image"), F.explode(of).alias("split"))
    images = images.withColumn("label_path", B.label_path(F.col("image")))
    labels = known.where(F.col("name").endswith(".txt")).select(F.col("path").alias("label_path"), F.lit(True).alias("present"))
    return images.join(labels, "label_path", "left").withColumn("present", F.coalesce("present", F.lit(False)))


def sample_groups(items: DataFrame, most: int = 5, shown: int = 3) -> list[dict]:
    """The largest groups of ``items`` (``digest``, ``path``) of equal digest: size, the first paths, and how many more there are."""
    sizes = items.groupBy("digest").agg(F.count("*").alias("size"), F.min("path").alias("first")).where("size > 1").orderBy(F.desc("size"), "first").limit(most)
    ranked = items.join(F.broadcast(sizes), "digest").withColumn("k", F.row_number().over(W.partitionBy("digest").orderBy("path"))).where(F.col("k") <= shown)
    rows = ranked.groupBy("digest", "size", "first").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy(F.desc("size"), "first").collect()
    return [{"sha1": r["digest"], "size": r["size"], "paths": r["paths"], "more": max(0, r["size"] - shown)} for r in rows]


def group_totals(items: DataFrame) -> tuple[int, int]:
    """Groups of more than one item of equal ``digest``, and the items in them."""
    r = items.groupBy("digest").count().where("count > 1").agg(F.count("*"), F.coalesce(F.sum("count"), F.lit(0))).first()
    return r[0], r[1]


def profile(spark: SparkSession, dataset: str, root: str, hash_images: bool = False) -> dict:
    """What ``analyze`` says of a dataset, as one document: splits, label health, classes, sizes of boxes, duplicates."""
    images = stage(image_labels(spark, root))
    lines = stage(files.scan_labels(spark, root).join(images.where("present").select("label_path", F.col("split").alias("s")), "label_path").drop("split").withColumnRenamed("s", "split"))
    good = lines.where("error is null")
    xywh = [F.col(k) for k in "xywh"]
    loose = F.coalesce(B.loose_valid(*xywh), F.lit(False))
    per = lines.groupBy("split", "label_path").agg(F.count_if(F.col("error").isNull()).alias("boxes"), F.count_if(F.col("error").isNotNull()).alias("errors"))
    files_of = images.join(per, ["split", "label_path"], "left")
    split = files_of.groupBy("split").agg(
        F.count("*").alias("num_images"), F.count_if("present").alias("num_label_files_present"), F.count_if(~F.col("present")).alias("num_images_missing_label_file"),
        F.count_if(F.col("present") & F.col("boxes").isNull()).alias("num_empty_label_files"), F.coalesce(F.sum("boxes"), F.lit(0)).alias("num_boxes"), F.count_if(F.col("errors") > 0).alias("num_parse_error_files"),
    )
    health = good.agg(F.count_if(F.col("cls") < 0), F.count_if((F.col("cls") >= 0) & ~loose)).first()
    classes = {(r["split"], r["cls"]): r["n"] for r in good.where("cls >= 0").groupBy("split", "cls").agg(F.count("*").alias("n")).collect()}
    fine = good.where((F.col("cls") >= 0) & loose)
    ratio = B.aspect_ratio(F.col("w"), F.col("h"))
    sizes = fine.select(F.lit(1).alias("g"), B.area(F.col("w"), F.col("h")).alias("area"), ratio.alias("aspect"))
    points = {k: (O.percentiles(sizes, F.col(k), ["g"], POINTS).collect() or [[None] * (len(POINTS) + 1)])[0][1:] for k in ("area", "aspect")}
    labels = files.scan_label_files(spark, root).select(F.col("sha1").alias("digest"), F.col("label_path").alias("path"))
    labels = stage(labels.join(images.where("present").select(F.col("label_path").alias("path")).distinct(), "path"))
    splits = {r["split"]: r.asDict() for r in split.orderBy("split").collect()}
    for s, x in splits.items():
        x.pop("split")
        x["class_counts"] = {str(k): n for (q, k), n in sorted(classes.items()) if q == s}
    total = lambda k: sum(x[k] for x in splits.values())
    counts: dict[int, int] = {}
    for (_, k), n in classes.items():
        counts[k] = counts.get(k, 0) + n
    out = {
        "name": dataset, "root": root, "yolo_yaml": files.dataset_names(spark, root), "splits": splits,
        "totals": {k: total(k) for k in ("num_images", "num_label_files_present", "num_images_missing_label_file", "num_boxes")},
        "label_health": {"missing_label_files": total("num_images_missing_label_file"), "empty_label_files": total("num_empty_label_files"), "invalid_boxes": health[1], "negative_class_ids": health[0], "parse_error_lines": lines.where("error is not null").count()},
        "classes": {"observed_class_ids": sorted(counts), "class_counts": {str(k): n for k, n in sorted(counts.items(), key=lambda x: (-x[1], x[0]))}},
        "bbox_percentiles": {k: dict(zip([f"p{p}" for p in POINTS], v)) for k, v in points.items()}, "valid_boxes": fine.count(),
        "duplicates": {"label_groups": group_totals(labels), "largest_label_groups": sample_groups(labels)},
    }
    if hash_images:
        pictures = stage(files.scan_media(spark, root, ("jpg", "jpeg", "png"), digest=True).select(F.col("sha1").alias("digest"), "path"))
        out["duplicates"] |= {"image_groups": group_totals(pictures), "largest_image_groups": sample_groups(pictures)}
    return out


def analysis(spark: SparkSession, datasets: dict[str, str], out: str, hash_images: bool = False) -> list[dict]:
    """The profile of every dataset as JSON and Markdown below ``out``."""
    seen = [profile(spark, n, r, hash_images) for n, r in datasets.items()]
    sinks.write_json(spark, f"{out}/dataset_analysis.json", seen)
    text = ["# Profiles of data sets", ""]
    for x in seen:
        y, h, d, t = x["yolo_yaml"], x["label_health"], x["duplicates"], x["totals"]
        text += [f"## {x['name']}", "", f"At `{x['root']}`; {y.get('nc')} classes by `{y.get('yaml_path')}`: {y.get('names')}.", ""]
        text += [*sinks.table(["split", "pictures", "label files", "boxes"], [*[[s, v["num_images"], v["num_label_files_present"], v["num_boxes"]] for s, v in x["splits"].items()], ["all", t["num_images"], t["num_label_files_present"], t["num_boxes"]]], 3), ""]
        faults = [["pictures without a label file", t["num_images_missing_label_file"]], ["label files without a box", h["empty_label_files"]], ["lines that can't be read", h["parse_error_lines"]], ["boxes of a negative class", h["negative_class_ids"]], ["boxes outside the image or without area", h["invalid_boxes"]]]
        text += ["### Faults", "", *sinks.table(["what", "how many"], faults, 1), ""]
        text += [f"### Classes seen: {len(x['classes']['observed_class_ids'])}", "", *sinks.table(["id", "boxes"], [list(r) for r in x["classes"]["class_counts"].items()], 2), ""]
        rows = [[label, *[six(v) for v in x["bbox_percentiles"][k].values()]] for label, k in (("share of the image", "area"), ("width by height", "aspect"))]
        text += [f"### Sizes of the {x['valid_boxes']} valid boxes, by percentile", "", *sinks.table(["", *map(str, POINTS)], rows, len(POINTS)), "", "### Equal files", ""]
        pictures = d.get("image_groups")
        text += [*sinks.table(["kind", "groups", "files in them"], [["labels", *d["label_groups"]], ["pictures", *(pictures or ("not hashed", ""))]], 2), ""]
        for g in d.get("largest_label_groups", []):
            text.append(f"- {g['size']} equal: " + ", ".join(f"`{p}`" for p in g["paths"]) + (f" and {g['more']} others" if g["more"] else ""))
        text.append("")
    sinks.write_text(spark, f"{out}/dataset_report.md", "\n".join(text) + "\n")
    return seen


# --- invalid boxes -----------------------------------------------------------------------------------------------------


def invalid_boxes(spark: SparkSession, root: str, names: list[str] | None, out: str, shown: int = 8, title: str = "Boxes that cleaning rejects") -> dict:
    """Why boxes of a source fail strict validity, by category, tag and class, with the first examples of each category and the
    files that hold only such boxes or both kinds, as Markdown.  All numbers are counted, none is assumed."""
    lines = stage(files.scan_labels(spark, root, raw=True))
    xywh = [F.col(k) for k in "xywh"]
    good = lines.where("error is null").withColumn("category", B.reject_category(*xywh)).withColumn("tags", B.subtags(*xywh))
    bad = good.where("category is not null")
    count = lambda df, by: {r[by]: r["count"] for r in df.groupBy(by).count().collect()}
    category = count(bad, "category")
    malformed = lines.where("error is not null").withColumn("detail", B.malformed_detail(F.col("error"), F.col("fields")))
    details = count(malformed, "detail")
    tags = count(bad.where("category = 'out_of_bounds'").select(F.explode("tags").alias("tag")), "tag")
    mix = good.groupBy("label_path").agg(F.count("category").alias("bad"), F.count_if(F.col("category").isNull()).alias("good")).where("bad > 0")
    only, mixed = mix.agg(F.count_if(F.col("good") == 0), F.count_if(F.col("good") > 0)).first()
    name = lambda k: names[k] if names and 0 <= k < len(names) else str(k)
    classes = sorted(((name(r["cls"]), r["n"]) for r in bad.groupBy("cls").agg(F.count("*").alias("n")).collect()), key=lambda x: (-x[1], x[0]))
    scanned = files.listing(spark, root, "*.txt").count()
    ranked = bad.withColumn("k", F.row_number().over(W.partitionBy("category").orderBy("label_path", "line_no"))).where(F.col("k") <= shown)
    over = ranked.withColumn("o", B.overflow(*xywh)).withColumn("c", B.corners(*xywh)).orderBy("category", "k").collect()
    total = sum(category.values())
    kinds = ("zero_area", "negative_coordinates", "out_of_bounds")
    sums = [["label files", scanned], ["files that lose all their boxes", only], ["files that keep some", mixed], ["boxes rejected", total], ["lines that can't be read", sum(details.values())]]
    text = [f"# {title}", "", *sinks.table(["what", "how many"], sums, 1), "", "## By class", "", *sinks.table(["class", "boxes"], [list(x) for x in classes], 1), ""]
    text += ["## By reason", "", *sinks.table(["reason", "boxes"], [*[[k, category.get(k, 0)] for k in kinds], *[[f"unreadable, {k}", n] for k, n in sorted(details.items())]], 1), ""]
    text += ["A box out of bounds can have several of these tags:", "", *sinks.table(["tag", "it", "boxes"], [[f"`{k}`", v, tags.get(k, 0)] for k, v in MEANING.items()], 1), ""]
    for k in kinds:
        text += [f"## The first with `{k}`, of {category.get(k, 0)}", ""]
        for r in (r for r in over if r["category"] == k):
            o, c = r["o"], r["c"]
            sides = [[side, f"{c[side]:.6g}", f"{o[side]:.2e}"] for side in ("left", "top", "right", "bottom")]
            text += [f"Line {r['line_no']} of `{r['label_path']}`, class {name(r['cls'])}: `{r['line'].strip()}`" + "".join(f" `{t}`" for t in r["tags"]), "", *sinks.table(["side", "at", "beyond the edge by"], sides, 2), ""]
    sinks.write_text(spark, f"{out}/invalid_boxes.md", "\n".join(text) + "\n")
    return {"scanned": scanned, "category": category, "tags": tags, "classes": classes, "only": only, "mixed": mixed, "malformed": details, "shown": len(over)}


# --- leakage -----------------------------------------------------------------------------------------------------------


def members(items: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """``groups`` (``key`` and its size) with ``place``, their rank by size, and a row for each member of ``items``, in order."""
    place = F.row_number().over(W.orderBy(F.desc("members"), key))  # of groups that lie in several splits: few
    return items.join(groups.withColumn("place", place), key).select("place", "members", key, "split", "name", *[c for c in ("phash",) if c in items.columns])


def leakage_report(spark: SparkSession, root: str, images: DataFrame, exact: DataFrame, near: DataFrame, clusters: DataFrame, bits: int, out: str) -> dict:
    """Markdown of equal and similar images across splits, with every member by split and name.

    ``images`` has ``id``, ``split``, ``sha1`` and ``hash``; ``exact`` and ``near`` the groups found, ``clusters`` each image's leader."""
    named = images.select("id", "split", F.col("sha1").alias("digest"), F.regexp_extract("id", r"([^/]*)$", 1).alias("name"), F.lower(F.lpad(F.hex("hash"), 16, "0")).alias("phash"))
    count = {r["split"]: r["count"] for r in images.groupBy("split").count().collect()}
    groups, in_groups = group_totals(named.select("digest", F.col("id").alias("path")))
    first = members(named.drop("phash"), exact.select("digest", "members"), "digest")
    second = members(named.join(clusters, "id"), near.select("leader", "members"), "leader")
    seen = {"images": count, "groups": groups, "exact": exact.count(), "near": near.count(), "near_files": near.agg(F.coalesce(F.sum("members"), F.lit(0))).first()[0]}
    rows = [[s, count.get("valid" if s == "val" else s, 0)] for s in SPLITS]
    text = ["# Pictures that lie in several splits", "", f"In `{root}`, where {groups} groups of {in_groups} files have equal bytes, whatever their split.", "", *sinks.table(["split", "pictures"], [*rows, ["all", sum(n for _, n in rows)]], 1), ""]
    text += [f"## Equal bytes across splits: {seen['exact']} groups", ""]
    text += _listed(first, "Equal", lambda r: f"`{r['digest'][:12]}`", ["split", "file"]) or ["None.", ""]
    text += [f"## Alike across splits, by at most {bits} of 64 bits: {seen['near']} clusters of {seen['near_files']} files", ""]
    text += _listed(second, "Alike", lambda r: f"{r['members']} files", ["split", "file", "hash"]) or ["None.", ""]
    sinks.write_text(spark, out, "\n".join(text) + "\n")
    return seen


def _listed(rows: DataFrame, word: str, what, header: list[str]) -> list[str]:
    """A table of the members of each group, read group by group."""
    text: list[str] = []
    group: list = []

    def end() -> None:
        if group:
            splits = ", ".join(sorted({r["split"] for r in group}))
            cells = [[r["split"], f"`{r['name']}`", *([f"`{r['phash']}`"] if len(header) > 2 else [])] for r in group]
            text.extend([f"### {word} {group[0]['place']}: {what(group[0])} in {splits}", "", *sinks.table(header, cells), ""])

    for r in rows.orderBy("place", "split", "name").toLocalIterator():
        if group and group[0]["place"] != r["place"]:
            end()
            group = []
        group.append(r)
    end()
    return text
