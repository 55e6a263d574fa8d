"""Scans of label files, images, class names and crop tables, and the joins that pair labels with images."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.functions import boxes as B

# Extensions in order of priority, and the columns of crop metadata and review logs.
IMAGE_EXTENSIONS = ("jpg", "jpeg", "png", "bmp", "webp")
VIDEO_EXTENSIONS = ("mp4", "avi", "mov", "mkv", "webm", "m4v", "mpg", "mpeg", "wmv", "flv")
CROPS = "crop_file string, video string, frame_index int, time_sec double, class_id int, class_name string, confidence double, x1 int, y1 int, x2 int, y2 int, box_w int, box_h int, frame_w int, frame_h int, model string"
REVIEWS = "crop_file string, decision string, confidence double, timestamp string"


def _plain(uri: Column) -> Column:
    """A file's path without scheme, decoded."""
    return F.url_decode(F.regexp_replace(F.regexp_replace(uri, r"^[a-z]+:/+", "/"), r"\+", "%2B"))


def _path() -> Column:
    return _plain(F.col("_metadata.file_path"))


def stem(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"\.[^.]*$", "")


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([^./]*)$", 1))


def split_of(path: Column) -> Column:
    """train, valid or test by the last such folder of a path, ``val`` counting as ``valid``; else ``all``."""
    found = F.regexp_extract(F.lower(path), r".*/(train|valid|val|test)/", 1)
    return F.when(found == "", "all").otherwise(B.split_name(found))


def listing(spark: SparkSession, root: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """``path``, ``length`` and ``name`` of the files below ``root``, without their content; empty files too, which Spark's readers
    pass over.  Tasks list the folders, one for each folder right below ``root``; nothing comes to the driver.

    Order is the consumer's: sort by ``name`` or ``path``, or group by what follows."""
    at, files = _hadoop(spark, root)
    full = files.makeQualified(at).toString()
    where = re.sub(r"^file:/+", "/", full)

    def walk(deep: bool):
        def of(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            from pyarrow import fs

            for folder in (f for pdf in pdfs for f in pdf["folder"]):
                system, path = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
                prefix = folder[: len(folder) - len(path)] if folder.endswith(path) else ""
                found = system.get_file_info(fs.FileSelector(path, allow_not_found=True, recursive=deep))
                rows = [(prefix + x.path, x.size or 0, x.type == fs.FileType.Directory) for x in found]
                for lo in range(0, len(rows), 10_000):
                    yield pd.DataFrame(rows[lo : lo + 10_000], columns=["path", "length", "folder"])

        return of

    kind = "path string, length long, folder boolean"
    top = spark.createDataFrame([(where,)], "folder string").mapInPandas(walk(False), kind)
    seen = top.where("not folder")
    if recursive:
        seen = seen.union(top.where("folder").select(F.col("path").alias("folder")).repartition(64, "folder").mapInPandas(walk(True), kind).where("not folder"))
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    like = re.escape(pattern).replace(r"\*", ".*").replace(r"\?", ".")
    return seen.select("path", "length", name.alias("name")).where(F.col("name").rlike(f"^{like}$"))


def _hadoop(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


#: How folders directly below a root stand for splits: ``both`` needs images and labels, and ``val`` wins over ``valid``, other
#: folders by what their names contain serve splits not yet found, maybe several; ``labels`` needs labels only and such a folder
#: serves one split; ``all`` takes every folder of either kind.
SPLIT_RULES = ("both", "labels", "all")
STANDARD = ("train", "valid", "val", "test")


def folder_splits(folders: dict[str, set[str]], rule: str) -> list[tuple[str, str]]:
    """(folder, split) by ``rule`` from the folders below a root and the names of the folders in each."""
    if rule not in SPLIT_RULES:
        raise ValueError(f"rule must be one of {SPLIT_RULES}")
    need = {"labels"} if rule == "labels" else {"images", "labels"}
    fit = [f for f in sorted(folders) if need <= folders[f]]
    found: dict[str, str] = {}
    out: list[tuple[str, str]] = []
    for name in STANDARD:
        if name in fit:
            found["valid" if name == "val" else name] = name
            out.append((name, "valid" if name == "val" else name))
    for f in fit:
        low = f.lower()
        hits = [s for s, words in (("train", ("train",)), ("valid", ("val",)), ("test", ("test",))) if any(w in low for w in words)]
        if rule == "all":
            if low not in STANDARD and hits:
                out.append((f, hits[0]))
        else:
            for s in hits if rule == "both" else hits[:1]:
                found.setdefault(s, f)
    return sorted(out) if rule == "all" else sorted((f, s) for s, f in found.items())


def discover_splits(spark: SparkSession, root: str, rule: str = "both") -> list[tuple[str, str]]:
    """(folder, split) below ``root``; the driver gets a row for each folder there."""
    files = listing(spark, root)
    base = F.lit(_root(spark, root))
    parts = F.split(F.substr("path", F.length(base) + 1), "/")
    tops = files.select(F.get(parts, 0).alias("top"), F.when(F.size(parts) > 2, F.get(parts, 1)).alias("kind")).where("kind in ('images', 'labels')")
    return folder_splits({r["top"]: set(r["k"]) for r in tops.groupBy("top").agg(F.collect_set("kind").alias("k")).collect()}, rule)


def _root(spark: SparkSession, root: str) -> str:
    at, files = _hadoop(spark, root)
    return files.makeQualified(at).toUri().getPath().rstrip("/") + "/"


def _texts(spark: SparkSession, root: str, recursive: bool) -> DataFrame:
    return spark.read.option("recursiveFileLookup", recursive).option("pathGlobFilter", "*.txt").text(root, wholetext=True).select(_path().alias("label_path"), "value")


def _lines(files: DataFrame) -> DataFrame:
    return files.select("label_path", split_of(F.col("label_path")).alias("split"), F.posexplode(F.split("value", r"\r\n|\r|\n")).alias("line_no", "line"))


def scan_labels(spark: SparkSession, root: str, recursive: bool = True, raw: bool = False) -> DataFrame:
    """One row for each line that isn't blank: label_path, split, line_no (from 1), cls, x, y, w, h, error and fields, and the
    ``line`` itself if ``raw``."""
    lines = _lines(_texts(spark, root, recursive))
    out = lines.select("label_path", "split", (F.col("line_no") + 1).alias("line_no"), "line", B.parse_line(F.col("line")).alias("b")).where("b is not null")
    return out.select("label_path", "split", "line_no", *(["line"] if raw else []), "b.*")


def scan_classes(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """One row for each line that isn't blank: label_path, split, line_no and ``cls`` by the first field alone, null if that is no number."""
    lines = _lines(_texts(spark, root, recursive)).where(F.size(B.tokens(F.col("line"))) > 0)
    return lines.select("label_path", "split", (F.col("line_no") + 1).alias("line_no"), B.first_class(F.col("line")).alias("cls"))


def scan_label_files(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """Label files with their content hash, size and split; empty files too."""
    files = spark.read.option("recursiveFileLookup", recursive).option("pathGlobFilter", "*.txt").format("binaryFile").load(root)
    read = files.select(_path().alias("label_path"), F.sha1("content").alias("sha1"))
    listed = listing(spark, root, "*.txt", recursive).select(F.col("path").alias("label_path"), "length")
    out = listed.join(read, "label_path", "left").select("label_path", F.coalesce("sha1", F.sha1(F.lit("").cast("binary"))).alias("sha1"), "length")
    return out.withColumn("split", split_of(F.col("label_path")))


def scan_media(spark: SparkSession, root: str, extensions: tuple[str, ...] = IMAGE_EXTENSIONS, digest: bool = False, recursive: bool = True) -> DataFrame:
    """Media files by extension whatever its case: path, split, stem, ext, length, and sha1 if asked for."""
    files = spark.read.option("recursiveFileLookup", recursive).format("binaryFile").load(root)
    path = F.col("path")
    out = files.select(_path().alias("path"), "length", *([F.sha1("content").alias("sha1")] if digest else []))
    return out.where(extension(path).isin(*extensions)).withColumn("split", split_of(path)).withColumn("stem", stem(path)).withColumn("ext", extension(path))


def contents(spark: SparkSession, root: str, extensions: tuple[str, ...] = IMAGE_EXTENSIONS, recursive: bool = True) -> DataFrame:
    """``path`` and ``content`` of media files, for copying."""
    files = spark.read.option("recursiveFileLookup", recursive).format("binaryFile").load(root).select(_path().alias("path"), "content")
    return files.where(extension(F.col("path")).isin(*extensions))


def pair(labels: DataFrame, images: DataFrame) -> DataFrame:
    """Each label file with the image of its split and stem: one right in an ``images`` folder before one further down, then by
    extension priority, then path; labels without one are dropped."""
    rank = F.array_position(F.array(*map(F.lit, IMAGE_EXTENSIONS)), F.col("ext"))
    deep = ~F.col("path").rlike(r"/images/[^/]*$")
    best = images.groupBy("split", "stem").agg(F.min_by("path", F.struct(deep, rank, F.col("path"))).alias("image_path"))
    return labels.dropDuplicates(["label_path"]).withColumn("stem", stem(F.col("label_path"))).join(best, ["split", "stem"])


def staged(spark: SparkSession, root: str) -> DataFrame:
    """``source``, ``label_path``, ``image_path`` and ``stem`` of staged samples: ``root/source/labels/stem.txt`` and its image by
    extension priority; labels without one are dropped."""
    base = F.lit(_root(spark, root))
    source = lambda c: F.split_part(F.substr(c, F.length(base) + 1), F.lit("/"), F.lit(1))
    inside = lambda c, kind: c.rlike(f"/{kind}/[^/]*$")
    labels = listing(spark, root, "*.txt").where(inside(F.col("path"), "labels")).select(source(F.col("path")).alias("source"), F.col("path").alias("label_path"), stem(F.col("path")).alias("stem"))
    images = listing(spark, root).where(inside(F.col("path"), "images")).select(source(F.col("path")).alias("source"), F.col("path").alias("image"), stem(F.col("path")).alias("stem"), extension(F.col("path")).alias("ext"))
    rank = F.array_position(F.array(*map(F.lit, IMAGE_EXTENSIONS)), F.col("ext"))
    best = images.where(rank > 0).groupBy("source", "stem").agg(F.min_by("image", F.struct(rank, F.col("image"))).alias("image_path"))
    return labels.join(best, ["source", "stem"])


# Names files that are looked at first.
NAMES_FILES = ("data.yaml", "dataset.yaml", "visdrone.yaml")


def dataset_names(spark: SparkSession, root: str, preferred: tuple[str, ...] = NAMES_FILES, recursive: bool = False) -> dict:
    """``yaml_path``, ``nc`` and ``names`` from the first YAML file of ``root`` that has any: the ``preferred`` in order, then
    those ending in .yaml, then .yml, by path.  Names are an inline list or a block list; empty if there is no such file."""
    reader = spark.read.option("recursiveFileLookup", recursive).option("pathGlobFilter", "*.y*ml")
    files = reader.text(root, wholetext=True).select(_path().alias("path"), "value").where(r"value rlike '(?m)^\\s*(nc|names):'")
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    first = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, preferred)).cast("array<string>"), name), F.lit(0)), F.lit(len(preferred) + 1))
    row = files.agg(F.min_by(F.struct("path", "value"), F.struct(first, F.when(name.endswith(".yaml"), 0).otherwise(1), F.col("path"))).alias("f")).first()["f"]
    if row is None:
        return {}
    return {"yaml_path": row["path"], **parse_names(row["value"])}


def parse_names(text: str) -> dict:
    """``nc`` and ``names`` of a names file's text, None where they aren't given."""
    plain = lambda x: x[1:-1] if len(x) > 1 and x[0] == x[-1] and x[0] in "'\"" else x
    count = re.search(r"(?m)^\s*nc:[ \t]*(\d+)[ \t]*$", text)
    inline = re.search(r"(?m)^\s*names:[ \t]*\[(.*)\][ \t]*$", text)
    block = re.search(r"(?m)^\s*names:[ \t]*\r?\n((?:[ \t]+(?:-|\d+:).*(?:\r?\n|\Z))+)", text)
    names = None
    if inline:
        names = [plain(x.strip()) for x in inline[1].split(",")] if inline[1].strip() else []
    elif block:
        names = [plain(re.sub(r"^(?:-|\d+:)\s*", "", x.strip())) for x in block[1].splitlines()]
    return {"nc": int(count[1]) if count else None, "names": names}


def class_names(spark: SparkSession, root: str) -> DataFrame:
    """``class_id`` and ``class_name`` of the names file of ``root``, wherever below it lies."""
    names = dataset_names(spark, root, recursive=True).get("names") or []
    return spark.createDataFrame(list(enumerate(names)), "class_id int, class_name string")


def read_csv(spark: SparkSession, path: str | list[str], schema: str, *also: Column) -> DataFrame:
    """A CSV file with a header, by the names of its columns; cells that don't fit their type are null, as are missing columns.
    ``also`` are more columns, of the file's metadata for example."""
    text = spark.read.csv(path, header=True, quote='"', escape='"')
    wanted = T.StructType.fromDDL(schema)
    have = {c.strip(): c for c in text.columns}
    return text.select(*[(F.col(f"`{have[f.name]}`").try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in wanted], *also)


def confidences(metadata: DataFrame, blank: float | None = 0.0) -> DataFrame:
    """``crop_file`` and ``confidence`` of crop metadata, the last row of a crop by ``seq`` if there is one; a blank or unreadable
    confidence is ``blank``.  Crops without a row have none: what then counts is the reader's (-1, or what the name says)."""
    named = metadata.where("crop_file is not null and crop_file <> ''")
    order = F.col("seq") if "seq" in metadata.columns else F.monotonically_increasing_id()
    value = F.coalesce(F.col("confidence"), F.lit(blank).cast("double"))
    return named.select("crop_file", value.alias("confidence"), order.alias("seq")).groupBy("crop_file").agg(F.max_by("confidence", "seq").alias("confidence"))
