"""Cleaning and profiling of box tables (image, line, cls, x, y, w, h, source, split and an order for ties)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from cairn.functions import boxes as B
from cairn.operators.names import running
from cairn.plans.scratch import stage

XYWH = ("x", "y", "w", "h")
#: Boxes of a partition of ``distribution``, and how many make more than one worthwhile.
SHARE, LEAST = 1_200_000, 50_000


def _cols() -> list[Column]:
    return [F.col(c) for c in XYWH]


def remap(boxes: DataFrame, mapping: dict[int, int], drop: set[int]) -> DataFrame:
    """Boxes whose class is in ``mapping`` and not in ``drop``, with the new class; the map is a literal in the plan."""
    table = F.create_map(*[F.lit(v) for kv in sorted(mapping.items()) for v in kv])
    new = F.try_element_at(table, F.col("cls"))
    return boxes.where(~F.col("cls").isin(*drop) if drop else F.lit(True)).withColumn("cls", new).where("cls is not null")


def clean_counters(boxes: DataFrame, mapping: dict[int, int], drop: set[int]) -> DataFrame:
    """By source: images seen, boxes, kept, dropped by class, dropped for other reasons, images left without a box."""
    kept = F.coalesce(F.col("cls").isin(*mapping) & ~F.col("cls").isin(*drop) & B.strict_valid(*_cols()), F.lit(False))
    per = boxes.groupBy("source", "image").agg(F.count("*").alias("raw"), F.count_if(kept).alias("kept"), F.count_if(F.col("cls").isin(*drop)).alias("dropped"))
    return per.groupBy("source").agg(
        F.count("*").alias("images"),
        F.sum("raw").alias("raw_boxes"),
        F.sum("kept").alias("kept_boxes"),
        F.sum("dropped").alias("dropped_boxes"),
        F.sum(F.col("raw") - F.col("kept") - F.col("dropped")).alias("invalid_boxes"),
        F.count_if(F.col("kept") == 0).alias("images_without_box"),
    )


def distribution(boxes: DataFrame) -> DataFrame:
    """Instances and distinct images by split and class, with a row of all splits (split null) for each class.

    Boxes are dealt by image and class to partitions of ``SHARE`` boxes, more of them the more boxes there are, and sorted there,
    so a task's memory doesn't grow with the table; where a split or an image begins is counted, and only counts leave a partition."""
    boxes = boxes.select("split", "cls", "image")
    many, most = boxes.count(), int(boxes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(most, many // LEAST), -(-many // SHARE))
    order = W.partitionBy("cls", "image").orderBy("split")
    first = F.row_number().over(order) == 1
    seen = boxes.repartition(parts, "cls", "image").select("split", "cls", "image", first.alias("first"), (first | ~F.lag("split").over(order).eqNullSafe(F.col("split"))).alias("new"))
    known = F.col("image").isNotNull()
    per = seen.groupBy("split", "cls").agg(F.count("*").alias("n"), F.count_if(known & F.col("new")).alias("own"), F.count_if(known & F.col("first")).alias("firsts"))
    images = F.when(F.grouping("split") == 0, F.sum("own")).otherwise(F.sum("firsts"))
    return per.groupingSets([[F.col("split"), F.col("cls")], [F.col("cls")]], F.col("split"), F.col("cls")).agg(F.sum("n").alias("instances"), images.alias("images"))


def dense_grid(counts: DataFrame, splits: list[str], classes: list[int], values: list[str]) -> DataFrame:
    """``counts`` for every split and class of the lists, zero where there is no row."""
    grid = counts.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, splits))).alias("split")).select("split", F.explode(F.array(*map(F.lit, classes))).alias("cls"))
    return F.broadcast(grid).join(counts, ["split", "cls"], "left").select("split", "cls", *[F.coalesce(F.col(v), F.lit(0)).cast("long").alias(v) for v in values])


def health(boxes: DataFrame) -> DataFrame:
    """By split: images, boxes, negative classes, loosely invalid among the others, strictly invalid."""
    negative = F.col("cls") < 0
    return boxes.groupBy("split").agg(
        F.countDistinct("image").alias("images"),
        F.count("*").alias("boxes"),
        F.count_if(negative).alias("negative_classes"),
        F.count_if(~negative & ~F.coalesce(B.loose_valid(*_cols()), F.lit(False))).alias("loose_invalid"),
        F.count_if(~F.coalesce(B.strict_valid(*_cols()), F.lit(False))).alias("strict_invalid"),
    )


def percentiles(df: DataFrame, value: Column, by: list[str], points: list[float]) -> DataFrame:
    """Exact percentiles with linear interpolation as columns p1, p5, ... of each group; nan is the greatest, null counts for none,
    and a group of nulls has nulls.

    Values are counted first, however often they repeat, and their counts summed up over ranges of (group, value).  The values
    that hold the wanted ranks are picked where they lie, so a single group is spread over all tasks and none keeps its values."""
    spark, held = df.sparkSession, F.struct(*by) if by else F.lit(0)
    each = stage(df.select(held.alias("g"), value.cast("double").alias("v")).groupBy("g", "v").agg(F.count("*").alias("n")))
    total = each.agg(F.sum("n")).first()[0] or 0
    upto = running(each.where("v is not null"), ["g", "v"], F.col("n"), "upto")
    # A group lies in a few stretches of places; what is known of it goes to each.
    stretch = total // int(spark.conf.get("spark.sql.shuffle.partitions")) + 1
    upto = stage(upto.withColumn("k", F.floor(F.col("upto") / stretch)))
    parts = upto.groupBy("g", "k").agg(F.min(F.col("upto") - F.col("n")).alias("start"), F.max("upto").alias("end"))
    ends = parts.groupBy("g").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    placed = upto.join(parts.select("g", "k").join(ends, "g"), ["g", "k"])
    last = F.col("end") - F.col("start") - 1
    holds = lambda rank: (F.col("upto") - F.col("n") - F.col("start") <= rank) & (rank < F.col("upto") - F.col("start"))
    ranks = [(F.floor(last * (p / 100)), F.ceil(last * (p / 100))) for p in points]
    wanted = F.lit(False)
    for low, high in ranks:
        wanted = wanted | holds(low) | holds(high)
    picks = [F.max(F.when(holds(r), F.col("v"))).alias(f"{name}{i}") for i, pair in enumerate(ranks) for name, r in zip("ab", pair)]
    found = placed.where(wanted).groupBy("g").agg(F.max(last).alias("last"), *picks)

    def between(i: int, p: float) -> Column:
        at, a, b = F.col("last") * (p / 100), F.col(f"a{i}"), F.col(f"b{i}")
        return F.round(F.when(a == b, a).otherwise((F.ceil(at) - at) * a + (at - F.floor(at)) * b), 9).alias(f"p{p:g}")

    out = each.select("g").distinct().join(found, "g", "left")
    return out.select(*[F.col("g").getField(c).alias(c) for c in by], *[between(i, p) for i, p in enumerate(points)])


def dominant_class(boxes: DataFrame, order: Column) -> DataFrame:
    """The most frequent class of each image; among equals the one seen first in ``order``."""
    per = boxes.groupBy("image", "cls").agg(F.count("*").alias("n"), F.min(order).alias("first"))
    return per.groupBy("image").agg(F.min_by("cls", F.struct(-F.col("n"), F.col("first"))).alias("cls"))


def file_mix(boxes: DataFrame) -> DataFrame:
    """Images by what their boxes are: valid only, invalid only, or mixed."""
    ok = F.coalesce(B.strict_valid(*_cols()), F.lit(False))
    per = boxes.groupBy("image").agg(F.count_if(ok).alias("good"), F.count_if(~ok).alias("bad"))
    return per.select("image", F.when(F.col("bad") == 0, "valid").when(F.col("good") == 0, "invalid").otherwise("mixed").alias("mix"), "good", "bad")
