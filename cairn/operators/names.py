"""Free names for a batch: each item in order takes its base name, or with the smallest free suffix ``_1``, ``_2``, ..., as if the
items came one by one; computed without going through them one by one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from cairn.plans.scratch import drop, stage

#: A suffix that counting can reach.
NUMBERED = r"^(.*)_([1-9]\d{0,17})$"


def running(rows: DataFrame, order: list[str], value: Column, name: str, parts: int | None = None) -> DataFrame:
    """``rows``, staged, with the sum ``name`` of ``value`` over all rows up to and including each in ``order``, whose values differ.

    Rows are dealt to ranges of the order and summed up there; a number for each range is all that is broadcast."""
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stage(rows.withColumn("_v", value.cast("long")).repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))
    sums = dealt.groupBy("_part").agg(F.sum("_v").alias("_s"))
    before = sums.select("_part", (F.sum("_s").over(W.orderBy("_part")) - F.col("_s")).alias("_before"))  # a row a range
    inside = F.sum("_v").over(W.partitionBy("_part").orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    return dealt.withColumn(name, inside).join(F.broadcast(before), "_part").withColumn(name, F.col(name) + F.col("_before")).drop("_part", "_before", "_v")


def _parsed(name: Column) -> tuple[Column, Column]:
    """The base and number that a name can stand for; null where it has no number."""
    numbered = name.rlike(NUMBERED)
    return F.when(numbered, F.regexp_extract(name, NUMBERED, 1)), F.when(numbered, F.regexp_extract(name, NUMBERED, 2).cast("long"))


def _skipped(marks: DataFrame, groups: DataFrame, items: DataFrame) -> DataFrame:
    """``marks`` (``base``, ``n``, ``time``, null for names in use before) with ``at``, how many items of the base have a lower number,
    and ``skip``, whether the item that comes to the number finds it in use.

    A number in use since ``time`` is skipped by later items only.  Which item comes to it depends on the numbers skipped
    before, so this starts with those that every item skips and goes on until nothing changes: the lowest number that is
    wrong becomes right each time."""
    sized = marks.join(groups.select("base", "size", "first"), "base")
    now = stage(sized.withColumn("skip", F.col("time").isNull()))
    timed = now.where("time is not null").limit(1).count()
    while True:
        counted = running(now, ["base", "n"], F.col("skip").cast("int"), "_c")
        start = counted.groupBy("base").agg(F.min(F.col("_c") - F.col("skip").cast("int")).alias("_s"))
        placed = counted.join(start, "base").withColumn("at", F.col("n") - (F.col("_c") - F.col("skip").cast("int") - F.col("_s"))).drop("_c", "_s")
        if not timed:
            return stage(placed)
        comes = items.select(F.col("place").alias("_p"), F.struct("ord", "base").alias("_o"))
        met = placed.withColumn("_p", F.when(F.col("at") < F.col("size"), F.col("first") + F.col("at"))).join(comes, "_p", "left")
        after = F.col("time").isNull() | F.coalesce(F.col("time") < F.col("_o"), F.lit(False))
        new = stage(met.withColumn("_new", after).drop("_p", "_o"))
        if new.where("_new <> skip").isEmpty():
            return new.drop("_new")
        drop(now)
        now = stage(new.drop("skip", "at").withColumnRenamed("_new", "skip"))


def free_stems(new: DataFrame, taken: DataFrame, prefix: str = "hc_") -> DataFrame:
    """``new`` (``stem``, ``ord``) with ``name`` (``name_`` if there is one already): prefix and stem, or with the smallest free suffix
    ``_1``, ``_2``, ... in order of ``ord``, among equal ones of stems; ``taken`` has the stems in use.  No name is given twice.

    Items of one base count upwards, so the k-th has the k-th number that isn't skipped.  A number ``n`` of base ``b`` is skipped
    where ``b_n`` is in use before, or is the base of other items whose first one came earlier.  Whether a base itself is still
    free for its own first item is known once the base it is numbered from is done; so bases are done from the shortest on, a
    round for each suffix that names have on top of each other.  Null stems get null."""
    own, out_name = new.columns, "name_" if "name" in new.columns else "name"
    kept = new.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"), F.concat(F.lit(prefix), F.col("stem")).alias("base"), F.col("ord").alias("ord"))
    items = running(kept.where("base is not null").withColumn("tie", F.monotonically_increasing_id()), ["base", "ord", "tie"], F.lit(1), "place").drop("tie")
    groups = items.groupBy("base").agg(F.min("place").alias("first"), F.count("*").alias("size"), F.min("ord").alias("since"))
    up, number = _parsed(F.col("base"))
    groups = stage(groups.withColumn("up", up).withColumn("number", number))
    parents = groups.select(F.col("base").alias("up"), F.lit(True).alias("has"))
    groups = stage(groups.join(parents, "up", "left").withColumn("up", F.when(F.col("has"), F.col("up"))).drop("has"))
    used = taken.select(F.col("stem").alias("t")).distinct()
    base, n = _parsed(F.col("t"))
    whole = used.select(F.col("t").alias("base"), F.lit(0).cast("long").alias("n"))
    used = stage(whole.unionByName(used.select(base.alias("base"), n.alias("n")).where("base is not null")).join(groups.select("base"), "base", "left_semi"))
    time = F.struct(F.col("since").alias("ord"), F.col("base").alias("base"))
    claims = groups.where("up is not null").select(F.col("up").alias("base"), F.col("number").alias("n"), time.alias("time"))
    marks = claims.join(used, ["base", "n"], "left_anti").unionByName(used.withColumn("time", F.lit(None).cast(claims.schema["time"].dataType)))
    marks = stage(marks)

    ready, left, lost, shifts = groups.where("up is null"), groups.where("up is not null"), None, []
    while True:
        mine = marks.join(ready.select("base"), "base", "left_semi")
        if lost is not None:  # the name itself went to an item of the base above
            gone = lost.join(ready.select("base"), "base", "left_semi").select("base", F.lit(0).cast("long").alias("n"), F.lit(None).cast(claims.schema["time"].dataType).alias("time"))
            mine = mine.join(gone.select("base", "n"), ["base", "n"], "left_anti").unionByName(gone)
        done = _skipped(mine, groups, items)
        reached = done.where(F.col("at") < F.col("size"))
        shifts.append(reached.where("skip").select("base", "at"))
        if left.isEmpty():
            break
        lost = stage(reached.where("time is not null and not skip").select(F.concat("base", F.lit("_"), F.col("n").cast("string")).alias("base")))
        now = left.join(ready.select(F.col("base").alias("up")), "up", "left_semi")
        ready, left = stage(now), stage(left.join(now.select("base"), "base", "left_anti"))

    # The number of an item: its place within the base, and one for each number skipped up to there.
    skips = shifts[0]
    for s in shifts[1:]:
        skips = skips.unionByName(s)
    skips = stage(skips)
    placed = items.join(groups.select("base", "first"), "base").select("row", "base", (F.col("place") - F.col("first")).alias("at"))
    moved = placed.join(skips.select("base").distinct(), "base", "left_semi")
    both = moved.withColumn("one", F.lit(0)).unionByName(skips.select("base", "at", F.lit(1).alias("one")), allowMissingColumns=True)
    both = both.withColumn("later", -F.col("one")).withColumn("tie", F.monotonically_increasing_id())
    summed = running(both, ["base", "at", "later", "tie"], F.col("one"), "_c")
    start = summed.groupBy("base").agg(F.min(F.col("_c") - F.col("one")).alias("_s"))
    counted = summed.where("one = 0").join(start, "base").select("row", "base", (F.col("at") + F.col("_c") - F.col("_s")).alias("n"))
    still = placed.join(skips.select("base").distinct(), "base", "left_anti").select("row", "base", F.col("at").alias("n"))
    name = F.when(F.col("n") == 0, F.col("base")).otherwise(F.concat("base", F.lit("_"), F.col("n").cast("string")))
    named = counted.unionByName(still).select("row", name.alias("_name"))
    named = named.unionByName(kept.where("base is null").select("row", F.lit(None).cast("string").alias("_name")))
    return named.select(*[F.col("row").getField(c).alias(c) for c in own], F.col("_name").alias(out_name))
