"""A subset of a wanted size whose sum of densities lies in a band."""

from __future__ import annotations

from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from cairn.plans.scratch import drop, stage

STATE = "_g string, picks array<double>, total double, swapped int, dropped int, added_v array<double>, added_n array<int>, last double, seen int, done boolean, top double"


@dataclass
class _Group:
    """A group: its picks' densities in order, their sum, and how far swapping has come."""

    picks: list
    total: float
    swapped: int = 0
    dropped: int = 0
    last: float | None = None  # the density gone through last, and how many rows of it
    seen: int = 0
    added: dict = field(default_factory=dict)
    done: bool = False

    def thin(self, high: float) -> None:
        while self.total > high and len(self.picks) - self.dropped > 1:
            self.dropped += 1
            self.total -= self.picks[-self.dropped]

    def room(self, high: float) -> float:
        """The greatest density that the next pick can be swapped for; it never grows."""
        return high - self.total + self.picks[self.swapped]

    def swap(self, others: list, low: float, high: float) -> None:
        """Go through more densities of others, the densest first."""
        for v in others:
            if self.total >= low or self.swapped >= len(self.picks) - self.dropped or v <= self.picks[self.swapped]:
                self.done = True
                return
            self.seen = self.seen + 1 if v == self.last else 1
            self.last = v
            if v <= self.room(high):
                self.total += v - self.picks[self.swapped]
                self.swapped += 1
                self.added[v] = self.added.get(v, 0) + 1
        self.done = self.total >= low or self.swapped >= len(self.picks) - self.dropped


def _row(key: str, x: _Group, high: float) -> pd.DataFrame:
    """A group as a row of ``STATE``; ``top`` is the greatest density that is still of use."""
    top = None if x.done else float(x.room(high) if x.last is None else min(x.room(high), x.last))
    values = [key, x.picks, x.total, x.swapped, x.dropped, list(x.added), list(x.added.values()), x.last, x.seen, x.done, top]
    return pd.DataFrame([values], columns=[c.split(" ")[0] for c in STATE.split(", ")])


def _group(r: pd.Series) -> _Group:
    last = None if pd.isna(r["last"]) else float(r["last"])
    added = dict(zip([float(v) for v in r["added_v"]], [int(n) for n in r["added_n"]], strict=True))
    return _Group([float(v) for v in r["picks"]], float(r["total"]), int(r["swapped"]), int(r["dropped"]), last, int(r["seen"]), added, bool(r["done"]))


def band_subset(records: DataFrame, group: str, target: int, low: float, high: float) -> DataFrame:
    """``records`` (``group``, ``id``, ``density``, ``ord``) kept in each group; rows without a group are a group of their own.

    The ``target`` least dense come first.  If their sum is over ``high``, the densest of them go until it isn't.  If it is
    under ``low``, picks from the least dense on are swapped for the densest others, skipping those that would overshoot,
    until the band is reached or nothing denser is left.  A group of ``target`` or fewer stays whole.  A null density counts as
    0 and stays null; densities are reckoned as doubles.

    Groups are gone through in the executors, in passes: a task holds the picks of a group and the ``target`` densest others
    that can still be swapped in, a few times ``target`` numbers, and what it found is written for the next pass.  The driver
    gets the number of groups that aren't finished.  A group's rows are ranked up to those numbers only, never sorted as a whole."""
    rows = records.select("*", F.to_json(F.struct(F.col(group))).alias("_g"), F.coalesce(F.col("density").cast("double"), F.lit(0.0)).alias("_v"))
    rank = lambda *order: F.row_number().over(W.partitionBy("_g").orderBy(*order))
    picks = stage(rows.withColumn("_k", rank("_v", "ord")).where(F.col("_k") <= target))
    edge = picks.groupBy("_g").agg(F.max(F.struct("_v", "ord")).alias("_edge"), F.sort_array(F.collect_list("_v")).alias("_picks"))
    # The others are the rows after the last pick in order.
    rest = stage(rows.join(edge.select("_g", "_edge"), "_g").where(F.struct("_v", "ord") > F.col("_edge")).drop("_edge"))
    whole = rest.select("_g").distinct().withColumn("_more", F.lit(True))

    def begin(batches):
        for pdf in batches:
            out = []
            for key, values, more in zip(pdf["_g"], pdf["_picks"], pdf["_more"]):
                x = _Group([float(v) for v in values], float(sum(values)))
                if more:
                    x.thin(high)
                x.done = not more or x.total >= low
                out.append(_row(key, x, high))
            if out:
                yield pd.concat(out)

    first = edge.join(whole, "_g", "left").select("_g", "_picks", F.coalesce("_more", F.lit(False)).alias("_more"))
    state = stage(first.mapInPandas(begin, STATE))

    def swap(own: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        x = _group(own.iloc[0])
        if x.done:
            return own
        held = sorted((float(v) for v in others["_v"]), reverse=True)
        held = held[min(x.seen, held.count(x.last)) :]
        x.swap(held, low, high)
        x.done = x.done or len(held) < target
        return _row(own["_g"].iloc[0], x, high)

    while state.where("not done").count():
        asked = state.where("not done").select("_g", "top", "seen")
        near = rest.select("_g", "_v", "ord").join(asked, "_g").where(F.col("_v") <= F.col("top"))
        near = near.withColumn("_r", rank(F.desc("_v"), F.desc("ord"))).where(F.col("_r") <= 2 * target + 1).where(F.col("_r") <= target + F.col("seen"))
        last, state = state, stage(state.groupBy("_g").cogroup(near.select("_g", "_v").groupBy("_g")).applyInPandas(swap, STATE))
        drop(last)
    # The densest picks go, of equal ones the first; the least dense are swapped out in order.
    span = state.select("_g", F.col("swapped").alias("_from"), (F.size("picks") - F.col("dropped")).alias("_to"))
    ranked = picks.withColumn("_d", rank(F.desc("_v"), "_k")).withColumn("_all", F.count("*").over(W.partitionBy("_g")))
    kept = ranked.join(span, "_g").where((F.col("_k") > F.col("_from")) & (F.col("_d") > F.col("_all") - F.col("_to")))
    added = state.select("_g", F.explode(F.arrays_zip("added_v", "added_n")).alias("x")).select("_g", F.col("x.added_v").alias("_v"), F.col("x.added_n").alias("_n"))
    new = rest.join(added, ["_g", "_v"])
    new = new.withColumn("_r", F.row_number().over(W.partitionBy("_g", "_v").orderBy(F.desc("ord")))).where(F.col("_r") <= F.col("_n"))
    return kept.select(*records.columns).unionByName(new.select(*records.columns))
