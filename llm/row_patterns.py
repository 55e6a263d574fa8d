"""Row pattern matching over run tokens: ``A (D|U)*? P`` in each client's rows, for clients of any size.

Rows are dealt by ranges of (client, time, id), so a client with a third of all rows lies in many blocks.  One pass goes through
each block backwards and run-length encodes it: a run is a row that moves neither down nor up, and the D/U rows after it.  Every
run becomes a token (a long one several) with its goal-cents summary, the most cents of a row that could be P.  Going backwards,
the best goal that can still be reached is known at every row, so each row that can be A of a match is marked, and rows after the
last goal of a run are left out.  Matching then walks over tokens: it passes over those without a marked row, and while it looks
for P over those whose goal is too small; it goes down into rows only to place A and P.

Blocks are walked at once.  Between two blocks there is little to know: the row before, the best goal to the right, and whether
a match is under way, with the cents of its A.  These facts, a few numbers for each block, go to the driver; the number of blocks
is a parameter and doesn't grow with the rows.  A block is first walked as if no match reached into it; those that were wrong are
walked again until nothing changes, which is exact, and mostly ends after the second time.

Defined results for odd input: rows without client or time are dropped.  Equal rows count once.  Rows equal in client, time and
id that differ elsewhere are ordered by cents, those without first, then kind (error or null, others, goal).  A null id sorts
first and stays null.  A value that is null or not finite, or whose cents don't fit into 64 bits, fits no letter.  A sum that
doesn't fit into 64 bits is null.  Extra columns only decide which rows are equal.  An empty table gives an empty result.  The
labels of a match that crosses blocks are joined in one task, a byte a row, since their digest needs them in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import materialize, remove, table

#: Bits of a row's code: letter (0 none, 1 D, 2 U), could be P, can be A.
MOVE, GOAL, ABLE = 3, 4, 8
HEAD = "client_id, first_ts, first_cents, first_kind, reach, reaches_end, last_client, last_ts, last_cents"
LETTERS = np.frombuffer(b"?DU?", dtype=np.uint8)
LONG = 1 << 63


def _codes(near: np.ndarray, cents: np.ndarray, valid: np.ndarray, kind: np.ndarray, before: np.ndarray, before_valid: np.ndarray) -> np.ndarray:
    """Letter and goal bit of rows, given whether they are near the row before, and that row's cents."""
    moves = near & valid & before_valid & (kind > 0)
    code = np.where(moves & (cents < before), 1, np.where(moves & (cents > before), 2, 0))
    return (code | np.where(near & valid & (kind == 2), GOAL, 0)).astype(np.uint8)


class _Backwards:
    """What is known of the rows that come later, while a block is read from its end."""

    def __init__(self, gap: int):
        self.gap, self.best, self.to_end, self.seen = gap, None, True, 0

    def tokens(self, rows: pa.RecordBatch, code: np.ndarray, first: bool) -> dict:
        """Arrays of the tokens of ``rows`` (latest first) with their letters; ``first``: the one row is the block's first."""
        cents, valid = _numbers(rows, "cents")
        goal, starts = (code & GOAL) > 0, (code & MOVE) == 0
        held = [] if self.best is None else [self.best]
        known = np.unique(np.concatenate([cents[goal], np.array(held, dtype=np.int64)]))
        many = len(known) + 1
        rank = np.where(goal, np.searchsorted(known, cents) + 1, 0)
        run = np.cumsum(starts)
        begin = int(np.searchsorted(known, self.best)) + 1 if held else 0
        most = np.maximum.accumulate(np.concatenate([[begin], run * many + rank])) % many
        reach, reached = most[:-1], most[1:]  # the best goal after each row, without and with the row itself
        best = known[np.maximum(reach, 1) - 1] if len(known) else np.zeros(len(cents), dtype=np.int64)
        able = valid & (reach > 0) & (cents <= best)
        to_end = self.to_end & (run - starts == 0)
        keep = np.flatnonzero((reach > 0) | goal | to_end | first)[::-1]
        self.best = int(known[reached[-1] - 1]) if reached[-1] else None
        self.to_end = bool(self.to_end and not run[-1])
        cut = starts[keep].copy()
        cut[:1] = True
        lo = np.flatnonzero(cut)
        code = (code | np.where(able, ABLE, 0)).astype(np.uint8)[keep]
        tops = np.where(code & GOAL, cents[keep], -LONG)
        top = np.maximum.reduceat(tops, lo) if len(lo) else np.zeros(0, dtype=np.int64)
        out = {
            "at": -(self.seen + keep[lo]),
            "client_id": rows.column("client_id").take(pa.array(keep[lo])),
            "to_end": to_end[keep[lo]],
            "able": np.logical_or.reduceat((code & ABLE) > 0, lo) if len(lo) else np.zeros(0, dtype=bool),
            "top": pa.array(top, mask=~(np.logical_or.reduceat((code & GOAL) > 0, lo) if len(lo) else np.zeros(0, dtype=bool))),
            "ids": rows.column("click_id").take(pa.array(keep)),
            "cents": rows.column("cents").take(pa.array(keep)),
            "codes": code,
            "ends": np.append(lo, len(keep)).astype(np.int32),
            "reach": int(best[0]) if reach[0] else None,  # of use for a single row only
            "reaches_end": bool(to_end[0]),
        }
        self.seen += len(cents)
        return out


def _numbers(rows: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    held = rows.column(name)
    return pc.fill_null(held, 0).to_numpy(zero_copy_only=False), pc.is_valid(held).to_numpy(zero_copy_only=False)


def _encode(batches: Iterator[pa.RecordBatch], schema: pa.Schema, gap: int) -> Iterator[pa.RecordBatch]:
    """Tokens of a block whose rows come latest first.  The last token returned has the block's first row and its facts."""
    block, known, held, last = TaskContext.get().partitionId(), _Backwards(gap), None, None

    def batch(t: dict, facts: dict | None) -> pa.RecordBatch:
        n = len(t["at"])
        lists = {c: pa.ListArray.from_arrays(pa.array(t["ends"], pa.int32()), t[c]) for c in ("ids", "cents")}
        codes = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(t["ends"].tobytes()), pa.py_buffer(t["codes"].tobytes())])
        cols = {"block": pa.array(np.full(n, block)), "codes": codes, **lists, **{c: t[c] for c in ("at", "client_id", "to_end", "able", "top")}}
        if facts is not None:
            cols |= {c: pa.array([v], schema.field(c).type) for c, v in facts.items()}
        fill = lambda f: cols[f.name] if f.name in cols else pa.nulls(n, f.type)
        made = [fill(f) if isinstance(fill(f), pa.Array) else pa.array(fill(f)) for f in schema]
        return pa.record_batch([x.cast(f.type) for x, f in zip(made, schema, strict=True)], schema=schema)

    for b in batches:
        if not b.num_rows:
            continue
        if last is None:
            last = b.slice(0, 1).to_pylist()[0]
            last["ts"] = b.column("ts").cast(pa.int64())[0].as_py()
        rows = b if held is None else pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
        n = rows.num_rows - 1
        held = rows.slice(n)
        if not n:
            continue
        now, before = rows.slice(0, n), rows.slice(1)
        ts = rows.column("ts").cast(pa.int64()).to_numpy(zero_copy_only=False)
        near = pc.equal(now.column("client_id"), before.column("client_id")).to_numpy(zero_copy_only=False) & (ts[:-1] - ts[1:] <= gap)
        cents, valid = _numbers(rows, "cents")
        kind, _ = _numbers(now, "kind")
        tokens = known.tokens(now, _codes(near, cents[:-1], valid[:-1], kind, cents[1:], valid[1:]), False)
        if len(tokens["at"]):
            yield batch(tokens, None)
    if held is not None:  # the block's first row: its letter depends on the block before
        row = held.to_pylist()[0]
        t = known.tokens(held, np.zeros(1, dtype=np.uint8), True)
        facts = {"first_ts": held.column("ts").cast(pa.int64())[0].as_py(), "first_cents": row["cents"], "first_kind": row["kind"], "reach": t["reach"], "reaches_end": t["reaches_end"]}
        yield batch(t, facts | {"last_client": last["client_id"], "last_ts": last["ts"], "last_cents": last["cents"]})


class _Block:
    """What the driver knows of a block: its facts, the letter of its first row, the best goal to the right of its end."""

    def __init__(self, facts, code: int):
        self.facts, self.code, self.right = facts, code, None

    def reach(self) -> int | None:
        """The best goal that rows of the block before can reach here."""
        f, goals = self.facts, []
        if self.code & GOAL:
            goals.append(f["first_cents"])
        if self.code & MOVE:
            goals += [f["reach"], self.right if f["reaches_end"] else None]
        return max((g for g in goals if g is not None), default=None)

    def top(self) -> int | None:
        """The best goal of the block's own rows that a match from the left can reach."""
        own = [self.facts["first_cents"] if self.code & GOAL else None, self.facts["reach"] if self.code & MOVE else None]
        return max((g for g in own if g is not None), default=None)


def _facts(tokens: DataFrame, gap: int) -> dict[int, _Block]:
    """The blocks that have rows, in order."""
    found = sorted(tokens.where(F.col("reaches_end").isNotNull()).select("block", *HEAD.split(", ")).collect(), key=lambda r: r["block"])
    blocks, before = {}, None
    for f in found:
        near = before is not None and before["last_client"] == f["client_id"] and f["first_ts"] - before["last_ts"] <= gap
        one = lambda x: (np.array([x or 0]), np.array([x is not None]))
        left = one(before["last_cents"] if before is not None else None)
        blocks[f["block"]] = _Block(f, int(_codes(np.array([near]), *one(f["first_cents"]), np.array([f["first_kind"]]), *left)[0]))
        before = f
    after = None
    for b in reversed(blocks.values()):
        b.right = after.reach() if after is not None else None
        after = b
    return blocks


def _walk(batches: Iterator[pa.RecordBatch], schema: pa.Schema, blocks: dict, entries: dict, numbers: dict | None) -> Iterator[pa.RecordBatch]:
    """Go through the tokens of blocks in order, from ``entries`` (block: cents of the A of a match under way, and the block it
    began in).  Without ``numbers`` the result is a row for each block: the cents of a match under way at its end, whether it
    began here, and how many matches of the block's first and last client did.  With them (matches of the first client before
    each block), it is the matches, those that cross blocks in parts."""
    out: dict[str, list] = {f.name: [] for f in schema}
    block = None

    def flush() -> pa.RecordBatch:
        made = pa.record_batch([pa.array(out[f.name], f.type) for f in schema], schema=schema)
        for c in out.values():
            c.clear()
        return made

    def put(*values) -> None:
        for c, v in zip(out.values(), values, strict=True):
            c.append(v)

    def close() -> None:  # the end of a block
        if numbers is None:
            put(block, goal, goal is not None and origin == block, made[0], made[1])
        elif goal is not None:
            part(None)

    def part(last) -> None:
        """The match under way, or what of it lies in this block."""
        whole = origin == block and goal is None
        labels = "".join(text)
        put(client, number, first, last, rows, total if -LONG <= total < LONG else None, hashlib.sha256(labels.encode()).hexdigest() if whole else None, None if whole else labels, None if whole else origin, block)

    for b in batches:
        cols = {c: b.column(c) for c in b.schema.names}
        ends, ids = cols["ids"].offsets.to_numpy(), cols["ids"].values
        cents, valid = _numbers(pa.record_batch([cols["cents"].values], ["cents"]), "cents")
        of, to_end, able, top = (cols[c].to_pylist() for c in ("block", "to_end", "able", "top"))
        heads = pc.is_valid(cols["reaches_end"]).to_pylist()
        for t in range(b.num_rows):
            if of[t] != block:
                if block is not None:
                    close()
                block, known = of[t], blocks[of[t]]
                goal, origin = entries.get(block) or (None, None)
                made, ordinal = [0, 0], 0
                client, number, first, rows, total, text = known.facts["client_id"], None, None, 0, 0, []
            right = known.right if to_end[t] else None
            if goal is None and not able[t] and right is None:
                continue
            lo, hi = int(ends[t]), int(ends[t + 1])
            code = np.frombuffer(cols["codes"][t].as_buffer(), dtype=np.uint8)
            best = top[t]
            if heads[t]:
                code = code.copy()
                code[0] |= known.code
                if known.code & GOAL:
                    best = max(x for x in (best, known.facts["first_cents"]) if x is not None)
            c, ok = cents[lo:hi], valid[lo:hi]
            starts = (code & ABLE) > 0
            if right is not None:
                starts = starts | (ok & (c <= right))
            starts, goals, i = np.flatnonzero(starts), np.flatnonzero((code & GOAL) > 0), 0
            while i < hi - lo:
                if goal is None:
                    k = np.searchsorted(starts, i)
                    if k == len(starts):
                        break
                    i = int(starts[k])
                    goal, origin, client = int(c[i]), block, cols["client_id"][t].as_py()
                    mine = (client == known.facts["client_id"], client == known.facts["last_client"])
                    made = [n + int(m) for n, m in zip(made, mine, strict=True)]
                    if numbers is not None:
                        ordinal = ordinal + 1 if number is not None and whose == client else 1 + (numbers[block] if mine[0] else 0)
                        whose, number, first = client, ordinal, ids[lo + i].as_py()
                        rows, total, text = 1, goal, ["A"]
                    i += 1
                    continue
                j = hi - lo
                if best is not None and best >= goal:
                    later = goals[np.searchsorted(goals, i) :]
                    fits = later[c[later] >= goal]
                    j = int(fits[0]) if len(fits) else j
                placed = j < hi - lo
                if numbers is not None:
                    rows, total = rows + j - i + placed, total + int(c[i : j + placed].sum(dtype=object) if j + placed > i else 0)
                    text += [LETTERS[code[i:j] & MOVE].tobytes().decode(), "P" * placed]
                if placed:
                    goal = None
                    if numbers is not None:
                        part(ids[lo + j].as_py())
                i = j + 1
        if len(out["block"]) >= 5000:
            yield flush()
    if block is not None:
        close()
    yield flush()


def _resolve(tokens: DataFrame, blocks: dict[int, _Block]) -> tuple[dict, dict]:
    """The match under way at the start of each block, and the number of earlier matches of its first client."""
    spark, order = tokens.sparkSession, list(blocks)
    schema = "block long, goal long, began boolean, n_first long, n_last long"
    entries, seen, todo = {}, {}, set(order)
    while todo:
        some = tokens if len(todo) == len(order) else tokens.where(F.col("block").isin(sorted(todo)))
        for r in _walked(some, schema, blocks, {b: entries.get(b) for b in todo}, None).collect():  # a row for each block
            seen[r["block"]] = (entries.get(r["block"]), r)
        todo, state, numbers, count, before = set(), None, {}, 0, None
        for b in order:
            f, r = blocks[b].facts, None
            entries[b] = state
            same = before is not None and before == f["client_id"]
            count = count if same else 0
            numbers[b], top = count, blocks[b].top()
            if state is not None and f["reaches_end"] and (blocks[b].code & MOVE) and (top is None or top < state[0]):
                before = f["last_client"]  # the match goes through the whole block
                continue
            was, r = seen[b]
            if (was and was[0]) != (state and state[0]):
                todo.add(b)  # walked from another state; its end is a guess until it is walked again
            count = r["n_last"] + (count if f["client_id"] == f["last_client"] else 0)
            state = None if r["goal"] is None else (r["goal"], b if r["began"] else (state or (0, b))[1])
            before = f["last_client"]
    return entries, numbers


def _walked(tokens: DataFrame, schema, blocks: dict, entries: dict, numbers: dict | None) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    made = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    arrow = to_arrow_schema(made)
    dealt = tokens.repartitionById(max(blocks) + 1, F.col("block").cast("int")).sortWithinPartitions("block", "at")
    return dealt.mapInArrow(lambda batches: _walk(batches, arrow, blocks, entries, numbers), made)


def apply(clicks: DataFrame, by: str = "client_id", at: str = "ts", key: str = "click_id", kind: str = "kind", value: str = "value", goal: str = "purchase", halt: str = "error", gap_seconds: int = 600, blocks: int | None = None) -> DataFrame:
    """The matches of ``A (D|U)*? P`` among the distinct rows of each value of ``by``, see the module's text: ``client_id
    match_no first_id last_id n_rows sum_cents labels_sha256``.  ``blocks`` is how many ranges the rows are dealt to, by default
    the session's number of shuffle partitions."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructField, StructType

    spark, many = clicks.sparkSession, blocks or int(clicks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    v = F.col(f"`{value}`").cast("double")
    cents = F.when(F.abs(v) < 9e16, F.floor(100 * v + 0.5)).cast("long")
    code = F.when(F.col(f"`{kind}`") == goal, 2).when(F.col(f"`{kind}`") != halt, 1).otherwise(0)
    rows = clicks.where(F.col(f"`{by}`").isNotNull() & F.col(f"`{at}`").isNotNull()).distinct()
    order = ["client_id", "ts", "click_id", "cents", "kind"]
    rows = rows.select(F.col(f"`{by}`").alias("client_id"), F.col(f"`{at}`").alias("ts"), F.col(f"`{key}`").alias("click_id"), cents.alias("cents"), code.alias("kind"))
    types = {f.name: f.dataType for f in rows.schema}
    ddl = StructType.fromDDL("block long, at long, to_end boolean, able boolean, top long, cents array<long>, codes binary, first_ts long, first_cents long, first_kind int, reach long, reaches_end boolean, last_ts long, last_cents long")
    ids = StructType.fromDDL("ids array<long>")
    ids["ids"].dataType.elementType = types["click_id"]
    made = StructType([*ddl, StructField("client_id", types["client_id"]), StructField("last_client", types["client_id"]), *ids])
    arrow, gap = to_arrow_schema(made), gap_seconds * 1_000_000
    dealt = rows.repartitionByRange(many, *order).sortWithinPartitions(*[F.col(c).desc() for c in order])
    tokens = materialize(dealt.mapInArrow(lambda batches: _encode(batches, arrow, gap), made), "tokens")
    known = _facts(tokens, gap)
    result = StructType([StructField("client_id", types["client_id"]), StructField("match_no", ddl["at"].dataType), StructField("first_id", types["click_id"]), StructField("last_id", types["click_id"]), *StructType.fromDDL("n_rows long, sum_cents long, labels_sha256 string, labels string, origin long, block long")])
    if not known:
        remove(tokens)
        return spark.createDataFrame([], result).drop("labels", "origin", "block")
    entries, numbers = _resolve(tokens, known)
    parts = materialize(_walked(tokens, result, known, entries, numbers), "matches")
    remove(tokens)
    shown = ["client_id", "match_no", "first_id", "last_id", "n_rows", "sum_cents", "labels_sha256"]
    pieces = F.transform(F.sort_array(F.collect_list(F.struct("block", "labels"))), lambda x: x["labels"])
    joined = (
        parts.where(F.col("origin").isNotNull()).groupBy("origin")
        .agg(F.min_by("client_id", "block").alias("client_id"), F.min_by("match_no", "block").alias("match_no"), F.min_by("first_id", "block").alias("first_id"), F.max_by("last_id", "block").alias("last_id"), F.sum("n_rows").alias("n_rows"), F.expr("try_sum(sum_cents)").alias("sum_cents"), F.sha2(F.array_join(pieces, ""), 256).alias("labels_sha256"))
    )
    return parts.where(F.col("origin").isNull()).select(*shown).unionByName(joined.select(*shown))


ORACLE_SQL = """WITH RECURSIVE d AS (SELECT DISTINCT * FROM clicks WHERE client_id IS NOT NULL AND ts IS NOT NULL),
 r AS (SELECT client_id, ts, click_id, kind, floor(100 * value + 0.5)::BIGINT AS cents, row_number() OVER w AS rn, lag(ts) OVER w AS ts0, lag(floor(100 * value + 0.5)::BIGINT) OVER w AS cents0
  FROM d WINDOW w AS (PARTITION BY client_id ORDER BY ts, click_id)),
 l AS (SELECT *, coalesce(epoch_us(ts) - epoch_us(ts0) <= 600000000, FALSE) AS near FROM r),
 m AS (SELECT *, near AND cents IS NOT NULL AND kind = 'purchase' AS goal, CASE WHEN near AND kind <> 'error' AND cents < cents0 THEN 'D' WHEN near AND kind <> 'error' AND cents > cents0 THEN 'U' END AS move FROM l),
 s AS MATERIALIZED (SELECT *, count(*) FILTER (WHERE move IS NULL) OVER (PARTITION BY client_id ORDER BY rn) AS run FROM m),
 g AS (SELECT client_id, rn, cents, CASE WHEN move IS NULL THEN run - 1 ELSE run END AS run FROM s WHERE goal),
 e AS (SELECT s.client_id, s.rn, min(g.rn) AS last FROM s JOIN g ON g.client_id = s.client_id AND g.run = s.run AND g.rn > s.rn AND g.cents >= s.cents GROUP BY ALL),
 n AS (SELECT s.client_id, s.rn, min(e.rn) OVER (PARTITION BY s.client_id ORDER BY s.rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS start FROM s LEFT JOIN e USING (client_id, rn)),
 x AS MATERIALIZED (SELECT e.client_id, e.rn, e.last, n.start AS after FROM e LEFT JOIN n ON n.client_id = e.client_id AND n.rn = e.last + 1),
 p AS (SELECT x.client_id, x.rn, x.last, x.after, 1::BIGINT AS match_no FROM x JOIN n ON n.client_id = x.client_id AND n.rn = 1 AND n.start = x.rn
  UNION ALL SELECT x.client_id, x.rn, x.last, x.after, p.match_no + 1 FROM p JOIN x ON x.client_id = p.client_id AND x.rn = p.after)
SELECT p.client_id, p.match_no, min(s.click_id) FILTER (WHERE s.rn = p.rn) AS first_id, min(s.click_id) FILTER (WHERE s.rn = p.last) AS last_id, count(*) AS n_rows, sum(s.cents)::BIGINT AS sum_cents,
 sha256(string_agg(CASE WHEN s.rn = p.rn THEN 'A' WHEN s.rn = p.last THEN 'P' ELSE s.move END, '' ORDER BY s.rn)) AS labels_sha256
FROM p JOIN s ON s.client_id = p.client_id AND s.rn BETWEEN p.rn AND p.last GROUP BY p.client_id, p.match_no"""


def op13_row_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply(table(spark, sf_dir, "clicks"))
