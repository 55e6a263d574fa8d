"""Token counts that follow edits: a segment tree of pre-token runs for each document.

A document's text is cut into leaves of about ``LEAF`` characters, at places that no pre-token crosses: before a space or line
break, and where ASCII letters, digits and signs meet or a CJK sign stands.  Its state is two sum trees over the leaves,
characters and tokens, in heap order.  An edit goes down the character tree to the leaves it touches, takes neighbours along
while it lies within ``NEAR`` characters of their border, which is all the context a cut depends on, and re-encodes only that
stretch; the sums on the way up from those leaves are then set anew.  A stretch grown to ``GROWN`` times a leaf is cut into new
leaves; the sums are then rebuilt from the leaves' numbers, without encoding any other text.

Defined results for odd input: a null or empty text has no tokens and one empty leaf; edits apply to it as to an empty text.
A null list of edits, or an empty one, changes nothing; places beyond the end count as the end, negative ones as the start, null
inserts as empty.  Texts are encoded whole, in steps; a single pre-token of any length is a leaf of its own, since the vocabulary
encodes it as a whole.  Edits with equal ``seq`` follow in order of their place.  Repeated rows are documents of their own;
edits of an id reach all its rows; an empty table gives an empty result.  Other columns pass through; ones named like
added columns are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm import tokens
from llm.common import sliced, table

LEAF, GROWN = 512, 4
#: A cut depends on so many characters on either side at most: those of the vocabulary's added token.
NEAR = len(tokens.ADDED) + 1
# Classes that a pre-token never crosses, save an apostrophe and what follows it; the added token is never cut.
CUT = re.compile(
    tokens.CUT.pattern
    + r"|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z0-9])(?=[!-/:-@\[-`{-~])|(?<=[!-&(-/:-@\[-`{-~])(?<!<\|)(?=[A-Za-z0-9])"
    + r"|(?<=[、。！，：；？])(?=[一-龥ぁ-んァ-ヶ])|(?<=[一-龥ぁ-んァ-ヶ])(?=[、。！，：；？])"
)
EDITS = "array<struct<start:long,removed:long,inserted:string>>"
STATE = ("n_tokens", "chars", "counts")


def _cut(text: str) -> list[str]:
    out, at, look = [], 0, LEAF
    while len(text) - at > LEAF and (m := CUT.search(text, at + look)):
        if text.startswith("|>", m.start()) and text.endswith(tokens.ADDED[:-2], 0, m.start()):
            look = m.start() + 1 - at  # inside the added token
            continue
        out.append(text[at : m.start()])
        at, look = m.start(), LEAF
    return [*out, text[at:]]


class Tree:
    """Sums over leaves in heap order: node k has children 2k and 2k+1, leaves start at ``base``."""

    def __init__(self, chars: np.ndarray, counts: np.ndarray):
        self.chars, self.counts, self.base = chars, counts, len(chars) // 2

    @classmethod
    def of(cls, chars: list[int] | np.ndarray, counts: list[int] | np.ndarray) -> Tree:
        """The tree over leaves with these numbers."""
        base = 1 << (len(chars) - 1).bit_length()
        sums = []
        for leaves in (chars, counts):
            x = np.zeros(2 * base, dtype=np.int64)
            x[base : base + len(leaves)] = leaves
            k = base
            while k > 1:
                x[k // 2 : k] = x[k : 2 * k : 2] + x[k + 1 : 2 * k : 2]
                k //= 2
            sums.append(x)
        return cls(*sums)

    @classmethod
    def build(cls, text: str, enc: tokens.Encoder) -> Tree:
        leaves = _cut(text)
        return cls.of([len(x) for x in leaves], [enc.count(x) for x in leaves])

    def find(self, place: int) -> tuple[int, int]:
        """The leaf that holds character ``place`` (the last with characters, if it is the end), and where that leaf starts."""
        k, before = 1, 0
        while k < self.base:
            k *= 2
            if place - before >= self.chars[k] and (self.chars[k + 1] > 0):
                before += int(self.chars[k])
                k += 1
        return k, before

    def set(self, leaf: int, chars: int, count: int) -> None:
        self.chars[leaf], self.counts[leaf] = chars, count
        while leaf > 1:
            leaf //= 2
            self.chars[leaf], self.counts[leaf] = self.chars[2 * leaf] + self.chars[2 * leaf + 1], self.counts[2 * leaf] + self.counts[2 * leaf + 1]

    def edit(self, text: str, start: int, removed: int, inserted: str, enc: tokens.Encoder) -> tuple[str, int]:
        """The edited text and how many characters were encoded again; the sums follow."""
        start = min(max(0, start), len(text))
        end = min(len(text), start + max(0, removed))
        first, lo = self.find(start)
        while lo > 0 and start - lo < NEAR:
            first, lo = self.find(lo - 1)
        last, hi = self.find(end)
        hi += int(self.chars[last])
        while hi < len(text) and hi - end < NEAR:
            last, hi = self.find(hi)
            hi += int(self.chars[last])
        part, new = text[lo:start] + inserted + text[end:hi], text[:start] + inserted + text[end:]
        leaves = _cut(part) if len(part) > GROWN * LEAF else [part]
        if len(leaves) > 1:
            own = [np.r_[x[self.base : first], y, x[last + 1 :]] for x, y in ((self.chars, [len(x) for x in leaves]), (self.counts, [enc.count(x) for x in leaves]))]
            full = own[0] > 0
            self.__dict__.update(Tree.of(own[0][full], own[1][full]).__dict__)
            return new, len(part)
        for leaf in range(first + 1, last + 1):
            if self.chars[leaf]:
                self.set(leaf, 0, 0)
        self.set(first, len(part), enc.count(part))
        return new, len(part)


def _clean(text: str | None) -> str:
    return (text or "").encode("utf-8", "replace").decode("utf-8")


def _state(trees: list[Tree]) -> list[pa.Array]:
    lists = lambda rows: pa.ListArray.from_arrays(np.r_[0, np.cumsum([len(x) for x in rows])].astype(np.int32), np.concatenate(rows)) if rows else pa.array([], pa.list_(pa.int64()))
    return [pa.array([int(t.counts[1]) for t in trees], pa.int64()), lists([t.chars for t in trees]), lists([t.counts for t in trees])]


def _built(path: str):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(path)
        for b in sliced(batches, "text"):
            yield pa.RecordBatch.from_arrays([*b.columns, *_state([Tree.build(_clean(t.as_py()), enc) for t in b.column("text")])], [*b.schema.names, *STATE])

    return of


def _edited(path: str):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(path)
        for b in sliced(batches, "text"):
            texts, trees, again = [], [], []
            for t, chars, counts, edits in zip(b.column("text"), b.column("chars"), b.column("counts"), b.column("edits").to_pylist()):
                text, tree, n = t.as_py(), Tree(*(x.values.to_numpy(zero_copy_only=False).astype(np.int64) for x in (chars, counts))), 0
                for e in edits or ():
                    if e is not None:
                        text, m = tree.edit(_clean(text), e["start"] or 0, e["removed"] or 0, _clean(e["inserted"]), enc)
                        n += m
                texts.append(text)
                trees.append(tree)
                again.append(n)
            new = dict(zip(("text", *STATE, "n_encoded"), [pa.array(texts, pa.string()), *_state(trees), pa.array(again, pa.int64())]))
            keep = [c for c in b.schema.names if c not in (*new, "edits")]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], *new.values()], [*keep, *new])

    return of


def _schema(fields: list[T.StructField], *more: str) -> T.StructType:
    longs = T.ArrayType(T.LongType())
    kinds = {"text": T.StringType(), "n_tokens": T.LongType(), "chars": longs, "counts": longs, "n_encoded": T.LongType()}
    return T.StructType([*fields, *[T.StructField(c, kinds[c]) for c in more]])


def build(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` plus its state: ``n_tokens`` and the trees ``chars`` and ``counts``."""
    docs = docs.drop(*STATE).withColumn("text", F.col("text").cast("string"))
    return docs.mapInArrow(_built(path or tokens.default_path()), _schema(docs.schema.fields, *STATE))


def apply_edits(state: DataFrame, path: str | None = None) -> DataFrame:
    """The state after each row's ``edits`` (places count in the text as left by the edits before), plus ``n_encoded``, the characters encoded again."""
    new = ("text", *STATE, "n_encoded")
    rows = state.drop("n_encoded").withColumn("edits", F.col("edits").cast(EDITS))
    keep = [f for f in rows.schema.fields if f.name not in (*new, "edits")]
    return rows.mapInArrow(_edited(path or tokens.default_path()), _schema(keep, *new))


def attach(state: DataFrame, edits: DataFrame) -> DataFrame:
    """``state`` with the ``edits`` (``doc_id``, ``seq``, ``start``, ``removed``, ``inserted``) of each document in order of ``seq``."""
    by = edits.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("seq", "start", "removed", "inserted"))).alias("_e"))
    listed = F.transform("_e", lambda e: F.struct(e["start"].alias("start"), e["removed"].alias("removed"), e["inserted"].alias("inserted")))
    return state.drop("edits").join(by, "doc_id", "left").withColumn("edits", listed).drop("_e")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and again after two edits at places its id and text decide: words put in, then seven characters taken out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    place = lambda salt: F.pmod(F.xxhash64(F.lit(salt), "doc_id"), F.length(F.coalesce("text", F.lit(""))) + 1).cast("long")
    edit = lambda start, removed, inserted: F.struct(start.alias("start"), F.lit(removed).cast("long").alias("removed"), F.lit(inserted).alias("inserted"))
    state = build(docs).withColumn("n_before", F.col("n_tokens")).withColumn("edits", F.array(edit(place(1), 0, " some new words"), edit(place(2), 7, "")))
    after = apply_edits(state)
    return after.select("doc_id", F.col("n_before").alias("n_tokens"), F.col("n_tokens").alias("n_tokens_edited"), "n_encoded", F.length("text").cast("long").alias("n_chars_edited"))
