"""Quality classification by Naive Bayes support vectors.

Features are indicators of n-grams of three streams of each whole text: its bytes (n = 2 to 4), the classes of its bytes
with runs as one (n = 2 to 6: letter case, digits, single symbols), and its words' echoes (n = 2 to 4: same as the word
before, seen before, new).  Each is scaled by the log ratio of its smoothed frequencies in the two classes, and a linear
support-vector machine with hinge loss is fitted to the scaled vectors by dual coordinate descent.  A logistic curve, fitted
to margins of rows that the machine has not seen and weighted to the classes' true shares, makes a margin a score.

The model is fitted on a bounded sample: ``per_class`` labelled documents of each class at most, which the driver gets as n-gram
numbers, at most 720,896 a text.  Learned from: text and label of the rows that ``fold`` allows.  Used for a score: the text alone.

Defined results for odd input: a null or empty text has no n-grams and gets the score of the bias.  With fewer than two
classes learned every score is the share of label 1 (0.5 without labels).  Null labels are left out; a document with
several labels counts with each, once however often a label is repeated; an id with several texts is learned with the least.
Texts of any length are read whole, in steps.  Repeated rows give repeated results, equal texts equal scores, an empty table an
empty result; extra columns pass through, save ones named like added columns, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm import ngrams
from llm.common import bounded_sample, held_out, sliced, spare, table

BYTES, SHAPE, ECHO = (2, 3, 4), (2, 3, 4, 5, 6), (2, 3, 4)
TABLE = (len(BYTES) + len(SHAPE) + len(ECHO)) << ngrams.BITS


def _flags(text: str | None, seen: np.ndarray) -> np.ndarray:
    """Numbers of the n-grams that a text has."""
    seen[:] = False
    data = (text or "").encode("utf-8", "replace")
    if data:
        a, b = len(BYTES) << ngrams.BITS, (len(BYTES) + len(SHAPE)) << ngrams.BITS
        ngrams.flag(seen[:a], data, BYTES)
        ngrams.flag(seen[a:b], ngrams.shape(data), SHAPE)
        ngrams.flag(seen[b:], ngrams.echo(data), ECHO)
    return np.flatnonzero(seen)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = np.zeros(TABLE, dtype=bool)
    for b in batches:
        ids = [_flags(t.as_py(), seen).astype("<i4").tobytes() for t in b.column("text")]
        yield pa.RecordBatch.from_arrays([b.column("label"), b.column("u"), pa.array(ids, pa.binary())], ["label", "u", "ids"])


def coordinate_descent(docs: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: np.ndarray, rounds: int = 20, seed: int = 0) -> tuple[np.ndarray, float]:
    """Weights and bias of min |w|²/2 + sum cost max(0, 1 - y w·x), x having ``ratio`` at a document's n-grams and 1 for the bias."""
    w, bias, alpha, rng = np.zeros(len(ratio)), 0.0, np.zeros(len(docs)), np.random.default_rng(seed)
    scaled = [ratio[d] for d in docs]
    norm = np.array([x @ x + 1 for x in scaled])
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(docs)):
            slope = y[i] * (w[docs[i]] @ scaled[i] + bias) - 1
            new = min(max(alpha[i] - slope / norm[i], 0.0), cost[i])
            if (step := (new - alpha[i]) * y[i]) != 0:
                w[docs[i]] += step * scaled[i]
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step) * norm[i] ** 0.5)
        if moved < 1e-3:
            break
    return w, bias


class Model:
    """Weights by n-gram number with the ratio already in them, bias, and the curve's slope and place."""

    def __init__(self, weights: np.ndarray, bias: float, slope: float, place: float):
        self.weights, self.bias, self.slope, self.place = weights.astype(np.float32), bias, slope, place

    def score(self, ids: np.ndarray) -> float:
        z = self.slope * (float(self.weights[ids].sum(dtype=np.float64)) + self.bias) + self.place
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def _machine(docs: list[np.ndarray], y: np.ndarray, cost: float) -> tuple[np.ndarray, float]:
    seen = [np.ones(TABLE), np.ones(TABLE)]
    for d, k in zip(docs, y):
        seen[int(k > 0)][d] += 1
    ratio = np.log(seen[1] / ((y > 0).sum() + 2)) - np.log(seen[0] / ((y < 0).sum() + 2))
    ratio[seen[0] + seen[1] < 4] = 0  # n-grams of a single text say nothing
    each = cost / np.maximum(1, np.array([len(d) for d in docs]).mean())
    w, bias = coordinate_descent(docs, y, ratio, np.full(len(docs), each))
    return w * ratio, bias


def _curve(margin: np.ndarray, y: np.ndarray, each: np.ndarray) -> tuple[float, float]:
    """Slope and place of a logistic curve by Newton's method, with smoothed goals."""
    goal = np.where(y > 0, 1 - 1 / (2 + (y > 0).sum()), 1 / (2 + (y < 0).sum()))
    scale = margin.std() or 1.0
    x, p = np.stack([margin / scale, np.ones(len(margin))], 1), np.array([1.0, 0.0])
    for _ in range(50):
        q = 1 / (1 + np.exp(-x @ p))
        h = (x * (each * q * (1 - q))[:, None]).T @ x + 1e-3 * np.eye(2) * each.sum() / len(each)
        step = np.linalg.solve(h, x.T @ (each * (goal - q)) - 1e-3 * np.array([p[0] - 1, p[1]]) * each.sum() / len(each))
        p = p + np.clip(step, -2, 2)
    return max(1e-6, p[0] / scale), p[1]


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 1000, cost: float = 1.0, seed: int = 11) -> Model:
    """A model from ``docs`` (``doc_id``, ``text``) and their ``labels`` (``doc_id``, ``label`` 0 or 1).

    The sample is drawn from the labels alone, so the scan of texts meets a broadcast of twice ``per_class`` ids at most."""
    rows = labels.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).select(F.col("label").cast("int").alias("label"), "doc_id")
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    constant = Model(np.zeros(TABLE), 0.0, 1.0, float(np.clip(np.log(((counts.get(1, 0)) + 0.5) / (counts.get(0, 0) + 0.5)), -20, 20)))
    if len(counts) < 2:
        return constant
    drawn = bounded_sample(rows, "label", F.xxhash64(F.lit(seed), "doc_id"), per_class)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(drawn), "doc_id")
    once = texts.groupBy("doc_id", "label", "u").agg(F.min("text").alias("text"))
    sample = once.select("text", "label", "u").mapInArrow(_sampled, "label int, u double, ids binary").collect()
    sample = sorted(sample, key=lambda r: (r["u"] * max(1.0, counts[r["label"]] / per_class), r["ids"]))
    docs, y = [np.frombuffer(r["ids"], dtype="<i4") for r in sample], np.array([1.0 if r["label"] else -1.0 for r in sample])
    if len(set(y)) < 2:
        return constant
    fold = np.arange(len(docs)) % 3
    margin = np.zeros(len(docs))
    for k in range(3):
        if len(set(y[fold != k])) == 2:
            w, bias = _machine([d for d, f in zip(docs, fold) if f != k], y[fold != k], cost)
            margin[fold == k] = [w[d].sum() + bias for d, f in zip(docs, fold) if f == k]
    w, bias = _machine(docs, y, cost)
    each = np.where(y > 0, counts[1] / total / (y > 0).mean(), counts[0] / total / (y < 0).mean())
    return Model(w, bias, *_curve(margin, y, each))


def _scores(shared, text: str):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        seen = np.zeros(TABLE, dtype=bool)
        for b in sliced(batches, text):
            score = np.array([model.score(_flags(t.as_py(), seen)) for t in b.column(text)], dtype=np.float64)
            keep = [c for c in b.schema.names if c != text]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(score), pa.array((score >= 0.5).astype(np.int32))], [*keep, "score", "predicted"])

    return of


def predict(docs: DataFrame, model: Model, keep: list[str | Column] | None = None) -> DataFrame:
    """``keep`` (default: all columns) plus ``score`` and ``predicted`` of each row."""
    kept = docs.select(*(docs.columns if keep is None else keep)).drop("score", "predicted")
    text = spare("text_", kept.columns)
    sent = docs.select(*(docs.columns if keep is None else keep), F.col("text").cast("string").alias(text)).drop("score", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 720,896 numbers
    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return sent.mapInArrow(_scores(shared, text), schema)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = ~held_out(F.col("doc_id"))
    labels = table(spark, sf_dir, "labels").where(fold).select("doc_id", F.col("quality").alias("label"))
    return predict(docs, fit(docs, labels), [F.col("doc_id"), held_out(F.col("doc_id")).alias("held_out")])
