"""Language identification by a string kernel.

The kernel is the blended spectrum: how many of the byte n-grams (n = 1, 2, 3) of the lower-cased text two texts share, each
counted once, over the root of the product of their numbers.  Nyström landmarks, some texts of every language, turn it into
a short vector for each text, and one-versus-rest kernel ridge regression gives a value for each language.  Scoring is a
product of the batch's matrix of n-gram flags with that of the landmarks.

The model is fitted on a bounded sample: ``per_language`` different texts of each language at most, ``landmarks`` of them as
landmarks; the driver gets one row for each language and the n-gram numbers of that sample, at most 196,608 a text.
Learned from: text and non-null lang of the rows that ``fold`` allows.  Used for a prediction: the text alone.

Defined results for odd input: ``und`` and score 0 for a null text, one without letters, and when nothing could be learned.
Texts of any length are read whole, in steps.  Rows are judged on their own, so repeated rows give repeated results; ties
between languages go to the first by name.  An empty table gives an empty result; extra columns pass through, save ones named
like added columns, which are replaced.
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

SIZES = (1, 2, 3)
BATCH = 256


def _flags(text: str, seen: np.ndarray) -> None:
    seen[:] = False
    ngrams.flag(seen, text.lower().encode("utf-8", "replace"), SIZES)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = np.zeros(len(SIZES) << ngrams.BITS, dtype=bool)
    for b in batches:
        ids = []
        for t in b.column("text"):
            _flags(t.as_py(), seen)
            ids.append(np.flatnonzero(seen).astype("<i4").tobytes())
        yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("u"), pa.array(ids, pa.binary())], ["lang", "u", "ids"])


class Model:
    """Landmarks, the n-grams they have, and the regression's weights."""

    def __init__(self, langs: list[str], columns: np.ndarray, marks: np.ndarray, sizes: np.ndarray, weights: np.ndarray):
        self.langs, self.columns, self.marks, self.sizes, self.weights = langs, columns, marks, sizes, weights

    def kernel(self, flags: np.ndarray, totals: np.ndarray) -> np.ndarray:
        return (flags @ self.marks.T) / np.sqrt(np.maximum(totals, 1)[:, None] * self.sizes[None, :])

    def values(self, flags: np.ndarray, totals: np.ndarray) -> np.ndarray:
        return self.kernel(flags, totals) @ self.weights


def fit(rows: DataFrame, per_language: int = 250, landmarks: int = 32, ridge: float = 1e-3, seed: int = 7) -> Model | None:
    """A model from rows of ``text`` and ``lang``; None where no row has both."""
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}")).select("lang", F.col("text").cast("string").alias("text"))
    sample = bounded_sample(rows, "lang", F.xxhash64(F.lit(seed), "text"), per_language).mapInArrow(_sampled, "lang string, u double, ids binary").collect()
    by: dict[str, list[np.ndarray]] = {}
    for r in sorted(sample, key=lambda r: (r["u"], r["ids"])):
        by.setdefault(r["lang"], []).append(np.frombuffer(r["ids"], dtype="<i4"))
    langs = sorted(by)
    if not langs:
        return None
    marks = [ids for x in langs for ids in by[x][:landmarks]]
    columns = np.unique(np.concatenate(marks))

    def matrix(docs: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(docs), len(columns)), dtype=np.float32)
        for row, ids in zip(out, docs):
            at = np.searchsorted(columns, ids)
            at[at == len(columns)] = 0
            row[at[columns[at] == ids]] = 1
        return out

    model = Model(langs, columns, matrix(marks), np.array([len(x) for x in marks], dtype=np.float64), np.zeros((len(marks), len(langs))))
    inner = model.kernel(model.marks, model.sizes)
    value, vector = np.linalg.eigh((inner + inner.T) / 2)
    keep = value > 1e-6 * value.max()
    root = vector[:, keep] / np.sqrt(value[keep])
    docs = [(ids, i) for i, x in enumerate(langs) for ids in by[x]]
    phi = np.concatenate([model.kernel(matrix([d for d, _ in docs[k : k + BATCH]]), np.array([len(d) for d, _ in docs[k : k + BATCH]])) for k in range(0, len(docs), BATCH)]) @ root
    y = np.array([i for _, i in docs])
    each = 1 / np.bincount(y, minlength=len(langs))[y]  # languages count alike
    goal = np.where(y[:, None] == np.arange(len(langs)), 1.0, -1.0)
    model.weights = root @ np.linalg.solve(phi.T @ (phi * each[:, None]) + ridge * np.eye(phi.shape[1]), phi.T @ (goal * each[:, None]))
    return model


def _scores(shared, text: str, drop: bool):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        seen = np.zeros(len(SIZES) << ngrams.BITS, dtype=bool)
        flags = np.zeros((BATCH, len(model.columns)), dtype=np.float32)
        for b in sliced(batches, text, BATCH):
            lang, score, at, totals = ["und"] * b.num_rows, np.zeros(b.num_rows), [], []
            for i, held in enumerate(b.column(text)):
                t = held.as_py()
                if t and any(map(str.isalpha, t)):
                    _flags(t, seen)
                    flags[len(at)] = seen[model.columns]
                    at.append(i)
                    totals.append(np.count_nonzero(seen))
            if at:
                v = np.maximum(model.values(flags[: len(at)], np.array(totals, dtype=np.float64)) + 1, 1e-6)
                best = v.argmax(1)
                p = v[np.arange(len(at)), best] / v.sum(1)
                for i, k, s in zip(at, best, p):
                    lang[i], score[i] = model.langs[k], min(1.0, float(s))
            keep = [c for c in b.schema.names if not (drop and c == text)]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(lang, pa.string()), pa.array(score)], [*keep, "lang_pred", "score"])

    return of


def predict(docs: DataFrame, model: Model | None, keep: list[str | Column] | None = None) -> DataFrame:
    """``keep`` (default: all columns) plus ``lang_pred`` and ``score`` of each row."""
    kept = docs.select(*(docs.columns if keep is None else keep)).drop("lang_pred", "score")
    if model is None:
        return kept.select("*", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most landmarks x 196,608 numbers
    schema = T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    if keep is None and kept.schema["text"].dataType == T.StringType():
        return kept.mapInArrow(_scores(shared, "text", False), schema)
    text = spare("text_", kept.columns)  # one copy of the text only
    sent = docs.select(*(docs.columns if keep is None else keep), F.col("text").cast("string").alias(text)).drop("lang_pred", "score")
    return sent.mapInArrow(_scores(shared, text, True), schema)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    return predict(docs, model, [F.col("doc_id"), held_out(F.col("doc_id")).alias("held_out")])
