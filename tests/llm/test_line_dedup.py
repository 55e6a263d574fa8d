"""Line deduplication against plain Python, and the levels of its runs."""

import random
from collections import Counter

import pytest

from llm import line_dedup
from llm.common import materialize, shared_dir

DOCS = "doc_id long, text string, N_Lines string, _t1 long"
BLANK = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANK))


def brute(texts, min_docs, min_chars=1):
    split = [(t or "").split("\n") for t in texts]
    seen = Counter(k for ls in split for k in {key(x) for x in ls} if len(k) >= min_chars)
    kept = [[x for x in ls if seen[key(x)] < min_docs] for ls in split]
    return [(len(a), len(a) - len(b), "\n".join(b)) for a, b in zip(split, kept)]


def made(rng, n):
    common = ["Subscribe now", "  All RIGHTS reserved\t", "all rights reserved", "ÄÖ Über uns", "äö über uns", "x", "\x0b\x0c"]
    texts = []
    for i in range(n):
        lines = [rng.choice(common) if rng.random() < 0.3 else f"line {rng.randrange(3 * n)} of {i % 7}" for _ in range(rng.randint(1, 12))]
        texts.append(rng.choice(["\n", "\r\n"]).join(lines) + rng.choice(["", "\n", "\n\n"]))
    texts += [None, "", "\n", " \n\t\n", "ALL RIGHTS RESERVED ", "same text\nx"] + ["copied\nX\ncopied"] * 30
    texts.append("\n".join(rng.choice(common) if i % 3 else f"unique {i}" for i in range(20_000)))
    return texts


def rows(texts):
    return [(None if i % 11 == 0 else i // 2, t, "mine", i) for i, t in enumerate(texts)]


@pytest.mark.parametrize("min_docs, min_chars, batches, fan", [(10, 1, 4, 3), (2, 1, 1, 2), (3, 4, 5, 2), (1, 1, 2, 5)])
def test_equals_plain_counts(spark, min_docs, min_chars, batches, fan):
    texts = made(random.Random(min_docs), 80)
    docs = spark.createDataFrame(rows(texts), DOCS).repartition(5)
    got = line_dedup.apply(docs, min_docs, min_chars, batches, fan)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept_text"]
    want = [(r[0], *b) for r, b in zip(rows(texts), brute(texts, min_docs, min_chars))]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_kept_columns(spark):
    docs = spark.createDataFrame([(1, "a\na", "mine", 5)], DOCS)
    assert [tuple(r) for r in line_dedup.apply(docs, 2, keep=("_t1", "doc_id")).collect()] == [(5, 1, 2, 0, "a\na")]
    with pytest.raises(ValueError, match="N_Lines"):
        line_dedup.apply(docs, keep=("N_Lines",))


def test_empty(spark):
    assert line_dedup.apply(spark.createDataFrame([], DOCS)).collect() == []


def batch(spark, texts):
    return materialize(line_dedup.line_keys(spark.createDataFrame(rows(texts), DOCS)))


def test_levels(spark):
    """Nine batches with a fan of three: runs are merged three at a time, and at last all of them."""
    runs, shapes = line_dedup.LineRuns(spark, shared_dir(spark), fan=3), []
    for i in range(10):
        assert runs.add(batch(spark, ["a\nb", f"c{i}\na"])) == i
        shapes.append([r[0] for r in runs.runs()])
    assert shapes == [[0], [0, 0], [1], [1, 0], [1, 0, 0], [1, 1], [1, 1, 0], [1, 1, 0, 0], [2], [2, 0]]
    counts = sorted(r["_docs"] for r in runs.frequent(1).collect())
    assert counts == [1] * 10 + [10, 20]


def test_batch_by_batch(spark):
    """A later batch is cleaned by what all batches so far hold; another object over the same folder goes on from there."""
    path = shared_dir(spark)
    line_dedup.LineRuns(spark, path).add(batch(spark, ["old\nfirst", "old\nsecond"]))
    runs, new = line_dedup.LineRuns(spark, path), ["old\nnew", "only here"]
    docs = materialize(spark.createDataFrame(rows(new), DOCS))
    keys = materialize(line_dedup.line_keys(docs))
    runs.add(keys)
    assert sorted(r["kept_text"] for r in runs.clean(docs, keys, 3).collect()) == ["new", "only here"]


def test_broken_merge(spark):
    """A merge that stopped before its end, or before the runs it replaces were removed, changes no count."""
    path = shared_dir(spark)
    runs = line_dedup.LineRuns(spark, path, fan=9)
    for i in range(3):
        runs.add(batch(spark, ["a", f"b{i}"]))
    whole = runs._read(runs.runs())
    runs._put(whole, 1, 0, 2)
    runs._files.delete(runs._child("run-1-0-2/_SUCCESS"), False)
    assert [r[0] for r in runs.runs()] == [0, 0, 0]
    runs._put(whole, 1, 0, 2)
    assert runs.runs() == [(1, 0, 2)] and [r["_docs"] for r in runs.frequent(2).collect()] == [3]
    assert runs.add(batch(spark, ["a"])) == 3
