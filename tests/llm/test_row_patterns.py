"""Row patterns against Python's regular expressions."""

import hashlib
import math
import random
import re
from datetime import datetime, timedelta

import pytest

from llm import row_patterns

CLICKS = "client_id long, ts timestamp_ntz, click_id long, kind string, value double, arrived_at timestamp_ntz"
START = datetime(2024, 1, 1)


def brute(rows):
    """Matches by the stated search: a letter set for each row, then for each start the reluctant expression, shortest first."""
    kept = {r for r in rows if r[0] is not None and r[1] is not None}
    low = lambda x: (x is not None, x)
    out = []
    for client in {r[0] for r in kept}:
        seq = []
        for r in kept:
            if r[0] == client:
                fine = r[4] is not None and math.isfinite(r[4]) and abs(r[4]) < 9e16
                seq.append((r[1], r[2], math.floor(100 * r[4] + 0.5) if fine else None, 2 if r[3] == "purchase" else 0 if r[3] in (None, "error") else 1))
        seq.sort(key=lambda x: (x[0], low(x[1]), low(x[2]), x[3]))
        near = [i > 0 and seq[i][0] - seq[i - 1][0] <= timedelta(minutes=10) and seq[i][2] is not None for i in range(len(seq))]
        letter = ["x"] * len(seq)
        for i, (_, _, c, k) in enumerate(seq):
            if near[i] and k and seq[i - 1][2] is not None and c != seq[i - 1][2]:
                letter[i] = "D" if c < seq[i - 1][2] else "U"
        at, number = 0, 0
        while at < len(seq):
            end = None
            if seq[at][2] is not None:
                for e in range(at + 1, len(seq)):
                    if near[e] and seq[e][3] == 2 and seq[e][2] >= seq[at][2]:
                        end = e
                        break
                    if letter[e] == "x":
                        break
            if end is None:
                at += 1
                continue
            number += 1
            labels = "A" + "".join(letter[at + 1 : end]) + "P"
            assert re.fullmatch("A[DU]*?P", labels)
            total = sum(x[2] for x in seq[at : end + 1])
            out.append((client, number, seq[at][1], seq[end][1], end + 1 - at, total if abs(total) < 2**63 else None, hashlib.sha256(labels.encode()).hexdigest()))
            at = end + 1
    return sorted(out)


def made(rng, clients, n, calm):
    """Rows whose runs are long (``calm``: nearly no row that breaks one), with few goals, ties, nulls and repeated rows."""
    rows, now = [], {c: START for c in range(clients)}
    for i in range(n):
        c = 0 if rng.random() < 0.5 else rng.randrange(clients)
        now[c] += timedelta(seconds=rng.choice([0, 5, 60, 600]) if rng.random() < calm else 601)
        kind = "purchase" if rng.random() < 0.05 else rng.choice(["view", "click"]) if rng.random() < calm else rng.choice([None, "error"])
        value = rng.choice([rng.uniform(-5, 90), rng.uniform(0, 500)]) if rng.random() < calm else rng.choice([None, 7.0, math.nan, math.inf, 1e300])
        rows.append((c, now[c], i if rng.random() < 0.99 else None, kind, value, None))
    rows += rng.sample(rows, n // 10)
    rows += [(None, START, 1, "view", 2.0, None), (1, None, 2, "purchase", 2.0, None), (9, START, 1, "view", 5.0, START), (9, START, 1, "purchase", 5.0, None), (9, START, 1, "purchase", 6.0, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, clients, n, calm, blocks", [(1, 3, 400, 0.999, 23), (2, 4, 600, 0.97, 7), (3, 1, 300, 1.0, 40), (4, 12, 500, 0.9, 1), (5, 2, 500, 0.995, 31)])
def test_equals_the_expression(spark, seed, clients, n, calm, blocks):
    rows = made(random.Random(seed), clients, n, calm)
    got = sorted(tuple(r) for r in row_patterns.apply(spark.createDataFrame(rows, CLICKS), blocks=blocks).collect())
    assert got == brute(rows)


def test_match_over_many_blocks(spark):
    """One A whose P comes after all other rows: the match goes through every block, and what it skips must not be found."""
    rows = [(1, START, 0, "view", 1000.0, None)] + [(1, START + timedelta(seconds=i), i, "purchase" if i % 9 == 0 else "view", float(i % 7), None) for i in range(1, 400)]
    rows.append((1, START + timedelta(seconds=400), 400, "purchase", 1000.0, None))
    rows.append((1, START + timedelta(seconds=401), 401, "purchase", 1000.0, None))
    got = sorted(tuple(r) for r in row_patterns.apply(spark.createDataFrame(rows, CLICKS), blocks=16).collect())
    assert got == brute(rows) and got[0][4] == 401


def test_large_cents(spark):
    rows = [(1, START + timedelta(seconds=i), i, "purchase" if i == 9 else "view", (8.9 + i / 1000) * 1e15, None) for i in range(10)]
    rows += [(2, START + timedelta(seconds=i), i, "purchase" if i == 300 else "view", (8.9 + i / 10_000) * 1e16, None) for i in range(301)]
    got = sorted(tuple(r) for r in row_patterns.apply(spark.createDataFrame(rows, CLICKS), blocks=5).collect())
    assert got == brute(rows) and got[1][5] is None


def test_other_types_and_names(spark):
    rows = [("a", START, "k1", "view", 1.0, 1), ("a", START, "k2", "purchase", 1.0, 2), ("a", START, "k3", "purchase", 1.0, 3)]
    df = spark.createDataFrame(rows, "client string, ts timestamp, click_id string, kind string, value float, Block long")
    got = row_patterns.apply(df, by="client", blocks=3)
    assert got.columns == ["client_id", "match_no", "first_id", "last_id", "n_rows", "sum_cents", "labels_sha256"]
    assert [tuple(r)[:6] for r in got.collect()] == [("a", 1, "k1", "k2", 2, 200)]


def test_empty(spark):
    got = row_patterns.apply(spark.createDataFrame([], CLICKS), blocks=4)
    assert got.columns == ["client_id", "match_no", "first_id", "last_id", "n_rows", "sum_cents", "labels_sha256"] and got.count() == 0
