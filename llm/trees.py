"""Gradient-boosted trees for a yes-or-no goal, in NumPy: complete trees of one depth, split on binned features."""

from __future__ import annotations

import numpy as np


class Boosted:
    """Trees as arrays: for each inner node a feature and a bound (right if above), for each leaf a value."""

    def __init__(self, depth: int, start: float):
        self.depth, self.start = depth, start
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def values(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.start), np.arange(len(x))
        for feature, bound, leaf in self.trees:
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > bound[at])
            out += leaf[at - len(feature)]
        return out

    def chance(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.values(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 4, rate: float = 0.3, bins: int = 32, ridge: float = 1.0, least: float = 3.0) -> Boosted:
    """Newton boosting of the logistic loss; every split is the best over all features' bins."""
    n, f = x.shape
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], 1).astype(np.int64)
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    model = Boosted(depth, float(np.log(share / (1 - share))))
    value = np.full(n, model.start)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-value))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        feature, bound, at = np.zeros(2**depth - 1, dtype=np.int64), np.full(2**depth - 1, np.inf), np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            best = np.full(width, 1e-9)
            for j in range(f):
                if not len(edges[j]):
                    continue
                cell = (at - first) * bins + binned[:, j]
                gs = np.bincount(cell, g, width * bins).reshape(width, bins)
                hs = np.bincount(cell, h, width * bins).reshape(width, bins)
                gl, hl = gs.cumsum(1)[:, :-1], hs.cumsum(1)[:, :-1]
                ga, ha = gs.sum(1, keepdims=True), hs.sum(1, keepdims=True)
                gain = gl**2 / (hl + ridge) + (ga - gl) ** 2 / (ha - hl + ridge) - ga**2 / (ha + ridge)
                gain[(hl < least / 4) | (ha - hl < least / 4)] = 0
                gain = gain[:, : len(edges[j])]
                k = gain.argmax(1)
                top = gain[np.arange(width), k]
                better = top > best
                best[better] = top[better]
                feature[first : first + width][better] = j
                bound[first : first + width][better] = edges[j][k[better]]
            at = 2 * at + 1 + (x[np.arange(n), feature[at]] > bound[at])
        at -= len(feature)
        leaf = rate * np.bincount(at, g, 2**depth) / (np.bincount(at, h, 2**depth) + ridge)
        value += leaf[at]
        model.trees.append((feature, bound, leaf))
    return model
