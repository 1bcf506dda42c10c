"""Gradient-boosted trees in numpy: logistic loss, binned features, trees of a fixed depth grown level by level."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 16


@dataclass
class Trees:
    edges: list[np.ndarray]  # per feature, ascending; the bin is the number of edges below the value
    feature: np.ndarray  # (trees, inner nodes)
    cut: np.ndarray  # (trees, inner nodes): bins above go right
    leaf: np.ndarray  # (trees, leaves)
    base: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, i], "left") for i, e in enumerate(self.edges)], axis=1).astype(np.uint8) if len(x) else np.zeros(x.shape, np.uint8)

    def margin(self, x: np.ndarray) -> np.ndarray:
        """The log-odds of label 1."""
        binned, rows = self.bins(x), np.arange(len(x))
        out = np.full(len(x), self.base)
        depth = self.leaf.shape[1].bit_length() - 1
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (binned[rows, feature[node]] > cut[node])
            out += leaf[node - len(feature)]
        return out


def train(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.25, ridge: float = 2.0) -> Trees:
    edges = [np.unique(np.quantile(x[:, i], np.linspace(0, 1, BINS + 1)[1:-1])) for i in range(x.shape[1])]
    share = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    model = Trees(edges, np.zeros((trees, 2**depth - 1), np.int64), np.full((trees, 2**depth - 1), 255, np.int64), np.zeros((trees, 2**depth)), float(np.log(share / (1 - share))))
    binned = model.bins(x).astype(np.int64)
    margin = np.full(len(x), model.base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(x), np.int64)
        for level in range(depth):
            first, n = 2**level - 1, 2**level
            local = node - first
            gain, best = np.full(n, 1e-6), np.zeros((n, 2), np.int64)
            best[:, 1] = 255
            for i in range(x.shape[1]):
                key = local * BINS + binned[:, i]
                gs = np.cumsum(np.bincount(key, g, n * BINS).reshape(n, BINS), axis=1)
                hs = np.cumsum(np.bincount(key, h, n * BINS).reshape(n, BINS), axis=1)
                gr, hr = gs[:, -1:] - gs, hs[:, -1:] - hs
                score = gs**2 / (hs + ridge) + gr**2 / (hr + ridge) - gs[:, -1:] ** 2 / (hs[:, -1:] + ridge)
                at = score.argmax(axis=1)
                better = score[np.arange(n), at] > gain
                gain[better], best[better, 0], best[better, 1] = score[np.arange(n), at][better], i, at[better]
            model.feature[t, first : first + n], model.cut[t, first : first + n] = best[:, 0], best[:, 1]
            node = 2 * node + 1 + (binned[np.arange(len(x)), best[local, 0]] > best[local, 1])
        leaf = node - (2**depth - 1)
        model.leaf[t] = rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + ridge)
        margin += model.leaf[t][leaf]
    return model
