"""Gradient-boosted trees on binned features in numpy, with a logistic loss and Platt calibration."""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np

ROUNDS = 60
DEPTH = 3
RATE = 0.2
BINS = 32
# Regularisation of leaf values, and the least weight of a leaf.
SHRINK = 1.0
LEAST_WEIGHT = 1.0


@dataclass
class BoostedTrees:
    """Complete trees of one depth: a feature and a threshold per inner node, a value per leaf."""

    start: float
    feature: np.ndarray  # (trees, inner nodes)
    threshold: np.ndarray  # (trees, inner nodes); a value above it goes right
    value: np.ndarray  # (trees, leaves)
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        inner = self.feature.shape[1]
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            while inner and node[0] < inner if len(node) else False:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += value[node - inner]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margin(x) + self.shift, -30, 30)))

    def calibrated(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        """With slope and shift of the margins fitted to held-out labels, smoothed towards the middle (Platt)."""
        if not len(y):
            return self
        m, n1, n0 = self.margin(x), y.sum(), (1 - y).sum()
        target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        w = np.array([1.0, 0.0])
        design = np.stack([m, np.ones(len(m))], axis=1)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
            gradient = design.T @ (p - target) + 1e-6 * w
            hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
            step = np.linalg.solve(hessian, gradient)
            w = w - step
            if np.abs(step).max() < 1e-8:
                break
        return replace(self, slope=float(max(w[0], 1e-3)), shift=float(w[1]))


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, depth: int = DEPTH) -> BoostedTrees:
    """Trees grown level by level on histograms of gradients; ties go to the first feature and bin, so refits agree."""
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    inner, leaves = 2**depth - 1, 2**depth
    rate = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    start = float(np.log(rate / (1 - rate)))
    margin = np.full(n, start)
    features, thresholds, values = [], [], []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        gradient, weight = p - y, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(n, np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            best = np.full(count, 1e-9)
            for f, e in enumerate(edges):
                cell = (node - first) * (BINS + 1) + binned[:, f]
                g = np.cumsum(np.bincount(cell, gradient, count * (BINS + 1)).reshape(count, -1), axis=1)
                h = np.cumsum(np.bincount(cell, weight, count * (BINS + 1)).reshape(count, -1), axis=1)
                g, h, all_g, all_h = g[:, : len(e)], h[:, : len(e)], g[:, -1:], h[:, -1:]
                if not len(e):
                    continue
                gain = g**2 / (h + SHRINK) + (all_g - g) ** 2 / (all_h - h + SHRINK) - all_g**2 / (all_h + SHRINK)
                gain = np.where((h >= LEAST_WEIGHT) & (all_h - h >= LEAST_WEIGHT), gain, 0)
                at = gain.argmax(axis=1)
                top = gain[np.arange(count), at]
                better = np.flatnonzero(top > best + 1e-12)
                best[better] = top[better]
                feature[first + better], threshold[first + better] = f, e[at[better]]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        leaf = node - inner
        value = -RATE * np.bincount(leaf, gradient, leaves) / (np.bincount(leaf, weight, leaves) + SHRINK)
        margin += value[leaf]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return BoostedTrees(start, np.array(features), np.array(thresholds), np.array(values))
