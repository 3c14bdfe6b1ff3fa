"""Gradient-boosted trees for two classes on numeric features, by histograms."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ROUNDS = 60
DEPTH = 4
RATE = 0.2
BINS = 32
SMOOTHING = 1.0
LEAST_WEIGHT = 1.0


@dataclass(frozen=True)
class Boosted:
    """Trees of equal depth: per tree and inner node a feature and a threshold, and per leaf a value."""

    features: np.ndarray
    thresholds: np.ndarray
    values: np.ndarray
    base: float

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.base)
        each = np.arange(len(rows))
        for feature, threshold, value in zip(self.features, self.thresholds, self.values):
            node = np.zeros(len(rows), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (rows[each, feature[node]] > threshold[node])
            total += value[node - len(feature)]
        return total


def fit(rows: np.ndarray, labels: np.ndarray) -> Boosted:
    """Second-order boosting of the logistic loss; splits at up to ``BINS`` quantiles of each feature."""
    width = rows.shape[1]
    edges = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
    binned = np.column_stack([np.searchsorted(edges[f], rows[:, f], side="left") for f in range(width)])
    rate = np.clip(labels.mean(), 0.01, 0.99)
    base = float(np.log(rate / (1 - rate)))
    margin = np.full(len(rows), base)
    inner = 2**DEPTH - 1
    trees = []
    for _ in range(ROUNDS):
        chance = 1 / (1 + np.exp(-margin))
        slope, weight = labels - chance, chance * (1 - chance)
        feature, threshold = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        node = np.zeros(len(rows), dtype=np.int64)
        for level in range(DEPTH):
            first, count = 2**level - 1, 2**level
            place = node - first
            best = np.zeros(count)
            cut_bin = np.full(count, BINS)
            for f in range(width):
                if not len(edges[f]):
                    continue
                cell = place * (BINS + 1) + binned[:, f]
                g = np.bincount(cell, slope, count * (BINS + 1)).reshape(count, -1).cumsum(axis=1)
                h = np.bincount(cell, weight, count * (BINS + 1)).reshape(count, -1).cumsum(axis=1)
                whole_g, whole_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + SMOOTHING) + (whole_g - g) ** 2 / (whole_h - h + SMOOTHING) - whole_g**2 / (whole_h + SMOOTHING)
                gain[(h < LEAST_WEIGHT) | (whole_h - h < LEAST_WEIGHT)] = 0
                gain = gain[:, : len(edges[f])]
                at = gain.argmax(axis=1)
                top = gain[np.arange(count), at]
                better = top > best + 1e-9
                best[better], cut_bin[better] = top[better], at[better]
                feature[first : first + count][better] = f
                threshold[first : first + count][better] = edges[f][at[better]]
            node = 2 * node + 1 + (binned[np.arange(len(rows)), feature[node]] > cut_bin[place])
        leaf = node - inner
        g, h = np.bincount(leaf, slope, inner + 1), np.bincount(leaf, weight, inner + 1)
        value = RATE * g / (h + SMOOTHING)
        margin += value[leaf]
        trees.append((feature, threshold, value))
    features, thresholds, values = (np.array(part) for part in zip(*trees))
    return Boosted(features, thresholds, values, base)
