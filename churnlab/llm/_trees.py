"""Histogram gradient-boosted trees for a 0/1 label, on a bounded sample.

Features are cut at quantiles; each round grows one tree level by level from
histograms of the logistic loss's gradients. Trees are complete binary trees in
arrays, so that all rows walk a level at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    base: float
    feature: np.ndarray    # (trees, 2**depth - 1)
    threshold: np.ndarray  # same shape; a row goes right if its value is above
    leaf: np.ndarray       # (trees, 2**depth)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for f, t, v in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(inner.bit_length()):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            total += v[node - inner]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64,
        penalty: float = 1.0, least: float = 2.0) -> Trees:
    """``least``: the smallest sum of second derivatives in a leaf. Without both
    labels the score is the (smoothed) share of label 1 everywhere."""
    n, m = x.shape
    share = (y.sum() + 0.5) / (n + 1)
    base = float(np.log(share / (1 - share)))
    inner = 2 ** depth - 1
    if not n or y.min() == y.max():
        return Trees(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    total = np.full(n, base)
    features, thresholds, leaves = [], [], []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            local = node - first
            gain = np.zeros((m, width))
            at = np.zeros((m, width), np.int64)
            for j in range(m):
                key = local * bins + binned[:, j]
                gl = np.cumsum(np.bincount(key, g, width * bins).reshape(width, bins), axis=1)
                hl = np.cumsum(np.bincount(key, h, width * bins).reshape(width, bins), axis=1)
                gt, ht = gl[:, -1:], hl[:, -1:]
                gains = gl ** 2 / (hl + penalty) + (gt - gl) ** 2 / (ht - hl + penalty) - gt ** 2 / (ht + penalty)
                gains[(hl < least) | (ht - hl < least)] = 0
                gains[:, len(edges[j]):] = 0
                at[j] = gains.argmax(axis=1)
                gain[j] = gains.max(axis=1)
            best = gain.argmax(axis=0)
            for k in range(width):
                j = best[k]
                if gain[j, k] > 1e-9:
                    feature[first + k], threshold[first + k] = j, edges[j][at[j, k]]
            value = x[np.arange(n), feature[node]]
            node = 2 * node + 1 + (value > threshold[node])
        local = node - inner
        leaf = rate * np.bincount(local, g, inner + 1) / (np.bincount(local, h, inner + 1) + penalty)
        total += leaf[local]
        features.append(feature)
        thresholds.append(threshold)
        leaves.append(leaf)
    return Trees(base, np.array(features), np.array(thresholds), np.array(leaves))
