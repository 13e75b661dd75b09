"""Histogram gradient-boosted trees for two classes, in numpy.

Training runs on a bounded sample: features are cut into at most ``bins`` bins at
quantiles, and trees of a fixed depth are grown level by level from histograms of
gradients.  A model is a few flat arrays, and all rows go down a tree at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class BoostedTrees:
    """Complete trees, flattened: node n has children 2n+1 and 2n+2.

    ``feature`` and ``threshold`` are (trees, inner nodes), ``value`` is (trees, leaves).
    A row goes right where its feature exceeds the threshold.
    """

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row of features (NaN goes left)."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            while inner and node[0:1].size and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node - inner]
        return 1.0 / (1.0 + np.exp(-total))


def fit_trees(
    x: np.ndarray,
    y: np.ndarray,
    *,
    trees: int = 80,
    depth: int = 4,
    bins: int = 64,
    rate: float = 0.15,
    penalty: float = 1.0,
    least_weight: float = 2.0,
) -> BoostedTrees:
    """Logistic boosting.  Without rows the score is 0.5; with one class only it is
    the smoothed share of class 1."""
    n, width = x.shape
    inner = 2**depth - 1
    share = (float(y.sum()) + 1.0) / (n + 2.0)
    base = float(np.log(share / (1.0 - share)))
    if n == 0 or y.min() == y.max():
        return BoostedTrees(
            base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1))
        )
    cuts = []
    code = np.empty((n, width), np.int64)
    for f in range(width):
        edges = np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1]))
        cuts.append(edges)
        code[:, f] = np.searchsorted(edges, x[:, f], side="left") + f * bins
    total = np.full(n, base)
    features = np.zeros((trees, inner), np.int64)
    thresholds = np.full((trees, inner), np.inf)
    values = np.zeros((trees, inner + 1))
    for t in range(trees):
        p = 1.0 / (1.0 + np.exp(-total))
        grad, hess = y - p, p * (1.0 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, many = 2**level - 1, 2**level
            slot = ((node - first)[:, None] * (width * bins) + code).ravel()
            size = many * width * bins
            g = np.bincount(slot, np.repeat(grad, width), size).reshape(many, width, bins)
            h = np.bincount(slot, np.repeat(hess, width), size).reshape(many, width, bins)
            gl, hl = g.cumsum(2), h.cumsum(2)
            gt, ht = gl[:, :1, -1:], hl[:, :1, -1:]
            gain = (
                gl**2 / (hl + penalty) + (gt - gl) ** 2 / (ht - hl + penalty) - gt**2 / (ht + penalty)
            )
            gain[(hl < least_weight) | (ht - hl < least_weight)] = 0.0
            flat = gain.reshape(many, -1)
            best = flat.argmax(1)
            for k in range(many):
                f, b = divmod(int(best[k]), bins)
                if flat[k, best[k]] > 1e-9 and b < len(cuts[f]):
                    features[t, first + k] = f
                    thresholds[t, first + k] = cuts[f][b]
            node = 2 * node + 1 + (x[np.arange(n), features[t, node]] > thresholds[t, node])
        leaf = node - inner
        g = np.bincount(leaf, grad, inner + 1)
        h = np.bincount(leaf, hess, inner + 1)
        values[t] = rate * g / (h + penalty)
        total += values[t, leaf]
    return BoostedTrees(base, features, thresholds, values)
