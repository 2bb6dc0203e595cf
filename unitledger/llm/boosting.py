"""Gradient-boosted trees in numpy, with monotonic features; trained on a bounded sample.

A trained model is a few arrays: every tree is a complete binary tree whose nodes lie in level
order, so all documents walk all trees at once, one level per step.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 64


@dataclass(frozen=True)
class Trees:
    """`feature` and `threshold` per tree and inner node, `value` per tree and leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    start: float
    cut: float = 0.5

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of the class 1 for each row."""
        trees, inner = self.feature.shape
        node = np.zeros((len(x), trees), dtype=np.int64)
        rows, tree = np.arange(len(x))[:, None], np.arange(trees)[None, :]
        for _ in range(int(np.log2(inner + 1))):
            right = x[rows, self.feature[tree, node]] > self.threshold[tree, node]
            node = 2 * node + 1 + right
        margin = self.start + self.value[tree, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-margin))


def train(
    x: np.ndarray, y: np.ndarray, monotone: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, smooth: float = 5.0
) -> Trees:
    """Boosting of the logistic loss. `monotone` holds +1 (score never falls as the feature rises),
    -1 (never rises) or 0 for each feature."""
    n, features = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(features)]
    binned = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(features)], axis=1)
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    start = float(np.log(share / (1 - share)))
    margin = np.full(n, start)
    inner = 2**depth - 1
    feature = np.zeros((trees, inner), dtype=np.int64)
    threshold = np.full((trees, inner), np.inf)
    value = np.zeros((trees, inner + 1))
    offset = np.arange(features) * BINS
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        slope, weight = y - p, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        low, high = np.full(1, -np.inf), np.full(1, np.inf)
        own = np.clip(np.array([slope.sum() / (weight.sum() + smooth)]), low, high)
        for level in range(depth):
            count = 2**level
            at = (node * features * BINS)[:, None] + offset[None, :] + binned
            shape = (count, features, BINS)
            g = np.bincount(at.ravel(), np.repeat(slope, features), count * features * BINS).reshape(shape).cumsum(axis=2)
            h = np.bincount(at.ravel(), np.repeat(weight, features), count * features * BINS).reshape(shape).cumsum(axis=2)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            left = np.clip(g / (h + smooth), low[:, None, None], high[:, None, None])
            right = np.clip((all_g - g) / (all_h - h + smooth), low[:, None, None], high[:, None, None])
            gain = 2 * left * g - left**2 * (h + smooth) + 2 * right * (all_g - g) - right**2 * (all_h - h + smooth)
            gain = gain - (2 * own * all_g[:, 0, 0] - own**2 * (all_h[:, 0, 0] + smooth))[:, None, None]
            wrong = (monotone[None, :, None] * (right - left) < 0) | (h < 1) | (all_h - h < 1)
            for f in range(features):
                wrong[:, f, len(edges[f]) :] = True
            gain[wrong] = -np.inf
            flat = gain.reshape(count, -1)
            best = flat.argmax(axis=1)
            split = flat[np.arange(count), best] > 1e-6
            f, b = best // BINS, best % BINS
            place = count - 1 + np.arange(count)
            feature[t, place[split]] = f[split]
            threshold[t, place[split]] = [edges[i][j] for i, j in zip(f[split], b[split])]
            l, r = left[np.arange(count), f, b], right[np.arange(count), f, b]
            middle = (l + r) / 2
            new_low, new_high, new_own = (np.repeat(v, 2) for v in (low, high, own))
            for k in np.flatnonzero(split):
                new_own[2 * k], new_own[2 * k + 1] = l[k], r[k]
                if monotone[f[k]] > 0:
                    new_high[2 * k], new_low[2 * k + 1] = min(high[k], middle[k]), max(low[k], middle[k])
                elif monotone[f[k]] < 0:
                    new_low[2 * k], new_high[2 * k + 1] = max(low[k], middle[k]), min(high[k], middle[k])
            goes_right = split[node] & (binned[np.arange(n), f[node]] > b[node])
            node = 2 * node + goes_right
            low, high, own = new_low, new_high, new_own
        value[t] = rate * own
        margin += value[t][node]
    return Trees(feature, threshold, value, start)
