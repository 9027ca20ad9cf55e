"""A small gradient-boosted tree classifier (logistic loss, histogram splits) in numpy: fitted
on a bounded sample, evaluated on whole batches inside tasks."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Boosted:
    """Complete trees of one depth: split features, thresholds (go right if above) and leaves."""
    depth: int
    bias: float = 0.0
    feature: list[np.ndarray] = field(default_factory=list)
    above: list[np.ndarray] = field(default_factory=list)
    leaf: list[np.ndarray] = field(default_factory=list)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for f, a, leaf in zip(self.feature, self.above, self.leaf):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, f[at]] > a[at])
            out += leaf[at - (1 << self.depth) + 1]
        return out


def fit(x: np.ndarray, y: np.ndarray, *, trees: int = 40, depth: int = 4, rate: float = 0.25, bins: int = 32, ridge: float = 2.0) -> Boosted:
    """Fit on rows ``x`` with labels ``y`` (0/1); deterministic."""
    n, k = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(k)]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1).astype(np.int64)
    p = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    model = Boosted(depth, float(np.log(p / (1 - p))))
    score = np.full(n, model.bias)
    column = np.arange(k) * bins
    for _ in range(trees):
        prob = 1 / (1 + np.exp(-score))
        grad, hess = y - prob, prob * (1 - prob) + 1e-6
        at = np.zeros(n, np.int64)
        feature, above = np.zeros((1 << depth) - 1, np.int64), np.full((1 << depth) - 1, np.inf)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            slot = ((at - first)[:, None] * (k * bins) + column + binned).ravel()
            g = np.bincount(slot, np.repeat(grad, k), width * k * bins).reshape(width, k, bins)
            h = np.bincount(slot, np.repeat(hess, k), width * k * bins).reshape(width, k, bins)
            gl, hl = g.cumsum(2), h.cumsum(2)
            gt, ht = gl[:, :, -1:], hl[:, :, -1:]
            gain = gl**2 / (hl + ridge) + (gt - gl)**2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
            for node in range(width):
                j, b = np.unravel_index(int(gain[node].argmax()), (k, bins))
                if gain[node, j, b] > 1e-6 and b < len(edges[j]):
                    feature[first + node], above[first + node] = j, edges[j][b]
            at = 2 * at + 1 + (x[np.arange(n), feature[at]] > above[at])
        leaf_at = at - (1 << depth) + 1
        leaf = rate * np.bincount(leaf_at, grad, 1 << depth) / (np.bincount(leaf_at, hess, 1 << depth) + ridge)
        model.feature.append(feature)
        model.above.append(above)
        model.leaf.append(leaf)
        score = score + leaf[leaf_at]
    return model
