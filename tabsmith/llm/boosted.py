"""Gradient-boosted trees over binned features (logistic loss), in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    """Complete trees of one depth: per tree and inner node a feature and the
    bound above which a row goes right; per leaf a value."""
    base: float
    features: np.ndarray
    bounds: np.ndarray
    leaves: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        depth = int(np.log2(self.leaves.shape[1])) if len(self.leaves) else 0
        for feature, bound, leaf in zip(self.features, self.bounds, self.leaves, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > bound[at])
            out += leaf[at - (len(leaf) - 1)]
        return out


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 100, depth: int = 4, rate: float = 0.2,
        bins: int = 32, hold: float = 1.0) -> Forest:
    n, k = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(k)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    mean = np.clip((weight * y).sum() / weight.sum(), 1e-3, 1 - 1e-3)
    base = float(np.log(mean / (1 - mean)))
    margin = np.full(n, base)
    inner = (1 << depth) - 1
    out_f, out_b, out_v = [], [], []
    column = np.arange(k) * bins
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        slope, curve = weight * (y - p), weight * p * (1 - p)
        feature, bound = np.zeros(inner, np.int64), np.full(inner, np.inf)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            place = ((at - first)[:, None] * (k * bins) + column + binned).ravel()
            g = np.bincount(place, np.repeat(slope, k), width * k * bins).reshape(width, k, bins)
            h = np.bincount(place, np.repeat(curve, k), width * k * bins).reshape(width, k, bins)
            gl, hl = g.cumsum(axis=2)[:, :, :-1], h.cumsum(axis=2)[:, :, :-1]
            gt, ht = g.sum(axis=2, keepdims=True), h.sum(axis=2, keepdims=True)
            gain = gl ** 2 / (hl + hold) + (gt - gl) ** 2 / (ht - hl + hold) - gt ** 2 / (ht + hold)
            best = gain.reshape(width, -1).argmax(axis=1)
            for i in range(width):
                f, b = divmod(int(best[i]), bins - 1)
                if gain[i, f, b] > 1e-9 and b < len(edges[f]):
                    feature[first + i], bound[first + i] = f, edges[f][b]
            at = 2 * at + 1 + (x[np.arange(n), feature[at]] > bound[at])
        leaf = at - inner
        value = rate * np.bincount(leaf, slope, inner + 1) / (np.bincount(leaf, curve, inner + 1) + hold)
        margin += value[leaf]
        out_f.append(feature)
        out_b.append(bound)
        out_v.append(value)
    return Forest(base, np.array(out_f), np.array(out_b), np.array(out_v))
