"""Small gradient-boosted trees with monotonic constraints, kept as flat node arrays."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Forest(NamedTuple):
    """Trees of one depth as arrays (tree, node); node i has children 2i + 1 and 2i + 2, leaves come last."""
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float


def _sums(binned: np.ndarray, rows: np.ndarray, grad: np.ndarray, hess: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and hessian sums by feature and bin of the given rows."""
    cols = binned.shape[1]
    cell = (binned[rows] + np.arange(cols) * bins).ravel()
    sums = [np.bincount(cell, np.repeat(x[rows], cols), cols * bins).reshape(cols, bins) for x in (grad, hess)]
    return sums[0], sums[1]


def fit(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.2,
        bins: int = 32, ridge: float = 1.0, least: float = 5.0) -> Forest:
    """Boost logistic loss; ``monotone`` holds -1, 0 or 1 a feature. Without both classes the score is the base alone.

    A split on a constrained feature must order its children, and the middle of the two bounds all values below,
    so that the score as a whole is monotonic in that feature.
    """
    inner, nodes = 2 ** depth - 1, 2 ** (depth + 1) - 1
    mean = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
    base = float(np.log(mean / (1 - mean)))
    if len(np.unique(y)) < 2:
        return Forest(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, nodes)), base)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, x.T)])
    feature, threshold, value = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, nodes))
    score = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        grad, hess = y - p, np.maximum(p * (1 - p), 1e-6)
        rows, bounds = {0: np.arange(len(y))}, {0: (-np.inf, np.inf)}
        for node in range(nodes):
            at, (low, high) = rows.pop(node), bounds.pop(node)
            value[t, node] = np.clip(grad[at].sum() / (hess[at].sum() + ridge), low, high)
            if node >= inner:
                score[at] += rate * value[t, node]
                continue
            g, h = (s.cumsum(axis=1)[:, :-1] for s in _sums(binned, at, grad, hess, bins))
            g_all, h_all = grad[at].sum(), hess[at].sum()
            left, right = np.clip(g / (h + ridge), low, high), np.clip((g_all - g) / (h_all - h + ridge), low, high)
            gain = g * left - 0.5 * (h + ridge) * left ** 2 + (g_all - g) * right - 0.5 * (h_all - h + ridge) * right ** 2
            allowed = (h >= least) & (h_all - h >= least) & ((right - left) * monotone[:, None] >= 0)
            allowed &= np.arange(bins - 1) < np.array([len(c) for c in cuts])[:, None]
            gain = np.where(allowed, gain, -np.inf)
            f, b = np.unravel_index(np.argmax(gain), gain.shape)
            stay = g_all * value[t, node] - 0.5 * (h_all + ridge) * value[t, node] ** 2
            split = gain[f, b] > stay + 1e-9
            if split:
                feature[t, node], threshold[t, node] = f, cuts[f][b]
            goes = binned[at, f] <= b if split else np.ones(len(at), bool)
            middle = (left[f, b] + right[f, b]) / 2 if split else 0.0
            sign = monotone[f] if split else 0
            for child, part, of in ((2 * node + 1, goes, (low, min(high, middle)) if sign > 0 else (max(low, middle), high)),
                                    (2 * node + 2, ~goes, (max(low, middle), high) if sign > 0 else (low, min(high, middle)))):
                rows[child], bounds[child] = at[part], of if sign else (low, high)
                if not split:
                    bounds[child] = (value[t, node], value[t, node])
    return Forest(feature, threshold, value * rate, base)


def score(forest: Forest, x: np.ndarray) -> np.ndarray:
    """Probability of class 1, all rows and trees at once: one gather a level."""
    trees = len(forest.feature)
    node = np.zeros((len(x), trees), np.int64)
    tree = np.arange(trees)
    while trees and node.size and node[0, 0] < forest.feature.shape[1]:
        high = x[np.arange(len(x))[:, None], forest.feature[tree, node]] > forest.threshold[tree, node]
        node = 2 * node + 1 + high
    total = forest.base + (forest.value[tree, node].sum(axis=1) if trees else np.zeros(len(x)))
    return 1 / (1 + np.exp(-total))
