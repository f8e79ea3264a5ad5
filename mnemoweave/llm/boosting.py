"""Gradient-boosted trees on small dense matrices, for classifiers that are fitted on the driver and applied by workers."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Logistic boosting with depth-limited trees; split points are the quantiles of each feature."""

    def __init__(self, trees: int = 60, depth: int = 4, rate: float = 0.2, least: float = 4.0, penalty: float = 1.0, bins: int = 16):
        self.n, self.depth, self.rate, self.least, self.penalty, self.bins = trees, depth, rate, least, penalty, bins
        self.base, self.trees, self.scale, self.shift = 0.0, [], 1.0, 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        x, y = np.asarray(x, np.float32), np.asarray(y, np.float64)
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1)
        p = y.mean().clip(1e-3, 1 - 1e-3)
        self.base, self.trees = float(np.log(p / (1 - p))), []
        score = np.full(len(y), self.base)
        for _ in range(self.n):
            q = 1 / (1 + np.exp(-score))
            tree: list = []
            self._grow(tree, binned, edges, q - y, q * (1 - q), np.arange(len(y)), self.depth, score)
            self.trees.append(np.array(tree, np.float64))
        return self

    def _grow(self, tree: list, binned: np.ndarray, edges: list, g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int, score: np.ndarray) -> int:
        """Appends a node (feature, edge, left, right, value) and gives its index; leaves have feature -1."""
        at = len(tree)
        tree.append([-1, 0, 0, 0, 0])
        gs, hs = g[rows].sum(), h[rows].sum()
        best, where = 1e-6, None
        if depth:
            for j, e in enumerate(edges):
                if not len(e):
                    continue
                b = binned[rows, j]
                gl = np.cumsum(np.bincount(b, g[rows], len(e) + 1))[:-1]
                hl = np.cumsum(np.bincount(b, h[rows], len(e) + 1))[:-1]
                nl = np.cumsum(np.bincount(b, minlength=len(e) + 1))[:-1]
                gain = gl**2 / (hl + self.penalty) + (gs - gl) ** 2 / (hs - hl + self.penalty) - gs**2 / (hs + self.penalty)
                gain[(nl < self.least) | (len(rows) - nl < self.least)] = 0
                k = int(gain.argmax())
                if gain[k] > best:
                    best, where = gain[k], (j, k)
        if where is None:
            value = -self.rate * gs / (hs + self.penalty)
            tree[at][4] = value
            score[rows] += value
            return at
        j, k = where
        left = binned[rows, j] <= k
        tree[at][:2] = j, float(edges[j][k])
        tree[at][2] = self._grow(tree, binned, edges, g, h, rows[left], depth - 1, score)
        tree[at][3] = self._grow(tree, binned, edges, g, h, rows[~left], depth - 1, score)
        return at

    def raw(self, x: np.ndarray) -> np.ndarray:
        x = np.asarray(x, np.float32)
        out = np.full(len(x), self.base)
        row = np.arange(len(x))
        for t in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = t[node, 0].astype(np.int64)
                inner = f >= 0
                right = x[row, np.maximum(f, 0)] > t[node, 1].astype(np.float32)
                node = np.where(inner, np.where(right, t[node, 3], t[node, 2]), node).astype(np.int64)
            out += t[node, 4]
        return out

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        """Scale and shift of the score, such that it is a probability on held-out rows (Platt)."""
        s, y = self.raw(x), np.asarray(y, np.float64)
        a, b = 1.0, 0.0
        for _ in range(200):
            p = 1 / (1 + np.exp(-(a * s + b)))
            a -= 0.5 * (((p - y) * s).mean() + 1e-3 * (a - 1)) / max(1.0, (s**2).mean())
            b -= 0.5 * (p - y).mean()
        self.scale, self.shift = float(a), float(b)
        return self

    def probability(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        return 1 / (1 + np.exp(-(self.scale * self.raw(x) + self.shift)))


def prior_shift(n: np.ndarray, prior: float, rounds: int = 200) -> np.ndarray:
    """Probabilities of the steps 0..1 of a score, corrected for the share of true ones among `n` rows per step.

    The score is calibrated where that share is `prior`; the share here is found by expectation maximisation.
    """
    p = np.linspace(0, 1, len(n)).clip(1e-4, 1 - 1e-4)
    odds = p / (1 - p) * (1 - prior) / prior
    share, total = prior, n.sum()
    for _ in range(rounds):
        q = odds * share / (1 - share)
        q /= 1 + q
        share = ((n * q).sum() + 0.5) / (total + 1)
    return q


def best_expected(n: np.ndarray, q: np.ndarray) -> float:
    """The step 0..1 from which rows are taken for the greatest expected F1; `q` are the steps' probabilities."""
    hit, taken = np.cumsum((n * q)[::-1])[::-1], np.cumsum(n[::-1])[::-1]
    f1 = 2 * hit / np.maximum(1e-9, taken + (n * q).sum())
    # the highest of equal steps, then the middle of the empty ones below it
    k = len(n) - 1 - int(f1[::-1].argmax())
    low = k
    while low > 0 and not n[low - 1]:
        low -= 1
    return (k + low) / 2 / (len(n) - 1)
