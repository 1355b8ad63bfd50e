"""Gradient-boosted regression trees over binned features; small, deterministic, trained on a bounded sample."""

from __future__ import annotations

import numpy as np

#: Units in which gradients and weights are summed.
UNIT, WEIGHT = 2.0**-10, 2.0**-4


class Trees:
    """Squared-loss boosting of depth-limited trees; every level of a tree is grown at once from histograms.

    Of two children the smaller is counted and the other is the rest of the parent; sums are whole numbers, so the
    difference is exact. Weights are rounded to sixteenths.
    """

    def __init__(self, rounds: int = 160, depth: int = 4, rate: float = 0.08, bins: int = 32, least: int = 12, shrink: float = 1.0, share: float = 0.7, seed: int = 7):
        self.rounds, self.depth, self.rate, self.bins, self.least, self.shrink, self.share, self.seed = rounds, depth, rate, bins, least, shrink, share, seed

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(self.cuts)], 1).astype(np.int32)

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> Trees:
        n, p = x.shape
        whole = np.ones(n) / WEIGHT if weight is None else np.maximum(np.rint(weight / WEIGHT), 1)
        w = whole * WEIGHT
        self.cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(p)]
        b = self._bin(x)
        flat = b + np.arange(p) * self.bins
        self.base = float((y * w).sum() / w.sum())
        f = np.full(n, self.base)
        leaves = 1 << self.depth
        self.feature = np.zeros((self.rounds, leaves), np.int32)  # of node i (heap order from 1)
        self.cut = np.full((self.rounds, leaves), self.bins, np.int32)
        self.value = np.zeros((self.rounds, leaves))
        rng = np.random.default_rng(self.seed)
        width = p * self.bins
        # Gradients and weights in units of UNIT, both in one number that a double holds exactly: one pass counts both.
        step = 2.0 ** np.ceil(np.log2(4 * n * max(1.0, float((np.abs(y - self.base) * w).mean() * 4)) / UNIT + 2))

        def histogram(rows: np.ndarray, node: np.ndarray, packed: np.ndarray, nodes: int) -> np.ndarray:
            key = (flat[rows] + (node * width)[:, None]).ravel()
            return np.bincount(key, np.repeat(packed, p), nodes * width).reshape(nodes, p, self.bins)

        for t in range(self.rounds):
            rows = np.flatnonzero(rng.random(n) < self.share)
            if not len(rows):
                rows = np.arange(n)
            g, wr = np.rint((y - f)[rows] * w[rows] / UNIT), whole[rows]
            packed = wr * step + g
            node = np.zeros(len(rows), np.int64)
            sums = histogram(rows, node, packed, 1)
            for level in range(self.depth):
                m = 1 << level
                if level:  # count the smaller child of each node; the other is what is left of its parent
                    small = 2 * np.arange(m // 2) + (np.bincount(node, minlength=m).reshape(-1, 2).argmin(1))
                    own = np.isin(node, small)
                    less = histogram(rows[own], node[own] >> 1, packed[own], m // 2)
                    parent, sums = sums, np.empty((m, p, self.bins))
                    sums[small], sums[small ^ 1] = less, parent - less
                sw = np.rint(sums / step)
                sg = (sums - sw * step).cumsum(2) * UNIT
                sw = sw.cumsum(2) * WEIGHT
                tg, tw = sg[:, :, -1:], sw[:, :, -1:]
                ok = (sw >= self.least) & (tw - sw >= self.least)
                gain = np.where(ok, sg**2 / (sw + self.shrink) + (tg - sg) ** 2 / (tw - sw + self.shrink) - tg**2 / (tw + self.shrink), -1)
                best = gain.reshape(m, -1).argmax(1)
                good = gain.reshape(m, -1)[np.arange(m), best] > 1e-9
                self.feature[t, m : 2 * m] = best // self.bins
                self.cut[t, m : 2 * m] = np.where(good, best % self.bins, self.bins)
                node = 2 * node + (b[rows, self.feature[t, m + node]] > self.cut[t, m + node])
            sg, sw = np.bincount(node, g, leaves) * UNIT, np.bincount(node, wr, leaves) * WEIGHT
            self.value[t] = self.rate * sg / (sw + self.shrink)
            f += self._leaf(b, t)
        return self

    def _leaf(self, b: np.ndarray, t: int) -> np.ndarray:
        node = np.zeros(len(b), np.int64)
        rows = np.arange(len(b))
        for level in range(self.depth):
            at = (1 << level) + node
            node = 2 * node + (b[rows, self.feature[t, at]] > self.cut[t, at])
        return self.value[t][node]

    def predict(self, x: np.ndarray) -> np.ndarray:
        b = self._bin(x)
        return self.base + sum((self._leaf(b, t) for t in range(self.rounds)), np.zeros(len(x)))
