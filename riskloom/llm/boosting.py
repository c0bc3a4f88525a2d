"""Small gradient-boosted trees in numpy, with calibrated probabilities."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class BoostedTrees:
    """Logistic boosting of oblivious trees (one split per level) on quantile-binned features."""

    n_trees: int = 60
    depth: int = 3
    rate: float = 0.2
    bins: int = 16
    ridge: float = 1.0
    edges: list[np.ndarray] = field(default_factory=list)
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    bias: float = 0.0
    platt: tuple[float, float] = (1.0, 0.0)

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        coded = np.stack([np.searchsorted(e, c, "right") for e, c in zip(self.edges, x.T, strict=True)], axis=1)
        share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
        self.bias = float(np.log(share / (1 - share)))
        raw = np.full(len(y), self.bias)
        for _ in range(self.n_trees):
            p = 1 / (1 + np.exp(-raw))
            grad, hess = y - p, p * (1 - p)
            leaf, features, cuts = np.zeros(len(y), dtype=np.int64), [], []
            for level in range(self.depth):
                best = (-1.0, 0, 0)
                for f in range(x.shape[1]):
                    cells = self.bins + 1
                    key = leaf * cells + coded[:, f]
                    g = np.bincount(key, grad, cells << level).reshape(-1, cells).cumsum(axis=1)
                    h = np.bincount(key, hess, cells << level).reshape(-1, cells).cumsum(axis=1)
                    left = (g**2 / (h + self.ridge)).sum(axis=0)
                    right = ((g[:, -1:] - g) ** 2 / (h[:, -1:] - h + self.ridge)).sum(axis=0)
                    gain = (left + right)[: len(self.edges[f])]
                    if len(gain) and gain.max() > best[0]:
                        best = (float(gain.max()), f, int(gain.argmax()))
                features.append(best[1])
                cuts.append(best[2])
                leaf = 2 * leaf + (coded[:, best[1]] > best[2])
            g, h = (np.bincount(leaf, v, 1 << self.depth) for v in (grad, hess))
            values = self.rate * g / (h + self.ridge)
            thresholds = np.array([self.edges[f][c] if len(self.edges[f]) else np.inf for f, c in zip(features, cuts, strict=True)])
            self.trees.append((np.array(features), thresholds, values))
            raw += values[leaf]
        return self

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        for features, thresholds, values in self.trees:
            leaf = np.zeros(len(x), dtype=np.int64)
            for f, t in zip(features, thresholds, strict=True):
                leaf = 2 * leaf + (x[:, f] >= t)
            out += values[leaf]
        return out

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        """Platt scaling on held-out rows, by Newton steps."""
        s, (a, b) = self.raw(x), (1.0, 0.0)
        for _ in range(30):
            p = 1 / (1 + np.exp(-(a * s + b)))
            w, d = p * (1 - p) + 1e-9, p - y
            grad = np.array([(d * s).sum() + 1e-3 * (a - 1), d.sum()])
            hess = np.array([[(w * s * s).sum() + 1e-3, (w * s).sum()], [(w * s).sum(), w.sum()]])
            a, b = np.array([a, b]) - np.linalg.solve(hess, grad)
        self.platt = (float(a), float(b))
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        a, b = self.platt
        return 1 / (1 + np.exp(-(a * self.raw(x) + b)))


def threshold_for(p: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The least threshold whose precision on these rows, and above all higher ones, is at least ``precision``."""
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    good = np.flatnonzero(hits >= precision)
    return float(p[order][good[-1]]) if len(good) else 1.1
