"""Gradient boosted trees on binned features, for two classes; small, deterministic, NumPy only."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Trees:
    """Complete trees of one depth: feature and threshold per inner node, value per leaf; calibration a + b * score."""

    depth: int
    base: float = 0.0
    feature: list[np.ndarray] = field(default_factory=list)
    threshold: list[np.ndarray] = field(default_factory=list)
    value: list[np.ndarray] = field(default_factory=list)
    scale: tuple[float, float] = (0.0, 1.0)

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.value):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            out += v[at - (2**self.depth - 1)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a + b * self.score(x), -40, 40))) if len(x) else np.zeros(0)


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.25, least: float = 5.0, ridge: float = 1.0, bins: int = 24) -> Trees:
    """Logistic loss, second-order leaf values, splits on at most `bins` cut points per feature."""
    n, d = x.shape
    cuts = []
    code = np.zeros((n, d), dtype=np.int64)
    for j in range(d):
        u = np.unique(x[:, j])
        c = (u[1:] + u[:-1]) / 2 if len(u) <= bins else np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1]))
        cuts.append(c)
        code[:, j] = np.searchsorted(c, x[:, j], side="left")
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    m = Trees(depth, float(np.log(p / (1 - p))))
    f = np.full(n, m.base)
    width = bins + 1
    for _ in range(trees):
        q = 1 / (1 + np.exp(-f))
        g, h = q - y, np.maximum(q * (1 - q), 1e-6)
        feat, thr = np.zeros(2**depth - 1, dtype=np.int64), np.full(2**depth - 1, np.inf)
        at = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            node = at - first
            best = np.zeros(count)
            for j in range(d):
                if not len(cuts[j]):
                    continue
                k = node * width + code[:, j]
                gs = np.bincount(k, g, count * width).reshape(count, width).cumsum(1)
                hs = np.bincount(k, h, count * width).reshape(count, width).cumsum(1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + ridge) + (gt - gs) ** 2 / (ht - hs + ridge) - gt**2 / (ht + ridge)
                gain[(hs < least * 0.05) | (ht - hs < least * 0.05)] = 0
                gain = gain[:, : len(cuts[j])]
                c = gain.argmax(1)
                v = gain[np.arange(count), c]
                up = v > best + 1e-9
                best[up] = v[up]
                feat[first + np.flatnonzero(up)] = j
                thr[first + np.flatnonzero(up)] = cuts[j][c[up]]
            at = 2 * at + 1 + (x[np.arange(n), feat[at]] > thr[at])
        leaf = at - (2**depth - 1)
        v = -np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + ridge) * rate
        f += v[leaf]
        m.feature.append(feat)
        m.threshold.append(thr)
        m.value.append(v)
    return m


def calibrate(m: Trees, x: np.ndarray, y: np.ndarray, steps: int = 50) -> None:
    """Platt scaling on held-out rows, with smoothed targets."""
    s = m.score(x)
    pos, neg = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    def loss(a: float, b: float) -> float:
        z = a + b * s
        return float((np.logaddexp(0, z) - t * z).sum())

    a, b = 0.0, 1.0
    for _ in range(steps):
        q = 1 / (1 + np.exp(-np.clip(a + b * s, -40, 40)))
        w = np.maximum(q * (1 - q), 1e-6)
        grad = np.array([(q - t).sum(), ((q - t) * s).sum()])
        hess = np.array([[w.sum(), (w * s).sum()], [(w * s).sum(), (w * s * s).sum()]]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        # where the classes part cleanly a whole step may overshoot
        while np.abs(step).max() > 1e-6 and loss(a - step[0], b - step[1]) > loss(a, b):
            step = step / 2
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    m.scale = (float(a), float(max(b, 0.05)))


def threshold(p: np.ndarray, y: np.ndarray, beta: float = 1.2) -> float:
    """The cutoff for calibrated probabilities: with F the best F-beta measure reached, a span is worth taking from
    F / (1 + beta^2) on. Steadier than the place of the best measure itself; beta over 1 favours recall."""
    if not len(p) or not y.sum():
        return 0.5
    order = np.argsort(-p)
    tp = np.cumsum(y[order])
    f = (1 + beta**2) * tp / (np.arange(1, len(p) + 1) + beta**2 * y.sum())
    return float(f.max() / (1 + beta**2))
