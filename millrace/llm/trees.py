"""Gradient-boosted trees over binned features, kept as flat arrays.

Training bins each feature at quantiles and grows trees level by level from histograms of gradients. A model is six arrays
over all nodes; scoring walks all rows of a batch through one tree at a time with array look-ups.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 64


@dataclass
class Forest:
    """Node k splits on `feature[k]` at `threshold[k]` (NaN goes left) into `left[k]` and `left[k] + 1`; leaves have left 0 and
    `value[k]`. `roots` are the trees' first nodes."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    depth: int
    base: float

    def margins(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                inner = self.left[node] > 0
                right = x[rows, self.feature[node]] > self.threshold[node]
                node = np.where(inner, self.left[node] + right, node)
            total += self.value[node]
        return total

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -30, 30)))


def train(
    x: np.ndarray,
    y: np.ndarray,
    rounds: int = 80,
    depth: int = 4,
    rate: float = 0.15,
    ridge: float = 1.0,
    min_hessian: float = 2.0,
    seed: int = 7,
) -> Forest:
    """Trees for the log-loss of `y` (0 or 1). Without rows of both labels the forest is a constant: the smoothed share of 1."""
    n, m = x.shape
    share = (y.sum() + 1) / (n + 2)
    base = float(np.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) if n else np.zeros(0) for j in range(m)]
    binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 1) if m else np.zeros((n, 0), int)
    margin = np.full(n, base)
    nodes: dict[str, list] = {"feature": [], "threshold": [], "left": [], "value": []}

    def add() -> int:
        for name, empty in (("feature", 0), ("threshold", 0.0), ("left", 0), ("value", 0.0)):
            nodes[name].append(empty)
        return len(nodes["left"]) - 1

    roots = []
    for _ in range(rounds if 0 < y.sum() < n else 0):
        p = 1 / (1 + np.exp(-margin))
        gradient, hessian = y - p, p * (1 - p)
        roots.append(add())
        where = np.full(n, roots[-1])
        level = [roots[-1]]
        for deep in range(depth + 1):
            following = []
            place = {k: i for i, k in enumerate(level)}
            index = np.array([place.get(k, -1) for k in range(len(nodes["left"]))])[where]
            live = index >= 0
            g = np.bincount(index[live], gradient[live], len(level))
            h = np.bincount(index[live], hessian[live], len(level))
            for i, k in enumerate(level):
                nodes["value"][k] = rate * g[i] / (h[i] + ridge)
            if deep == depth:
                break
            best = [(1e-6, -1, 0)] * len(level)
            for j in range(m):
                if not len(cuts[j]):
                    continue
                code = index[live] * BINS + binned[live, j]
                gs = np.cumsum(np.bincount(code, gradient[live], len(level) * BINS).reshape(-1, BINS), 1)
                hs = np.cumsum(np.bincount(code, hessian[live], len(level) * BINS).reshape(-1, BINS), 1)
                gr, hr = g[:, None] - gs, h[:, None] - hs
                gain = gs**2 / (hs + ridge) + gr**2 / (hr + ridge) - (g**2 / (h + ridge))[:, None]
                gain[(hs < min_hessian) | (hr < min_hessian)] = -1
                gain[:, len(cuts[j]) :] = -1
                at = gain.argmax(1)
                for i in range(len(level)):
                    if gain[i, at[i]] > best[i][0]:
                        best[i] = float(gain[i, at[i]]), j, int(at[i])
            for i, k in enumerate(level):
                _, j, at = best[i]
                if j < 0:
                    continue
                left = add()
                add()
                nodes["feature"][k], nodes["threshold"][k], nodes["left"][k] = j, float(cuts[j][at]), left
                here = where == k
                where[here] = left + (binned[here, j] > at)
                following += [left, left + 1]
            level = following
            if not level:
                break
        margin = margin + np.array(nodes["value"])[where]
    return Forest(
        np.array(roots, int), np.array(nodes["feature"], int), np.array(nodes["threshold"]), np.array(nodes["left"], int),
        np.array(nodes["value"]), depth, base,
    )
