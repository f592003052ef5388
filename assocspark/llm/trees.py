"""Small decision trees on binned features: boosted for probabilities, or grown as a random forest."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass
class Tree:
    feature: np.ndarray  # -1 at a leaf
    cut: np.ndarray  # greater bins go right
    child: np.ndarray  # left child, the right one follows it
    value: np.ndarray

    def predict(self, binned: np.ndarray) -> np.ndarray:
        at = np.zeros(len(binned), np.int64)
        rows = np.arange(len(binned))
        while True:
            feature = self.feature[at]
            if (feature < 0).all():
                return self.value[at]
            right = binned[rows, np.maximum(feature, 0)] > self.cut[at]
            at = np.where(feature < 0, at, self.child[at] + right)


def edges_of(x: np.ndarray) -> list[np.ndarray]:
    return [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(x.shape[1])]


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(edges)], 1).astype(np.uint8)


def grow(b: np.ndarray, slope: np.ndarray, curve: np.ndarray, depth: int, ridge: float, least: int, some: int, rng) -> Tree:
    """Split by the gain of -slope / (curve + ridge) leaves; ``some`` features are tried at each node."""
    feature, cut, child, value = [], [], [], []

    def leaf(rows):
        feature.append(-1), cut.append(0), child.append(0)
        value.append(-slope[rows].sum() / (curve[rows].sum() + ridge))
        return len(feature) - 1

    todo = [(leaf(np.arange(len(b))), np.arange(len(b)), 0)]
    while todo:
        node, rows, level = todo.pop()
        if level >= depth or len(rows) < 2 * least:
            continue
        best = (1e-9, -1, 0)
        for k in rng.permutation(b.shape[1])[:some]:
            own = b[rows, k]
            n = np.cumsum(np.bincount(own, minlength=BINS + 1))[:-1]
            g = np.cumsum(np.bincount(own, slope[rows], minlength=BINS + 1))
            h = np.cumsum(np.bincount(own, curve[rows], minlength=BINS + 1))
            left, right = g[:-1] ** 2 / (h[:-1] + ridge + 1e-12), (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + ridge + 1e-12)
            gain = np.where((n >= least) & (len(rows) - n >= least), left + right - g[-1] ** 2 / (h[-1] + ridge + 1e-12), 0.0)
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = (gain[at], k, at)
        if best[1] >= 0:
            feature[node], cut[node] = best[1], best[2]
            right = b[rows, best[1]] > best[2]
            parts = rows[~right], rows[right]
            child[node] = len(feature)
            for part in parts:
                todo.append((leaf(part), part, level + 1))
    return Tree(*(np.array(x) for x in (feature, cut, child, value)))


@dataclass
class Boosted:
    edges: list[np.ndarray]
    base: float
    trees: list[Tree]

    def probability(self, x: np.ndarray) -> np.ndarray:
        b = binned(x, self.edges)
        return 1 / (1 + np.exp(-(self.base + sum(t.predict(b) for t in self.trees))))


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.2, least: int = 5) -> Boosted:
    rng, edges = np.random.default_rng(11), edges_of(x)
    b = binned(x, edges)
    base = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    score, trees = np.full(len(y), base), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        tree = grow(b, p - y, p * (1 - p), depth, 1.0, least, x.shape[1], rng)
        tree.value = tree.value * rate
        score = score + tree.predict(b)
        trees.append(tree)
    return Boosted(edges, base, trees)


@dataclass
class Forest:
    edges: list[np.ndarray]
    trees: list[Tree]

    def probability(self, x: np.ndarray) -> np.ndarray:
        b = binned(x, self.edges)
        return sum(t.predict(b) for t in self.trees) / len(self.trees)


def forest(x: np.ndarray, y: np.ndarray, size: int = 60, depth: int = 10, least: int = 2) -> Forest:
    rng, edges = np.random.default_rng(13), edges_of(x)
    b, trees = binned(x, edges), []
    for _ in range(size):
        rows = rng.integers(0, len(y), len(y))
        some = max(1, int(np.sqrt(x.shape[1])) + 1)
        trees.append(grow(b[rows], -y[rows], np.ones(len(y)), depth, 0.0, least, some, rng))
    return Forest(edges, trees)
