"""Gradient-boosted trees for two classes, and their calibration, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Boosted:
    """Trees of one depth over binned features.

    ``edges``: per feature the upper ends of its bins but the last.
    ``feature``/``cut``: per tree and inner node (heap order) the feature and
    the bin that still goes left; ``value``: per tree and leaf.
    """

    edges: list[np.ndarray]
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    start: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Log odds of each row."""
        code = binned(x, self.edges)
        depth = int(np.log2(self.value.shape[1])) if len(self.value) else 0
        out, rows = np.full(len(x), self.start), np.arange(len(x))
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (code[rows, feature[node]] > cut[node])
            out += value[node - (2**depth - 1)]
        return out


def bins_of(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Ends of at most ``bins`` bins of each feature, at quantiles of its distinct values."""
    out = []
    for column in x.T:
        some = np.unique(column)
        ends = (some[1:] + some[:-1]) / 2
        out.append(ends if len(ends) < bins else np.unique(np.quantile(ends, np.linspace(0, 1, bins - 1))))
    return out


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)], 1) if len(edges) else np.zeros((len(x), 0), np.int64)


Sums = tuple[np.ndarray, np.ndarray]  # of the gradient and the curvature: node, feature, bin


def split_sums(code: np.ndarray, node: np.ndarray, n_nodes: int, grad: np.ndarray, hess: np.ndarray, bins: int) -> Sums:
    """Gradient and curvature of the rows of each node, feature and bin."""
    at = [node * bins + column for column in code.T]
    return tuple(np.stack([np.bincount(k, w, n_nodes * bins).reshape(n_nodes, bins) for k in at], 1) for w in (grad, hess))


def splits_of(sums: Sums, l2: float, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Per node the feature and bin whose split gains most; where none gains, all rows go left."""
    g, h = (x.cumsum(2) for x in sums)
    n_nodes, _, bins = g.shape
    gt, ht = g[:, :, -1:], h[:, :, -1:]
    gain = g**2 / (h + l2) + (gt - g) ** 2 / (ht - h + l2) - gt**2 / (ht + l2)
    flat = np.where((h >= least) & (ht - h >= least), gain, 0).reshape(n_nodes, -1)
    best = flat.argmax(1)
    found = flat[np.arange(n_nodes), best] > 1e-9
    return np.where(found, best // bins, 0), np.where(found, best % bins, bins)


def best_splits(code: np.ndarray, node: np.ndarray, n_nodes: int, grad: np.ndarray, hess: np.ndarray, bins: int, l2: float, least: float) -> tuple[np.ndarray, np.ndarray]:
    """:func:`splits_of` rows."""
    return splits_of(split_sums(code, node, n_nodes, grad, hess, bins), l2, least)


def descend(code: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """The node of one tree (heap order) that each row reaches after so many levels."""
    node, rows = np.zeros(len(code), np.int64), np.arange(len(code))
    for _ in range(levels):
        node = 2 * node + 1 + (code[rows, feature[node]] > cut[node])
    return node


def slopes(raw: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the logistic loss of weighted rows."""
    p = 1 / (1 + np.exp(-raw))
    return weight * (p - y), weight * np.maximum(p * (1 - p), 1e-6)


class Rows:
    """Weighted rows in memory, for :func:`grow`."""

    def __init__(self, code: np.ndarray, y: np.ndarray, weight: np.ndarray, bins: int = 32):
        self.code, self.y, self.weight, self.bins = code, y, weight, bins
        self.raw, self.done = None, 0

    def __call__(self, trees: Boosted, t: int, level: int) -> Sums:
        if self.raw is None:
            self.raw = np.full(len(self.code), trees.start)
        for k in range(self.done, t):
            depth = int(np.log2(trees.value.shape[1]))
            self.raw += trees.value[k][descend(self.code, trees.feature[k], trees.cut[k], depth) - (2**depth - 1)]
        self.done = t
        node = descend(self.code, trees.feature[t], trees.cut[t], level) - (2**level - 1)
        return split_sums(self.code, node, 2**level, *slopes(self.raw, self.y, self.weight), self.bins)


def grow(sums, edges: list[np.ndarray], prior: float, rounds: int = 60, depth: int = 3, rate: float = 0.2, l2: float = 1.0, least: float = 1.0) -> Boosted:
    """Trees by Newton steps on the logistic loss. ``sums(trees, t, level)`` adds up all examples by the node
    that they reach on a level of tree ``t``, after the trees before it: wherever they lie, only sums come here."""
    prior = np.clip(prior, 1e-3, 1 - 1e-3)
    inner, leaves = 2**depth - 1, 2**depth
    trees = Boosted(edges, np.zeros((rounds, inner), np.int64), np.zeros((rounds, inner), np.int64), np.zeros((rounds, leaves)), float(np.log(prior / (1 - prior))))
    for t in range(rounds):
        for level in range(depth):
            at = slice(2**level - 1, 2 ** (level + 1) - 1)
            trees.feature[t, at], trees.cut[t, at] = splits_of(sums(trees, t, level), l2, least)
        g, h = (x[:, 0].sum(1) for x in sums(trees, t, depth))
        trees.value[t] = -rate * g / (h + l2)
    return trees


def boost(x: np.ndarray, y: np.ndarray, bins: int = 32, **options) -> Boosted:
    """Trees for labels ``y`` (0, 1) of rows in memory. Splits leave at least ``least`` of the loss's curvature on each side."""
    edges = bins_of(x, bins)
    return grow(Rows(binned(x, edges), y, np.ones(len(y)), bins), edges, y.mean() if len(y) else 0.5, **options)


def platt(raw: np.ndarray, y: np.ndarray, steps: int = 50, weight: np.ndarray | None = None) -> tuple[float, float]:
    """a, b of the probability 1 / (1 + exp(-(a raw + b))), fitted with softened labels by Newton's method."""
    weight = np.ones(len(y)) if weight is None else weight
    n1, n = (weight * y).sum(), weight.sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n - n1 + 2))
    z, w = np.stack([raw, np.ones(len(raw))], 1), np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + 1e-6 * np.eye(2), z.T @ (weight * (p - target)))
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def precise_threshold(p: np.ndarray, y: np.ndarray, precision: float, weight: np.ndarray | None = None) -> float:
    """The least probability from which on at least ``precision`` of the rows are positive; above 1 where there is none."""
    order = np.argsort(-p, kind="stable")
    weight = np.ones(len(y)) if weight is None else weight
    hits = np.cumsum((weight * y)[order]) / np.cumsum(weight[order])
    last = np.flatnonzero(np.append(p[order][1:] != p[order][:-1], True)[: len(y)])  # rows of one probability go together
    good = last[hits[last] >= precision]
    return float(p[order][good[-1]]) if len(good) else 1.1
