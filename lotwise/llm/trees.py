"""Small gradient-boosted trees for bounded training tables (driver-side NumPy).

Trees split on quantile cuts, so a rule read off a path is a conjunction of
``feature <= cut`` and ``feature > cut`` conditions.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Node:
    value: float
    feature: int = -1
    cut: float = 0.0
    low: Node | None = None
    high: Node | None = None


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def quantile_cuts(x: np.ndarray, n: int) -> np.ndarray:
    """Midpoints between distinct quantiles of a column."""
    q = np.unique(np.quantile(x, np.linspace(0, 1, n + 2)))
    return (q[1:] + q[:-1]) / 2


def _grow(codes, cuts, g, h, rows, depth, least):
    G, H = g[rows].sum(), h[rows].sum()
    node = Node(G / (H + 1.0))
    if depth == 0 or len(rows) < 2 * least:
        return node
    best, base = 1e-6, G * G / (H + 1.0)
    for j, c in enumerate(cuts):
        if not len(c):
            continue
        own = codes[rows, j]
        gl = np.cumsum(np.bincount(own, g[rows], len(c) + 1))[:-1]
        hl = np.cumsum(np.bincount(own, h[rows], len(c) + 1))[:-1]
        nl = np.cumsum(np.bincount(own, minlength=len(c) + 1))[:-1]
        gain = gl * gl / (hl + 1.0) + (G - gl) ** 2 / (H - hl + 1.0) - base
        gain[(nl < least) | (len(rows) - nl < least)] = 0
        i = int(np.argmax(gain))
        if gain[i] > best:
            best, node.feature, node.cut, at = gain[i], j, float(c[i]), i
    if node.feature >= 0:
        left = codes[rows, node.feature] <= at
        node.low = _grow(codes, cuts, g, h, rows[left], depth - 1, least)
        node.high = _grow(codes, cuts, g, h, rows[~left], depth - 1, least)
    return node


def apply_tree(node: Node, x: np.ndarray) -> np.ndarray:
    out = np.full(len(x), node.value)
    if node.feature >= 0 and len(x):
        low = x[:, node.feature] <= node.cut
        out[low] = apply_tree(node.low, x[low])
        out[~low] = apply_tree(node.high, x[~low])
    return out


@dataclass
class Boosted:
    start: float
    rate: float
    trees: list[Node]

    def raw(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.start)
        for t in self.trees:
            z += self.rate * apply_tree(t, x)
        return z

    def predict(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.raw(x))


def boost(x: np.ndarray, y: np.ndarray, n_trees: int = 40, depth: int = 3, rate: float = 0.2, cuts: int = 48,
          least: int | None = None) -> Boosted:
    """Logistic boosting; one class alone gives a constant close to that class."""
    least = least or max(3, len(x) // 400)
    grid = [quantile_cuts(x[:, j], cuts) for j in range(x.shape[1])]
    codes = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(grid)], axis=1)
    p = (y.sum() + 1.0) / (len(y) + 2.0)
    model = Boosted(float(np.log(p / (1 - p))), rate, [])
    z, every = np.full(len(x), model.start), np.arange(len(x))
    for _ in range(n_trees if 0 < y.sum() < len(y) else 0):
        p = sigmoid(z)
        tree = _grow(codes, grid, y - p, p * (1 - p), every, depth, least)
        if tree.feature < 0:
            break
        model.trees.append(tree)
        z += rate * apply_tree(tree, x)
    return model


def paths(node: Node, above: tuple = ()) -> list[tuple]:
    """Conditions (feature, is_high, cut) from the root to each node below it."""
    out = [above] if above else []
    if node.feature >= 0:
        out += paths(node.low, above + ((node.feature, False, node.cut),))
        out += paths(node.high, above + ((node.feature, True, node.cut),))
    return out


# ---------------------------------------------------------------------------
# Boosting over counted points: the caller sums the histograms, wherever the points lie
# ---------------------------------------------------------------------------
#: Gradients are summed as whole numbers of this step, so that their sums do not depend on the order.
STEP = 1 << 24


def counted_cuts(values: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """``quantile_cuts`` of sorted distinct values that occur ``counts`` times."""
    last = np.cumsum(counts) - 1
    rank = np.linspace(0, 1, n + 2) * last[-1]
    low, high = (values[np.searchsorted(last, r)] for r in (np.floor(rank), np.ceil(rank)))
    q = np.unique(low + (high - low) * (rank - np.floor(rank)))
    return (q[1:] + q[:-1]) / 2


def coded(x: np.ndarray, grid: list[np.ndarray]) -> np.ndarray:
    """Points as the numbers of the cuts below each value (one byte each)."""
    return np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(grid)], axis=1).astype(np.uint8)


def decoded(codes: np.ndarray, grid: list[np.ndarray]) -> np.ndarray:
    """Values that every tree on ``grid`` treats as it does those that were coded."""
    return np.stack([np.r_[c, np.inf][codes[:, j]] for j, c in enumerate(grid)], axis=1)


def frontier(tree: Node, level: int) -> list[Node]:
    """The nodes ``level`` steps below the root, left to right."""
    return [tree] if level == 0 else [n for side in (tree.low, tree.high) if side is not None for n in frontier(side, level - 1)]


def histogram(codes: np.ndarray, x: np.ndarray, y: np.ndarray, n: np.ndarray, z: np.ndarray, tree: Node, level: int, width: int) -> np.ndarray:
    """Sums (gradient, curvature, points) by node of the frontier, feature and code."""
    nodes = {id(m): i for i, m in enumerate(frontier(tree, level))}
    at = np.full(len(x), -1)

    def down(node, rows, left):
        if left == 0:
            at[rows] = nodes[id(node)]
        elif node.feature >= 0:
            low = x[rows, node.feature] <= node.cut
            down(node.low, rows[low], left - 1)
            down(node.high, rows[~low], left - 1)

    down(tree, np.arange(len(x)), level)
    own = at >= 0
    p = sigmoid(z[own])
    weights = np.rint((y[own] - p) * STEP) * n[own], np.rint(p * (1 - p) * STEP) * n[own], n[own].astype(float)
    out = np.zeros((3, len(nodes), codes.shape[1], width), np.int64)
    for j in range(codes.shape[1]):
        key = at[own] * width + codes[own, j]
        for i, w in enumerate(weights):
            out[i, :, j] = np.bincount(key, w, len(nodes) * width).reshape(-1, width)
    return out


def boost_counted(sums, grid: list[np.ndarray], n: int, positive: int, n_trees: int, depth: int, rate: float = 0.2) -> Boosted:
    """``boost`` on ``n`` points, ``positive`` of them of label 1. ``sums(model, tree, level)`` gives the
    ``histogram`` of all points; trees grow a level at a time."""
    least = max(3, n // 400)
    p = (positive + 1.0) / (n + 2.0)
    model = Boosted(float(np.log(p / (1 - p))), rate, [])
    for _ in range(n_trees if 0 < positive < n else 0):
        tree = Node(0.0)
        for level in range(depth):
            if not (nodes := frontier(tree, level)):
                break
            for node, g, h, c in zip(nodes, *sums(model, tree, level)):
                _split(node, g / STEP, h / STEP, c, grid, least)
        if tree.feature < 0:
            break
        model.trees.append(tree)
    return model


def _split(node: Node, g: np.ndarray, h: np.ndarray, n: np.ndarray, grid: list[np.ndarray], least: int) -> None:
    G, H, N = g[0].sum(), h[0].sum(), n[0].sum()
    node.value = G / (H + 1.0)
    if N < 2 * least:
        return
    best, base, found = 1e-6, G * G / (H + 1.0), None
    for j, c in enumerate(grid):
        if not len(c):
            continue
        gl, hl, nl = (np.cumsum(x[j])[:len(c)] for x in (g, h, n))
        gain = gl * gl / (hl + 1.0) + (G - gl) ** 2 / (H - hl + 1.0) - base
        gain[(nl < least) | (N - nl < least)] = 0
        i = int(np.argmax(gain))
        if gain[i] > best:
            best, node.feature, node.cut, found = gain[i], j, float(c[i]), (gl[i], hl[i])
    if found:
        gl, hl = found
        node.low, node.high = Node(gl / (hl + 1.0)), Node((G - gl) / (H - hl + 1.0))
