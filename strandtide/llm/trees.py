"""Decision trees on binned features, grown from histograms and flattened into arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 64


@dataclass
class Trees:
    """All nodes of all trees in five arrays; a leaf points to itself. `roots` are the trees' first nodes."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float = 0.0

    def total(self, x: np.ndarray) -> np.ndarray:
        """Sum of the leaves that each row of `x` reaches, all trees side by side."""
        out = np.empty(len(x))
        for lo in range(0, len(x), 4096):
            part = x[lo : lo + 4096]
            rows = np.arange(len(part))[:, None]
            at = np.broadcast_to(self.roots, (len(part), len(self.roots)))
            for _ in range(self.depth):
                at = np.where(part[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            out[lo : lo + 4096] = self.value[at].sum(axis=1, dtype=np.float64) + self.base
        return out


class _Nodes:
    def __init__(self):
        self.rows: list[list] = []

    def leaf(self, value: float) -> int:
        n = len(self.rows)
        self.rows.append([0, np.inf, n, n, value])
        return n

    def flat(self, roots: list[int], depth: int, base: float = 0.0) -> Trees:
        f, t, a, b, v = zip(*self.rows, strict=True)
        return Trees(np.array(f, np.int64), np.array(t, np.float32), np.array(a, np.int64), np.array(b, np.int64), np.array(v, np.float64), np.array(roots, np.int64), depth, base)


def edges_of(x: np.ndarray) -> list[np.ndarray]:
    """Upper bin bounds of each feature, at quantiles of its values."""
    quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
    return [np.unique(np.quantile(x[:, j], quantiles, method="lower").astype(np.float32)) for j in range(x.shape[1])]


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1).astype(np.int64)


def _grow(nodes: _Nodes, bins, edges, grad, hess, depth: int, least: float, decay: float, pick) -> tuple[int, np.ndarray]:
    """One tree, level by level, from sums of gradient and curvature by node, feature and bin. Returns its root and each row's leaf value."""
    n, features = bins.shape
    root = nodes.leaf(0.0)
    at = np.zeros(n, dtype=np.int64)
    open_nodes, value = [root], np.zeros(n)
    for level in range(depth + 1):
        k = len(open_nodes)
        live = at >= 0
        g_all, h_all = np.bincount(at[live], grad[live], k), np.bincount(at[live], hess[live], k)
        best, split = np.full(k, 1e-9), np.zeros((k, 2), dtype=np.int64)
        if level < depth:
            for j in pick(features):
                if not len(edges[j]):
                    continue
                cell = at[live] * BINS + bins[live, j]
                g = np.bincount(cell, grad[live], k * BINS).reshape(k, BINS).cumsum(axis=1)[:, :-1]
                h = np.bincount(cell, hess[live], k * BINS).reshape(k, BINS).cumsum(axis=1)[:, :-1]
                gr, hr = g_all[:, None] - g, h_all[:, None] - h
                gain = g**2 / (h + decay) + gr**2 / (hr + decay) - (g_all**2 / (h_all + decay))[:, None]
                gain[(h < least) | (hr < least)] = 0
                gain[:, len(edges[j]) :] = 0
                where = gain.argmax(axis=1)
                better = gain[np.arange(k), where] > best
                best[better], split[better, 0], split[better, 1] = gain[better, where[better]], j, where[better]
        goes = best > 1e-9
        number, following = np.full(2 * k, -1, dtype=np.int64), []
        for i, node in enumerate(open_nodes):
            if goes[i]:
                a, b = nodes.leaf(0.0), nodes.leaf(0.0)
                nodes.rows[node] = [int(split[i, 0]), float(edges[split[i, 0]][split[i, 1]]), a, b, 0.0]
                number[2 * i], number[2 * i + 1] = len(following), len(following) + 1
                following += [a, b]
            else:
                nodes.rows[node][4] = float(-g_all[i] / (h_all[i] + decay))
        rows = np.flatnonzero(live)
        own = at[rows]
        done = ~goes[own]
        value[rows[done]] = (-g_all / (h_all + decay))[own[done]]
        at[rows[done]] = -1
        rows, own = rows[~done], own[~done]
        at[rows] = number[2 * own + (bins[rows, split[own, 0]] > split[own, 1])]
        open_nodes = following
        if not following:
            break
    return root, value


def boosted(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.12, least: float = 1.0, decay: float = 1.0) -> Trees:
    """Gradient-boosted trees for the log-odds of y = 1. Without rows, or with one label only, a constant."""
    nodes, roots = _Nodes(), []
    mean = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    base = float(np.log(mean / (1 - mean)))
    if len(y) and 0 < y.sum() < len(y):
        edges = edges_of(x)
        bins = binned(x, edges)
        score = np.full(len(y), base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            before = len(nodes.rows)
            root, value = _grow(nodes, bins, edges, p - y, p * (1 - p), depth, least, decay, range)
            for row in nodes.rows[before:]:
                row[4] *= rate
            roots.append(root)
            score += rate * value
    if not roots:
        roots.append(nodes.leaf(0.0))
    return nodes.flat(roots, depth, base)


def forest(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 10, least: float = 2.0, seed: int = 11) -> Trees:
    """A random forest: bootstrap weights and a fresh choice of features at every level; `total` is the mean vote."""
    nodes, roots = _Nodes(), []
    if len(y):
        rng = np.random.default_rng(seed)
        edges = edges_of(x)
        bins = binned(x, edges)
        for _ in range(trees):
            weight = rng.poisson(1.0, len(y)).astype(float)
            some = lambda n: rng.permutation(n)[: max(1, round(n**0.5) + 1)].tolist()
            roots.append(_grow(nodes, bins, edges, -y * weight, weight, depth, least, 1e-9, some)[0])
    else:
        roots.append(nodes.leaf(0.5))
    for row in nodes.rows:
        row[4] /= len(roots)
    return nodes.flat(roots, depth)
