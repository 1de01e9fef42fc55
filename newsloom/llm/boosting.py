"""Gradient-boosted trees on a bounded sample, kept as flat numpy arrays for scoring."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """All trees in one set of node arrays; a leaf points to itself."""

    bias: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def margin(self, rows: np.ndarray) -> np.ndarray:
        """The sum of the leaves' values for each row (log-odds)."""
        total = np.full(len(rows), self.bias)
        index = np.arange(len(rows))
        for root in self.roots:
            node = np.full(len(rows), root)
            for _ in range(self.depth):
                low = rows[index, self.feature[node]] <= self.threshold[node]
                node = np.where(low, self.left[node], self.right[node])
            total += self.value[node]
        return total

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(rows), -30, 30)))


def fit(
    rows: np.ndarray,
    target: np.ndarray,
    monotone: np.ndarray | None = None,
    trees: int = 60,
    depth: int = 4,
    rate: float = 0.15,
    bins: int = 64,
    smooth: float = 1.0,
    least: float = 2.0,
) -> Trees:
    """Boosted trees for a 0/1 target by logistic loss.

    ``monotone`` has +1 (the score may only rise with the feature), -1 or 0
    per feature: a split that breaks it is not taken, and both children stay
    on their side of the split's middle further down. With one class only, or
    no rows, the trees are a constant.
    """
    n, features = rows.shape
    monotone = np.zeros(features, dtype=int) if monotone is None else monotone
    mean = float(np.clip(target.mean() if n else 0.5, 1e-3, 1 - 1e-3))
    bias = float(np.log(mean / (1 - mean)))
    nodes = _Nodes()
    roots: list[int] = []
    if n and 0 < target.sum() < n:
        cuts = [_cuts(rows[:, j], bins) for j in range(features)]
        binned = np.stack([np.searchsorted(c, rows[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
        margin = np.full(n, bias)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            grown = _grow(nodes, binned, cuts, p - target, p * (1 - p), monotone, depth, rate, bins, smooth, least)
            if grown is None:
                break
            roots.append(grown[0])
            margin += grown[1]
    return Trees(bias, np.asarray(roots, dtype=np.int64), *nodes.arrays(), depth)


class _Nodes:
    def __init__(self):
        self.rows: list[list] = []

    def add(self, value: float) -> int:
        self.rows.append([0, 0.0, len(self.rows), len(self.rows), value])
        return len(self.rows) - 1

    def arrays(self) -> tuple[np.ndarray, ...]:
        kinds = (np.int64, float, np.int64, np.int64, float)
        columns = zip(*self.rows) if self.rows else ([], [], [], [], [])
        return tuple(np.asarray(c, dtype=k) for c, k in zip(columns, kinds))


def _cuts(column: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds half-way between neighbouring values, at most ``bins`` - 1 of them."""
    values = np.unique(column)
    middle = (values[1:] + values[:-1]) / 2
    if len(middle) < bins:
        return middle
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))


def _grow(nodes, binned, cuts, gradient, curvature, monotone, depth, rate, bins, smooth, least):
    n, features = binned.shape
    at = np.zeros(n, dtype=np.int64)  # which of the open leaves a row is in
    gain_floor = 1e-6
    weight = lambda g, h: -g / (h + smooth)
    root = nodes.add(0.0)
    leaves = [(root, -np.inf, np.inf)]
    step = np.zeros(n)
    split_any = False
    for level in range(depth + 1):
        total_g = np.bincount(at[at >= 0], gradient[at >= 0], len(leaves))
        total_h = np.bincount(at[at >= 0], curvature[at >= 0], len(leaves))
        values = np.clip(weight(total_g, total_h), [x[1] for x in leaves], [x[2] for x in leaves])
        best = [(gain_floor, -1, 0)] * len(leaves)
        if level < depth:
            open_rows = at >= 0
            own = at[open_rows] * bins
            lower = np.asarray([x[1] for x in leaves])[:, None]
            upper = np.asarray([x[2] for x in leaves])[:, None]
            for j in range(features):
                if not len(cuts[j]):
                    continue
                cell = own + binned[open_rows, j]
                g = np.bincount(cell, gradient[open_rows], len(leaves) * bins).reshape(-1, bins).cumsum(1)
                h = np.bincount(cell, curvature[open_rows], len(leaves) * bins).reshape(-1, bins).cumsum(1)
                c = np.bincount(cell, minlength=len(leaves) * bins).reshape(-1, bins).cumsum(1)
                rg, rh, rc = total_g[:, None] - g, total_h[:, None] - h, c[:, -1:] - c
                low = np.clip(weight(g, h), lower, upper)
                high = np.clip(weight(rg, rh), lower, upper)
                score = lambda v, a, b: -(2 * a * v + (b + smooth) * v * v)
                gain = score(low, g, h) + score(high, rg, rh) - score(values[:, None], total_g[:, None], total_h[:, None])
                bad = (c < least) | (rc < least)
                if monotone[j]:
                    bad |= (high - low) * monotone[j] < 0
                gain = np.where(bad, -1, gain)[:, : len(cuts[j])]
                pick = gain.argmax(1)
                for leaf, b in enumerate(pick):
                    if gain[leaf, b] > best[leaf][0]:
                        best[leaf] = (float(gain[leaf, b]), j, int(b))
        following, moved = [], np.full(n, -1, dtype=np.int64)
        for leaf, (node, low_bound, high_bound) in enumerate(leaves):
            own = np.flatnonzero(at == leaf)
            _, j, b = best[leaf]
            if j < 0:
                nodes.rows[node][4] = rate * float(values[leaf])
                step[own] = nodes.rows[node][4]
                continue
            split_any = True
            goes_low = binned[own, j] <= b
            parts = own[goes_low], own[~goes_low]
            v = [float(np.clip(weight(gradient[p].sum(), curvature[p].sum()), low_bound, high_bound)) for p in parts]
            middle = (v[0] + v[1]) / 2
            bounds = [(low_bound, high_bound)] * 2
            if monotone[j] > 0:
                bounds = [(low_bound, middle), (middle, high_bound)]
            elif monotone[j] < 0:
                bounds = [(middle, high_bound), (low_bound, middle)]
            children = []
            for part, bound in zip(parts, bounds):
                child = nodes.add(0.0)
                moved[part] = len(following)
                following.append((child, *bound))
                children.append(child)
            nodes.rows[node][:4] = [j, float(cuts[j][b]), *children]
        leaves, at = following, moved
        if not leaves:
            break
    return (root, step) if split_any else None


@dataclass
class Isotonic:
    """A rising step function through (margin, probability) points."""

    edges: np.ndarray
    levels: np.ndarray

    def __call__(self, margin: np.ndarray) -> np.ndarray:
        if not len(self.edges):
            return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        return np.interp(margin, self.edges, self.levels)


def isotonic(margin: np.ndarray, target: np.ndarray) -> Isotonic:
    """Pool adjacent violators; with one class only, the logistic function stays as it is.

    Each pool's level is its mean with half a row of either class added, so a
    pure pool keeps the size of its evidence and no score is exactly 0 or 1.
    """
    if not len(margin) or not 0 < target.sum() < len(target):
        return Isotonic(np.zeros(0), np.zeros(0))
    order = np.argsort(margin, kind="stable")
    pools: list[list[float]] = []  # sum, count, first and last margin
    for m, t in zip(margin[order], target[order]):
        pools.append([float(t), 1, m, m])
        while len(pools) > 1 and (
            pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1] or pools[-2][3] == pools[-1][2]
        ):
            last = pools.pop()
            pools[-1] = [pools[-1][0] + last[0], pools[-1][1] + last[1], pools[-1][2], last[3]]
    edges = np.asarray([e for p in pools for e in (p[2], p[3])])
    levels = np.asarray([x for p in pools for x in [(p[0] + 0.5) / (p[1] + 1)] * 2])
    keep = np.append(np.diff(edges) > 0, True)
    return Isotonic(edges[keep], np.maximum.accumulate(levels)[keep])
