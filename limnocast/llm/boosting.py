"""Histogram gradient-boosted trees for a yes-or-no target, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """All trees in flat arrays; a node sends ``x[feature] <= cut`` left, a leaf sends every row to itself."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of statistics."""
        total = np.full(len(rows), self.base)
        if len(self.roots):
            at = np.tile(self.roots, (len(rows), 1))
            index = np.arange(len(rows))[:, None]
            for _ in range(self.depth):
                at = np.where(rows[index, self.feature[at]] <= self.cut[at], self.left[at], self.right[at])
            total += self.value[at].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def fit(
    rows: np.ndarray,
    target: np.ndarray,
    trees: int = 80,
    depth: int = 4,
    bins: int = 64,
    rate: float = 0.15,
    ridge: float = 1.0,
    least: float = 2.0,
) -> Trees:
    """Trees grown level by level on statistics cut at their quantiles.

    ``target`` is between 0 and 1. Without rows every score is one half; where all targets agree
    it is their smoothed mean.
    """
    mean = (target.sum() + 0.5) / (len(target) + 1)
    base = float(np.log(mean / (1 - mean)))
    flat: list[list[float]] = []  # feature, cut, left, right, value
    roots: list[int] = []
    if len(target) and target.min() < target.max():
        n, width = rows.shape
        cuts = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
        binned = np.stack([np.searchsorted(cuts[f], rows[:, f], side="left") for f in range(width)], axis=1)
        offset = binned + np.arange(width) * bins
        raw = np.full(n, base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-raw))
            raw += _grow(flat, roots, offset, binned, cuts, p - target, p * (1 - p), depth, bins, rate, ridge, least)
    table = np.array(flat).reshape(-1, 5)
    whole = [table[:, i].astype(np.int64) for i in (0, 2, 3)]
    return Trees(whole[0], table[:, 1], whole[1], whole[2], table[:, 4], np.array(roots, np.int64), depth, base)


def _grow(flat, roots, offset, binned, cuts, slope, curve, depth, bins, rate, ridge, least) -> np.ndarray:
    """Append one tree; what it adds to each row is returned."""
    n, width = binned.shape
    first = len(flat)
    roots.append(first)
    flat.append([0, np.inf, first, first, 0.0])
    node = np.full(n, first)
    level = [first]
    for _ in range(depth):
        place = np.full(len(flat) - first, -1)
        place[np.array(level) - first] = np.arange(len(level))
        here = place[node - first]
        live = here >= 0
        cell = (here[live, None] * (width * bins) + offset[live]).ravel()
        size = len(level) * width * bins
        g = np.bincount(cell, np.repeat(slope[live], width), size).reshape(-1, width, bins)
        h = np.bincount(cell, np.repeat(curve[live], width), size).reshape(-1, width, bins)
        gl, hl = g.cumsum(axis=2)[:, :, :-1], h.cumsum(axis=2)[:, :, :-1]
        gt, ht = g.sum(axis=2, keepdims=True), h.sum(axis=2, keepdims=True)
        gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
        gain[(hl < least) | (ht - hl < least)] = 0
        best = gain.reshape(len(level), -1).argmax(axis=1)
        grown = []
        for i, at in enumerate(level):
            f, b = divmod(int(best[i]), bins - 1)
            if gain[i, f, b] <= 1e-9 or b >= len(cuts[f]):
                continue
            left = len(flat)
            flat[at][:4] = [f, cuts[f][b], left, left + 1]
            for _ in range(2):
                flat.append([0, np.inf, len(flat), len(flat), 0.0])
            rows = node == at
            node[rows] = np.where(binned[rows, f] <= b, left, left + 1)
            grown += [left, left + 1]
        if not grown:
            break
        level = grown
    size = len(flat) - first
    g, h = np.bincount(node - first, slope, size), np.bincount(node - first, curve, size)
    value = -rate * g / (h + ridge)
    for i in range(size):
        if flat[first + i][2] == first + i:
            flat[first + i][4] = float(value[i])
    return value[node - first]
