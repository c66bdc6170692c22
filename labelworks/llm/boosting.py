"""Gradient-boosted trees for small labelled tables, as arrays that tasks can carry."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Full binary trees of one depth: a feature and a limit for each inner place, a value for each leaf."""

    depth: int
    start: float
    feature: np.ndarray
    limit: np.ndarray
    value: np.ndarray

    def margin(self, rows: np.ndarray) -> np.ndarray:
        out, index = np.full(len(rows), self.start), np.arange(len(rows))
        for feature, limit, value in zip(self.feature, self.limit, self.value, strict=True):
            at = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (rows[index, feature[at]] > limit[at])
            out += value[at - len(feature)]
        return out

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(rows), -30, 30)))


def fit(rows: np.ndarray, labels: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.3, bins: int = 32, penalty: float = 1.0) -> Trees:
    """Logistic loss, Newton steps, level by level over quantile bins of each feature."""
    n, width = rows.shape
    edges = [np.unique(np.quantile(rows[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(e, rows[:, j], "left") for j, e in enumerate(edges)], 1)
    share = labels.mean().clip(1e-6, 1 - 1e-6)
    start = float(np.log(share / (1 - share)))
    margin, inner = np.full(n, start), 2**depth - 1
    features, limits, values = [], [], []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        slope, bend = labels - p, p * (1 - p)
        feature, limit, at = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            place = at - first
            best = np.full(count, 1e-9)
            for j, e in enumerate(edges):
                if not len(e):
                    continue
                cell = place * (len(e) + 1) + binned[:, j]
                g = np.bincount(cell, slope, count * (len(e) + 1)).reshape(count, -1)
                h = np.bincount(cell, bend, count * (len(e) + 1)).reshape(count, -1)
                gl, hl = g.cumsum(1)[:, :-1], h.cumsum(1)[:, :-1]
                gt, ht = g.sum(1, keepdims=True), h.sum(1, keepdims=True)
                gain = gl**2 / (hl + penalty) + (gt - gl) ** 2 / (ht - hl + penalty) - gt**2 / (ht + penalty)
                cut = gain.argmax(1)
                better = gain[np.arange(count), cut] > best
                best = np.where(better, gain[np.arange(count), cut], best)
                feature[first : first + count][better] = j
                limit[first : first + count][better] = e[cut[better]]
            at = 2 * at + 1 + (rows[np.arange(n), feature[at]] > limit[at])
        leaf = at - inner
        value = rate * np.bincount(leaf, slope, inner + 1) / (np.bincount(leaf, bend, inner + 1) + penalty)
        margin = margin + value[leaf]
        features.append(feature)
        limits.append(limit)
        values.append(value)
    return Trees(depth, start, np.array(features), np.array(limits), np.array(values))
