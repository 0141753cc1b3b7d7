"""Boosted trees for a yes or no, on binned features, and isotonic calibration, in numpy.

They are fitted on the driver from a bounded sample of rows, which the caller's parameter
limits, and shipped to tasks as a few small arrays.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Trees:
    """Complete trees of one depth, as arrays over nodes in breadth-first order."""

    edges: list[np.ndarray] = field(default_factory=list)
    base: float = 0.0
    features: np.ndarray | None = None
    cuts: np.ndarray | None = None
    leaves: np.ndarray | None = None

    def _bins(self, rows: np.ndarray) -> np.ndarray:
        out = np.empty(rows.shape, np.uint8)
        for j, edge in enumerate(self.edges):
            out[:, j] = np.searchsorted(edge, rows[:, j], "left")
        return out

    def raw(self, rows: np.ndarray) -> np.ndarray:
        """Log-odds of every row."""
        total = np.full(len(rows), self.base)
        if self.features is None or not len(rows):
            return total
        binned, each, depth = self._bins(rows), np.arange(len(rows)), int(np.log2(self.leaves.shape[1]))
        for feature, cut, leaf in zip(self.features, self.cuts, self.leaves):
            node = np.zeros(len(rows), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (binned[each, feature[node]] > cut[node])
            total += leaf[node - (leaf.size - 1)]
        return total


def fit_trees(rows: np.ndarray, labels: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2,
              bins: int = 32, penalty: float = 1.0, least: float = 1.0) -> Trees:
    """Newton boosting of the logistic loss. One class or no row at all gives a constant."""
    positive = float(labels.sum())
    share = min(max((positive + 0.5) / (len(labels) + 1.0), 1e-6), 1 - 1e-6)
    model = Trees(base=float(np.log(share / (1 - share))))
    if positive in (0.0, float(len(labels))):
        return model
    model.edges = [np.unique(np.quantile(rows[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(rows.shape[1])]
    binned, (n, width) = model._bins(rows).astype(np.int64), rows.shape
    slot = binned + np.arange(width) * bins
    score, features, cuts, leaves = np.full(n, model.base), [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        slope, bend = labels - p, p * (1 - p)
        feature, cut, node = np.zeros((1 << depth) - 1, np.int64), np.full((1 << depth) - 1, bins, np.int64), np.zeros(n, np.int64)
        for level in range(depth):
            first, many = (1 << level) - 1, 1 << level
            place = ((node - first)[:, None] * (width * bins) + slot).ravel()
            g, h = (np.bincount(place, np.repeat(x, width), many * width * bins).reshape(many, width, bins).cumsum(2) for x in (slope, bend))
            g_all, h_all = g[:, :, -1:], h[:, :, -1:]
            gain = g * g / (h + penalty) + (g_all - g) ** 2 / (h_all - h + penalty) - g_all ** 2 / (h_all + penalty)
            gain[(h < least) | (h_all - h < least)] = 0
            flat = gain.reshape(many, -1)
            best = flat.argmax(1)
            good = flat[np.arange(many), best] > 1e-9
            feature[first:first + many] = np.where(good, best // bins, 0)
            cut[first:first + many] = np.where(good, best % bins, bins)
            node = 2 * node + 1 + (binned[np.arange(n), feature[node]] > cut[node])
        leaf = node - ((1 << depth) - 1)
        value = rate * np.bincount(leaf, slope, 1 << depth) / (np.bincount(leaf, bend, 1 << depth) + penalty)
        score += value[leaf]
        features.append(feature)
        cuts.append(cut)
        leaves.append(value)
    model.features, model.cuts, model.leaves = np.array(features), np.array(cuts), np.array(leaves)
    return model


@dataclass
class Isotonic:
    """A rising curve from raw scores to probabilities."""

    at: np.ndarray
    value: np.ndarray

    def __call__(self, raw: np.ndarray) -> np.ndarray:
        return np.interp(raw, self.at, self.value) if len(self.at) else 1 / (1 + np.exp(-raw))


def fit_isotonic(raw: np.ndarray, labels: np.ndarray) -> Isotonic:
    """Pool adjacent violators; every pool is smoothed by half a count towards the share of all."""
    if not len(raw):
        return Isotonic(np.zeros(0), np.zeros(0))
    order, share, pools = np.argsort(raw, kind="stable"), float(labels.mean()), []
    for x, y in zip(raw[order], labels[order]):
        pools.append([float(y), 1.0, x, x])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [pools[-1][0] + last[0], pools[-1][1] + last[1], pools[-1][2], last[3]]
    at, value = [], []
    for total, many, low, high in pools:
        p = (total + 0.5 * share) / (many + 0.5)
        at += [low, high]
        value += [p, p]
    return Isotonic(np.array(at), np.maximum.accumulate(np.array(value)))


def cross_fit(rows: np.ndarray, labels: np.ndarray, fold: np.ndarray, **kw) -> tuple[Trees, Isotonic]:
    """Trees on all rows, and a calibration of trees that didn't see the row."""
    raw = np.zeros(len(labels))
    for f in np.unique(fold):
        out = fold == f
        raw[out] = fit_trees(rows[~out], labels[~out], **kw).raw(rows[out])
    return fit_trees(rows, labels, **kw), fit_isotonic(raw, labels)
