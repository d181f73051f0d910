"""Histogram gradient-boosted trees for a binary label, kept as flat arrays, and isotonic calibration.

Trees are complete to one depth, so a node's children are at 2i + 1 and 2i + 2 and prediction is a fixed number of
array look-ups for all rows at once. Training is deterministic: ties between splits go to the lower feature, then the
lower bin; repeated rows weigh as often as they come. With one class only, or no rows, the model predicts that class's
share (0.5 without rows). Nothing here reads tables: callers give features by place, so no column name can clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    base: float
    depth: int
    feature: np.ndarray  # (trees, 2^depth - 1)
    threshold: np.ndarray
    leaf: np.ndarray  # (trees, 2^depth)

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            out += leaf[at - (len(f))]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, least: float = 2.0, ridge: float = 1.0) -> Trees:
    n, wide = x.shape
    inner = 2**depth - 1
    p = (y.sum() + 0.5) / (n + 1) if n else 0.5
    base = float(np.log(p / (1 - p)))
    empty = Trees(base, depth, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    if not n or y.min() == y.max():
        return empty
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins)[1:-1], method="lower")) for f in range(wide)]
    codes = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)])
    raw = np.full(n, base)
    features, thresholds, leaves = [], [], []
    for _ in range(trees):
        q = 1 / (1 + np.exp(-raw))
        g, h = q - y, q * (1 - q)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        at = np.zeros(n, np.int64)
        for d in range(depth):
            first, many = 2**d - 1, 2**d
            node = at - first
            best = np.full(many, 1e-6)
            total_g, total_h = np.bincount(node, g, many), np.bincount(node, h, many)
            parent = total_g**2 / (total_h + ridge)
            chosen = np.full(many, -1)
            for f in range(wide):
                if not len(cuts[f]):
                    continue
                slot = node * bins + codes[f]
                lg = np.bincount(slot, g, many * bins).reshape(many, bins).cumsum(1)[:, : len(cuts[f])]
                lh = np.bincount(slot, h, many * bins).reshape(many, bins).cumsum(1)[:, : len(cuts[f])]
                rg, rh = total_g[:, None] - lg, total_h[:, None] - lh
                gain = lg**2 / (lh + ridge) + rg**2 / (rh + ridge) - parent[:, None]
                gain[(lh < least) | (rh < least)] = 0
                b = gain.argmax(1)
                top = gain[np.arange(many), b]
                better = top > best + 1e-9
                best[better], chosen[better] = top[better], f
                feature[first : first + many][better] = f
                threshold[first : first + many][better] = cuts[f][b[better]]
            right = x[np.arange(n), feature[at]] > threshold[at]
            at = 2 * at + 1 + right
        node = at - inner
        leaf = -rate * np.bincount(node, g, inner + 1) / (np.bincount(node, h, inner + 1) + ridge)
        raw += leaf[node]
        features.append(feature)
        thresholds.append(threshold)
        leaves.append(leaf)
    return Trees(base, depth, np.array(features), np.array(thresholds), np.array(leaves))


@dataclass
class Isotonic:
    """A non-decreasing map of raw scores to probabilities, linear between its knots."""

    at: np.ndarray
    value: np.ndarray

    def __call__(self, raw: np.ndarray) -> np.ndarray:
        return np.interp(raw, self.at, self.value) if len(self.at) else 1 / (1 + np.exp(-raw))


def fit_isotonic(raw: np.ndarray, y: np.ndarray) -> Isotonic:
    """Pool adjacent violators; every block's mean is drawn towards its neighbours' by half a row of each class."""
    if not len(raw):
        return Isotonic(np.zeros(0), np.zeros(0))
    order = np.argsort(raw, kind="stable")
    blocks: list[list[float]] = []  # sum of labels, rows, sum of scores
    for r, v in zip(raw[order].tolist(), y[order].tolist(), strict=True):
        blocks.append([v, 1.0, r])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    at = np.array([s / n for _, n, s in blocks])
    value = np.array([(v + 0.5) / (n + 1) if n < 2 else (v + 0.01) / (n + 0.02) for v, n, _ in blocks])
    return Isotonic(at, np.clip(np.maximum.accumulate(value), 0, 1))


@dataclass
class Model:
    trees: Trees
    calibration: Isotonic

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.calibration(self.trees.raw(x)) if len(x) else np.zeros(0)


def fit_model(x: np.ndarray, y: np.ndarray, part: np.ndarray, folds: int = 3, **options) -> Model:
    """Trees on all rows, calibrated on scores that each fold (part modulo folds) gets from trees of the others."""
    raw = np.zeros(len(y))
    for k in range(folds):
        own = part % folds == k
        if own.any():
            raw[own] = fit_trees(x[~own], y[~own], **options).raw(x[own])
    trees = fit_trees(x, y, **options)
    if not len(y) or y.min() == y.max():
        return Model(trees, Isotonic(np.zeros(0), np.zeros(0)))
    return Model(trees, fit_isotonic(raw, y))
