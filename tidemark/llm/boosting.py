"""Gradient-boosted trees for a few classes, small enough to travel with a function."""

from __future__ import annotations

import numpy as np

BINS = 32


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class BoostedTrees:
    """Softmax boosting of complete trees over features cut at quantiles.

    Each round fits one tree, whose leaves hold a value for each class, to the gradient of a seeded
    sample: of the columns a share, of the rows the more likely the larger their gradient, weighted
    in return. Fitting is done on the driver, so the caller bounds the rows.
    """

    def __init__(self, classes=3, rounds=90, depth=5, rate=0.3, ridge=2.0, share=0.08, columns=0.4, seed=5):
        self.classes, self.rounds, self.depth, self.rate = classes, rounds, depth, rate
        self.ridge, self.share, self.columns, self.seed = ridge, share, columns, seed

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], "right") for j, c in enumerate(self.cuts)], axis=1).astype(np.uint8)

    @staticmethod
    def _cuts(values: np.ndarray) -> np.ndarray:
        """Every border of few values; of many, quantiles of the rows and, for rare ones, of the values."""
        distinct = np.unique(values)
        if len(distinct) <= BINS:
            return distinct[1:]
        steps = np.linspace(0, 1, BINS // 2 + 1)[1:-1]
        return np.unique(np.concatenate([np.quantile(values, steps), np.quantile(distinct, steps)]))

    def fit(self, x: np.ndarray, label: np.ndarray) -> BoostedTrees:
        draw = np.random.default_rng(self.seed)
        self.cuts = [self._cuts(x[:, j]) for j in range(x.shape[1])]
        bins, wanted = self._binned(x), np.eye(self.classes)[label]
        self.prior = np.log(wanted.mean(axis=0) + 1e-6)
        self.trees = []
        score = np.tile(self.prior, (len(x), 1))
        for _ in range(self.rounds):
            p = softmax(score)
            slope = wanted - p
            chance = np.minimum(1.0, self.share + np.abs(slope).max(axis=1))
            rows = np.flatnonzero(draw.random(len(x)) < chance)
            chosen = np.sort(draw.permutation(x.shape[1])[: max(1, int(self.columns * x.shape[1]))])
            weight = 1 / chance[rows, None]
            curve = np.maximum(p[rows] * (1 - p[rows]), 1e-6) * weight
            feature, border, value = self._grow(bins[np.ix_(rows, chosen)], slope[rows] * weight, curve)
            self.trees.append((chosen[feature], border, value))
            score += self._leaf_values(bins, *self.trees[-1])
        return self

    def _grow(self, bins: np.ndarray, slope: np.ndarray, curve: np.ndarray):
        """Arrays of a complete tree: feature and bin of each inner node, values of each leaf."""
        width, inner = bins.shape[1], 2**self.depth - 1
        feature, border = np.zeros(inner, np.int32), np.full(inner, BINS, np.int32)
        place, row = np.zeros(len(bins), np.int64), np.arange(len(bins))
        cell = bins + np.arange(width) * BINS
        weights = [np.repeat(w, width) for w in (*slope.T, curve.sum(axis=1))]
        for level in range(self.depth):
            nodes, first = 2**level, 2**level - 1
            at = (cell + ((place - first) * (width * BINS))[:, None]).ravel()
            shape = (nodes, width, BINS)
            *g, h = (np.bincount(at, w, nodes * width * BINS).reshape(shape).cumsum(axis=2) for w in weights)
            left, whole = h + self.ridge, h[:, :, -1:] + self.ridge
            right = whole - h
            gain = sum(s * s / left + (s[:, :, -1:] - s) ** 2 / right - s[:, :, -1:] ** 2 / whole for s in g)
            gain = gain.reshape(nodes, -1)
            best, useful = gain.argmax(axis=1), gain.max(axis=1) > 1e-6
            feature[first : first + nodes] = np.where(useful, best // BINS, 0)
            border[first : first + nodes] = np.where(useful, best % BINS, BINS)
            place = 2 * place + 1 + (bins[row, feature[place]] > border[place])
        sums = [[np.bincount(place - inner, w, inner + 1) for w in v.T] for v in (slope, curve)]
        return feature, border, self.rate * np.stack(sums[0], axis=1) / (np.stack(sums[1], axis=1) + self.ridge)

    def _leaf_values(self, bins, feature, border, value) -> np.ndarray:
        place, row = np.zeros(len(bins), np.int64), np.arange(len(bins))
        for _ in range(self.depth):
            place = 2 * place + 1 + (bins[row, feature[place]] > border[place])
        return value[place - (2**self.depth - 1)]

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        bins = self._binned(x)
        score = np.tile(self.prior, (len(x), 1))
        for tree in self.trees:
            score += self._leaf_values(bins, *tree)
        return np.log(softmax(score) + 1e-9)
