"""Gradient-boosted trees for two classes: logistic loss, Newton steps, splits at quantiles."""

from __future__ import annotations

import numpy as np

BINS, DEPTH, TREES, RATE, MIN_ROWS, RIDGE = 32, 4, 60, 0.2, 20, 1.0


class BoostedTrees:
    """Trees of fixed depth, each as arrays of features, thresholds and leaf values."""

    def __init__(self):
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        cuts = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
        binned = np.column_stack([np.searchsorted(cut, column, side="left") for cut, column in zip(cuts, x.T)])
        score = np.zeros(len(y))
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            tree = self.grow(binned, cuts, y - p, p * (1 - p))
            self.trees.append(tree)
            score += self.leaf(tree, x)
        return self

    @staticmethod
    def grow(binned, cuts, gradient, hessian):
        inner = (1 << DEPTH) - 1
        feature, threshold, value = np.zeros(inner, int), np.full(inner, np.inf), np.zeros(inner + 1)
        node = np.zeros(len(gradient), int)
        for at in range(inner):
            rows = np.nonzero(node == at)[0]
            best = 1e-6
            choice = None
            if len(rows) >= 2 * MIN_ROWS:
                g, h = gradient[rows], hessian[rows]
                whole = g.sum() ** 2 / (h.sum() + RIDGE)
                for column, cut in enumerate(cuts):
                    if not len(cut):
                        continue
                    bins = binned[rows, column]
                    gs, hs, ns = (np.bincount(bins, w, len(cut) + 1).cumsum()[:-1] for w in (g, h, None))
                    gain = gs ** 2 / (hs + RIDGE) + (g.sum() - gs) ** 2 / (h.sum() - hs + RIDGE) - whole
                    gain[(ns < MIN_ROWS) | (len(rows) - ns < MIN_ROWS)] = 0
                    if gain.max() > best:
                        best, choice = gain.max(), (column, int(gain.argmax()))
            if choice:
                feature[at], threshold[at] = choice[0], cuts[choice[0]][choice[1]]
                right = binned[rows, choice[0]] > choice[1]
            else:
                right = np.zeros(len(rows), bool)
            node[rows] = 2 * at + 1 + right
        for leaf in range(inner + 1):
            rows = node == inner + leaf
            value[leaf] = RATE * gradient[rows].sum() / (hessian[rows].sum() + RIDGE)
        return feature, threshold, value

    @staticmethod
    def leaf(tree, x: np.ndarray) -> np.ndarray:
        feature, threshold, value = tree
        node, rows = np.zeros(len(x), int), np.arange(len(x))
        for _ in range(DEPTH):
            node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
        return value[node - len(feature)]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return sum((self.leaf(tree, x) for tree in self.trees), np.zeros(len(x)))
