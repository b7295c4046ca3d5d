"""Small models: boosted trees, fitted on sums that tasks may make, and logistic regression."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


SCALE = float(1 << 26)  # sums are of whole numbers, so that they are the same in whatever order tasks make them
Splits = list[tuple[int, float]]


def cuts_of(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Up to 25 quantiles of ascending values that are there so many times each."""
    ends = counts.cumsum()
    at = np.linspace(0.02, 0.98, 25) * (ends[-1] - 1)
    low = np.floor(at).astype(np.int64)
    a, b = (values[np.searchsorted(ends, k, side="right")] for k in (low, np.minimum(low + 1, ends[-1] - 1)))
    t = at - low
    return np.unique(np.where(t < 0.5, a + (b - a) * t, b - (b - a) * (1 - t)))


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Of each value the number of its column's cuts below it."""
    return np.column_stack([np.searchsorted(cs, c, side="left").astype(np.int8) for cs, c in zip(cuts, x.T, strict=True)])


@dataclass
class Boosted:
    """Gradient boosting of the log loss with oblivious trees: one feature and threshold for each level."""

    rounds: int = 40
    depth: int = 3
    rate: float = 0.3
    base: float = 0.0
    trees: list[tuple[Splits, np.ndarray]] = field(default_factory=list)

    def start(self, mean: float) -> Boosted:
        mean = np.clip(mean, 1e-3, 1 - 1e-3)
        self.base, self.trees = float(np.log(mean / (1 - mean))), []
        return self

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        cuts = [cuts_of(*np.unique(c, return_counts=True)) for c in x.T]
        bins, n = binned(x, cuts), np.ones(len(y), np.int64)
        grow([self.start(y.mean())], cuts, lambda splits: [self.sums(splits[0], cuts, bins, y, n)])
        return self.unbinned(cuts)

    def sums(self, splits: Splits, cuts: list[np.ndarray], bins: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Gradients and hessians of rows that are there n times each, by leaf of the unfinished tree and by bin; features' bins stand in a row."""
        widths = np.array([len(cs) + 1 for cs in cuts])
        p, size = self.predict(bins), int(widths.sum())
        own = (leaves(splits, bins)[:, None] * size + (widths.cumsum() - widths) + bins).ravel()
        sides = (np.bincount(own, np.repeat(np.rint(w * SCALE) * n, len(cuts)), size << len(splits)) for w in (y - p, p * (1 - p)))
        return np.stack([s.astype(np.int64).reshape(-1, size) for s in sides])

    def predict(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.base)
        for splits, values in self.trees:
            score += values[leaves(splits, x)]
        return sigmoid(score)

    def unbinned(self, cuts: list[np.ndarray]) -> Boosted:
        """The same trees for values."""
        self.trees = [([(f, float(cuts[f][int(k)])) for f, k in splits], values) for splits, values in self.trees]
        return self


def leaves(splits: Splits, x: np.ndarray) -> np.ndarray:
    leaf = np.zeros(len(x), np.int64)
    for f, c in splits:
        leaf = leaf * 2 + (x[:, f] > c)
    return leaf


def grow(models: list[Boosted], cuts: list[np.ndarray], sums: Callable[[list[Splits]], list[np.ndarray]]) -> None:
    """Fits started models to bins, a level at a time and all together. sums gives those of each model (`Boosted.sums`) for the splits of
    its unfinished tree; only these sums are seen, whatever the number of rows."""
    widths = np.array([len(cs) + 1 for cs in cuts])
    ends = widths.cumsum()
    feature, start = np.repeat(np.arange(len(cuts)), widths), np.repeat(ends - widths, widths)
    for _ in range(models[0].rounds):
        splits: list[Splits] = [[] for _ in models]
        halves = [np.zeros(0)] * len(models)
        for _ in range(models[0].depth):
            for k, s in enumerate(sums(splits)):
                run = np.concatenate([np.zeros_like(s[..., :1]), s.cumsum(-1)], -1)
                below = (run[..., 1:] - run[..., start]) / SCALE
                above = below[..., ends[0] - 1 : ends[0]] - below
                gain = sum(g**2 / (h + 1) for g, h in (below, above)).sum(0)
                gain[ends - 1] = -1  # nothing is above a feature's last bin
                at = int(gain.argmax())
                splits[k].append((int(feature[at]), int(at - start[at])))
                halves[k] = np.stack([below[..., at], above[..., at]], -1).reshape(2, -1)
        for m, own, (g, h) in zip(models, splits, halves, strict=True):
            m.trees.append((own, m.rate * g / (h + 1)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Weights, the constant first, by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[0] = 1e-3
    for _ in range(steps):
        p = sigmoid(x @ w)
        gradient = x.T @ (y - p) - penalty * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w
