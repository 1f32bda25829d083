"""Gradient-boosted trees for several classes, on binned features, in numpy."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

BINS = 32


@dataclass
class Trees:
    """Complete trees of one depth: features and thresholds of the inner nodes, values of the leaves."""

    depth: int
    classes: int
    base: np.ndarray
    feature: list[np.ndarray] = field(default_factory=list)
    threshold: list[np.ndarray] = field(default_factory=list)
    value: list[np.ndarray] = field(default_factory=list)

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.tile(self.base, (len(x), 1))
        rows = np.arange(len(x))
        for k, (f, t, v) in enumerate(zip(self.feature, self.threshold, self.value, strict=True)):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            out[:, k % self.classes] += v[node - (2**self.depth - 1)]
        return out

    def classify(self, x: np.ndarray) -> np.ndarray:
        return self.margins(x).argmax(axis=1) if len(x) else np.empty(0, np.int64)


def probabilities(model: Trees, x: np.ndarray) -> np.ndarray:
    """The probabilities of the classes."""
    p = model.margins(x)
    p = np.exp(p - p.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def fit(x: np.ndarray, y: np.ndarray, classes: int, rounds: int = 30, depth: int = 4, rate: float = 0.3, penalty: float = 1.0) -> Trees:
    """Trees that lower the softmax loss; each split maximises the second-order gain over quantile bins."""
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(width)]
    for j in range(width):  # rare values get cuts of their own
        values = np.unique(x[:, j])
        if len(values) <= BINS:
            cuts[j] = (values[1:] + values[:-1]) / 2
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    share = np.bincount(y, minlength=classes) + 1.0
    model = Trees(depth, classes, np.log(share / share.sum()))
    margin = np.tile(model.base, (n, 1))
    one = np.eye(classes)[y]
    for _ in range(rounds):
        p = np.exp(margin - margin.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        for k in range(classes):
            g, h = p[:, k] - one[:, k], np.maximum(p[:, k] * (1 - p[:, k]), 1e-6)
            node = np.zeros(n, np.int64)
            inner = 2**depth - 1
            feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
            for level in range(depth):
                first, many = 2**level - 1, 2**level
                local = node - first
                best, at, cut = np.full(many, 1e-6), np.zeros(many, np.int64), np.full(many, np.inf)
                for j in range(width):
                    bins = len(cuts[j]) + 1
                    if bins < 2:
                        continue
                    key = local * bins + binned[:, j]
                    gl = np.bincount(key, g, many * bins).reshape(many, bins).cumsum(axis=1)
                    hl = np.bincount(key, h, many * bins).reshape(many, bins).cumsum(axis=1)
                    gt, ht = gl[:, -1:], hl[:, -1:]
                    gain = gl**2 / (hl + penalty) + (gt - gl) ** 2 / (ht - hl + penalty) - gt**2 / (ht + penalty)
                    gain = gain[:, :-1]
                    b = gain.argmax(axis=1)
                    top = gain[np.arange(many), b]
                    better = top > best
                    best[better], at[better], cut[better] = top[better], j, cuts[j][b[better]]
                feature[first : first + many], threshold[first : first + many] = at, cut
                node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
            leaf = node - inner
            value = -rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + penalty)
            model.feature.append(feature)
            model.threshold.append(threshold)
            model.value.append(value)
            margin[:, k] += value[leaf]
    return model
