"""Gradient-boosted trees of depth two for small feature tables, and their form as a column.

Cases: features are finite numbers; one class only, or features that don't tell classes apart, give a
constant score; repeated rows weigh as often as they occur; equal gains go to the first feature and cut,
so that a fit repeats; as a column, a null feature takes the upper branch.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

Split = tuple[int, float]


@dataclass
class Boosted:
    """score = start + the sum over trees; a tree is (split, (split, low, high), (split, low, high))."""

    names: list[str]
    start: float = 0.0
    trees: list[tuple] = field(default_factory=list)

    def scores(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for (f, t), low, high in self.trees:
            for own, at in ((low, x[:, f] <= t), (high, x[:, f] > t)):
                (g, u), a, b = own
                out[at] += np.where(x[at, g] <= u, a, b)
        return out

    def column(self, feature) -> Column:
        """The score where feature(name) is the column of a feature."""
        branch = lambda own: F.when(feature(self.names[own[0][0]]) <= own[0][1], own[1]).otherwise(own[2])
        out = F.lit(self.start)
        for (f, t), low, high in self.trees:
            out = out + F.when(feature(self.names[f]) <= t, branch(low)).otherwise(branch(high))
        return out


def _best_split(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, cuts: list[np.ndarray], ridge: float) -> tuple[float, Split]:
    best = (-1.0, (0, float("inf")))
    g, h = grad.sum(), hess.sum()
    for f, own in enumerate(cuts):
        for t in own:
            at = x[:, f] <= t
            gl, hl = grad[at].sum(), hess[at].sum()
            gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
            if gain > best[0] + 1e-12:
                best = (gain, (f, float(t)))
    return best


def fit(x: np.ndarray, y: np.ndarray, names: list[str], rounds: int = 40, rate: float = 0.3, ridge: float = 1.0) -> Boosted:
    """Newton boosting of the logistic loss. Deterministic: ties go to the first feature and cut."""
    p = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    out = Boosted(names, math.log(p / (1 - p)))
    cuts = []
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        middles = (values[1:] + values[:-1]) / 2
        cuts.append(middles if len(middles) <= 16 else np.unique(np.quantile(middles, np.linspace(0, 1, 16))))
    raw = np.full(len(x), out.start)
    for _ in range(rounds):
        prob = 1 / (1 + np.exp(-raw))
        grad, hess = y - prob, prob * (1 - prob)
        gain, (f, t) = _best_split(x, grad, hess, cuts, ridge)
        if gain <= 1e-9:
            break
        halves = []
        for at in (x[:, f] <= t, x[:, f] > t):
            _, (g, u) = _best_split(x[at], grad[at], hess[at], cuts, ridge)
            leaf = [rate * float(grad[at][m].sum() / (hess[at][m].sum() + ridge)) for m in (x[at, g] <= u, x[at, g] > u)]
            halves.append(((g, u), *leaf))
        out.trees.append(((f, t), *halves))
        raw = out.scores(x)
    return out
