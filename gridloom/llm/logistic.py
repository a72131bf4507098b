"""Ridge logistic regression on a few features, of rows or of weighted cells."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(np.clip(z, -60, 60) / 2))


@dataclass
class Logistic:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.weights[0] + ((x - self.mean) / self.scale) @ self.weights[1:], -30, 30)

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logit(x))


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50, weight: np.ndarray | None = None) -> Logistic:
    """Newton steps, halved while they do not help; ``ridge`` keeps separable data finite.

    With one class only (or no rows) the score is the smoothed share of ones everywhere.  A row
    of ``weight`` w counts as w rows.
    """
    features = x.shape[1]
    if len(y) == 0 or y.min() == y.max():
        ones, rows = (y.sum(), len(y)) if weight is None else ((weight * y).sum(), weight.sum())
        share = (ones + 0.5) / (rows + 1)
        return Logistic(np.zeros(features), np.ones(features), np.r_[np.log(share / (1 - share)), np.zeros(features)])
    if weight is None:
        weight = np.ones(len(y))
        mean, scale = x.mean(axis=0), x.std(axis=0)
    else:
        mean = np.average(x, axis=0, weights=weight)
        scale = np.sqrt(np.average((x - mean) ** 2, axis=0, weights=weight))
    scale[scale == 0] = 1
    a = np.c_[np.ones(len(x)), (x - mean) / scale]
    penalty = np.r_[1e-6, np.full(features, ridge)]
    b = np.zeros(features + 1)

    def loss(b: np.ndarray) -> float:
        z = a @ b
        return float((weight * np.logaddexp(0, z)).sum() - (weight * y) @ z + 0.5 * (penalty * b * b).sum())

    now = loss(b)
    for _ in range(steps):
        p = sigmoid(a @ b)
        gradient = a.T @ (weight * (p - y)) + penalty * b
        step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + np.diag(penalty), gradient)
        for _ in range(20):
            if (then := loss(b - step)) <= now:
                break
            step = step / 2
        b, done, now = b - step, now - then < 1e-9 * max(1.0, now), then
        if done:
            break
    return Logistic(mean, scale, b)
