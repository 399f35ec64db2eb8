"""Logistic regression on a bounded table in the driver, by accelerated proximal gradient."""

from __future__ import annotations

import numpy as np


def probability(margin: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -40, 40)))


def fit(
    x: np.ndarray, y: np.ndarray, lasso: float = 0.0, ridge: float = 0.0, rounds: int = 300
) -> tuple[float, np.ndarray]:
    """Intercept and weights; ``lasso`` and ``ridge`` are penalties on the weights for the mean loss."""
    n, columns = x.shape
    intercept, weights = 0.0, np.zeros(columns)
    if not n or not columns or y.min() == y.max():
        share = min(max(float(y.mean()) if n else 0.5, 1e-3), 1 - 1e-3)
        return float(np.log(share / (1 - share))), weights
    # a bound of the curvature by power iteration
    v = np.ones(columns) / np.sqrt(columns)
    for _ in range(20):
        v = x.T @ (x @ v) / n
        norm = np.linalg.norm(v)
        if norm == 0:
            break
        v /= norm
    step = 1.0 / (0.25 * (norm + 1.0) + ridge + 1e-12)
    ahead, ahead_intercept, t = weights, intercept, 1.0
    for _ in range(rounds):
        error = probability(x @ ahead + ahead_intercept) - y
        moved = ahead - step * (x.T @ error / n + ridge * ahead)
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * lasso, 0)
        new_intercept = ahead_intercept - step * float(error.mean())
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        pull = (t - 1) / t_next
        ahead, ahead_intercept = new + pull * (new - weights), new_intercept + pull * (new_intercept - intercept)
        weights, intercept, t = new, new_intercept, t_next
    return intercept, weights
