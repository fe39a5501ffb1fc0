"""Small dense logistic regressions, fitted in the driver on bounded samples."""

from __future__ import annotations

import numpy as np


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40.0, 40.0)))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weights with the intercept last, by Newton steps; ``l2`` holds all but the intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    w, penalty = np.zeros(x.shape[1]), np.r_[np.full(x.shape[1] - 1, l2), 1e-6]
    for _ in range(steps):
        p = sigmoid(x @ w)
        gradient = x.T @ (weight * (p - y)) + penalty * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        size = np.abs(step).max()
        w -= step * min(1.0, 5.0 / max(size, 1e-12))
        if size < 1e-8:
            break
    return w
