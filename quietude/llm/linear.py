"""Linear support vector machines by dual coordinate descent."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


def fit_hinge(rows: Sequence[tuple[np.ndarray, np.ndarray]], y: np.ndarray, dims: int, cost: float | np.ndarray = 1.0,
              epochs: int = 20, seed: int = 1, tolerance: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and bias of a hinge-loss model with an L2 penalty.

    ``rows`` are (feature indices, values), ``y`` is +1 or -1. Each step solves
    the dual for one row exactly; the bias is the weight of a constant feature.
    """
    w, bias = np.zeros(dims), 0.0
    alpha = np.zeros(len(rows))
    most = np.broadcast_to(np.asarray(cost, float), (len(rows),))
    norm = np.array([float(v @ v) + 1.0 for _, v in rows])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            at, v = rows[i]
            gradient = y[i] * (w[at] @ v + bias) - 1.0
            new = min(max(alpha[i] - gradient / norm[i], 0.0), most[i])
            step = new - alpha[i]
            if step:
                alpha[i] = new
                w[at] += step * y[i] * v
                bias += step * y[i]
                moved = max(moved, abs(gradient))
        if moved < tolerance:
            break
    return w, bias


def fit_sigmoid(margins: np.ndarray, labels: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """(a, b) so that 1 / (1 + exp(-(a * margin + b))) fits the 0/1 labels:
    logistic regression on one feature by Newton's method, lightly penalised."""
    x = np.stack([margins, np.ones_like(margins)], axis=1)
    theta, ridge = np.array([1.0, 0.0]), np.diag([1e-3, 1e-3])
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ theta, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(hess, x.T @ (labels - p) - ridge @ theta)
        theta = theta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(theta[0]), float(theta[1])
