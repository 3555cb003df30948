"""Small logistic models fitted on the driver from bounded samples."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def newton(x: np.ndarray, y: np.ndarray, prior: np.ndarray, strength: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Weights of a logistic model with a Gaussian prior, by damped Newton steps. For few columns."""
    w = prior.copy()

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.sum(np.logaddexp(0, z) - y * z) + np.sum(strength * (w - prior) ** 2) / 2)

    now = loss(w)
    for _ in range(rounds):
        p = sigmoid(x @ w)
        slope = x.T @ (p - y) + strength * (w - prior)
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(strength)
        step, size = np.linalg.solve(curve, slope), 1.0
        while size > 1e-6 and (new := loss(w - size * step)) > now:
            size /= 2
        if size <= 1e-6 or now - new < 1e-9 * (1 + abs(now)):
            break
        w, now = w - size * step, new
    return w


def sparse_logistic(
    rows: np.ndarray, columns: np.ndarray, values: np.ndarray, y: np.ndarray, size: int, ridge: float, rounds: int
) -> np.ndarray:
    """Weights, the intercept last, of a ridge logistic model over sparse cells, by accelerated gradient steps."""
    n = len(y)
    w = np.zeros(size + 1)
    look, t = w.copy(), 1.0
    reach = float(np.max(np.bincount(rows, values**2, n), initial=0.0)) + 1.0
    rate = 1.0 / (reach / 4 + ridge)
    for _ in range(rounds):
        p = sigmoid(np.bincount(rows, values * look[columns], n) + look[-1])
        slope = np.empty_like(w)
        slope[:-1] = np.bincount(columns, values * (p - y)[rows], size) / n + ridge * look[:-1]
        slope[-1] = np.mean(p - y)
        new = look - rate * slope
        t, old = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        look = new + (old - 1) / t * (new - w)
        w = new
    return w
