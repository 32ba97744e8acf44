"""Linear models in numpy, small enough for the driver: fitted on bounded samples."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def unpacked(column: pa.ChunkedArray, order: np.ndarray) -> list[np.ndarray]:
    """The lists of a column, in an order of its rows."""
    lists = column.combine_chunks()
    ends, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    return [values[ends[i] : ends[i + 1]] for i in order.tolist()]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, rounds: int = 12) -> np.ndarray:
    """Weights, the intercept last, by Newton's method; y may be probabilities. The intercept is not penalised."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], l2)
    ridge[-1] = 1e-6
    if not len(x):
        return w
    for _ in range(rounds):
        p = sigmoid(x @ w)
        slope = x.T @ (p - y) + ridge * w
        bend = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(bend, slope)
        w -= step * min(1.0, 10 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w


def apply_logistic(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return sigmoid(x @ w[:-1] + w[-1])
