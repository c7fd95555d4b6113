"""Sparse rows and gradient steps for the small linear models that are fitted on samples."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


class Rows:
    """Compressed sparse rows: feature numbers, values and where each row begins."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray]]):
        sizes = np.array([len(i) for i, _ in parts], np.int64)
        self.n = len(parts)
        self.index = np.concatenate([i for i, _ in parts]) if parts else np.zeros(0, np.int32)
        self.value = np.concatenate([v for _, v in parts]) if parts else np.zeros(0, np.float32)
        self.row = np.repeat(np.arange(self.n, dtype=np.int32), sizes)

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * weights[self.index], self.n)

    def gradient(self, factor: np.ndarray, dim: int) -> np.ndarray:
        return np.bincount(self.index, self.value * factor[self.row], dim)


def adam(loss: Callable[[np.ndarray, float], tuple[np.ndarray, float]], dim: int, steps: int, rate: float,
         decay: float) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam, the mean of the second half of the steps; ``loss`` returns both gradients."""
    w, m, v, mean = np.zeros(dim + 1), np.zeros(dim + 1), np.zeros(dim + 1), np.zeros(dim + 1)
    for t in range(1, steps + 1):
        gw, gb = loss(w[:-1], w[-1])
        g = np.append(gw + decay * w[:-1], gb)
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        if t > steps // 2:
            mean += w / (steps - steps // 2)
    return mean[:-1], float(mean[-1])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))
