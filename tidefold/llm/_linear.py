"""A linear classifier trained online by follow-the-regularised-leader (proximal) updates."""

from __future__ import annotations

import numpy as np


class Ftrl:
    """Logistic regression over sparse rows given as (indices, values); per-coordinate FTRL-proximal.

    Weights are zero until a coordinate's accumulated gradient passes ``l1``. The bias has no penalty.
    """

    def __init__(self, size: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02) -> None:
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.z0 = self.n0 = 0.0

    def weights(self, i: np.ndarray | slice = slice(None)) -> np.ndarray:
        z = self.z[i]
        step = (self.beta + np.sqrt(self.n[i])) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / step)

    @property
    def bias(self) -> float:
        return -self.z0 / ((self.beta + self.n0**0.5) / self.alpha)

    def learn(self, i: np.ndarray, x: np.ndarray, y: float, weight: float = 1.0) -> None:
        w, b = self.weights(i), self.bias
        g = weight * (1 / (1 + np.exp(-np.clip(b + w @ x, -35, 35))) - y)
        gx = g * x
        self.z[i] += gx - (np.sqrt(self.n[i] + gx * gx) - np.sqrt(self.n[i])) / self.alpha * w
        self.n[i] += gx * gx
        self.z0 += g - ((self.n0 + g * g) ** 0.5 - self.n0**0.5) / self.alpha * b
        self.n0 += g * g


def sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -35, 35))))
