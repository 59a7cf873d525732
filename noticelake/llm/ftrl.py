"""Follow-the-regularised-leader with elastic-net penalties, per coordinate."""

from __future__ import annotations

import numpy as np


class Ftrl:
    """Proximal FTRL over a hashed feature space with ``classes`` outputs.

    A coordinate's weight is zero until its accumulated gradient exceeds ``l1``,
    so the learned matrix stays sparse.
    """

    def __init__(self, dim: int, classes: int, alpha: float, beta: float = 1.0, l1: float = 1.0, l2: float = 1.0):
        self.z = np.zeros((dim, classes))
        self.n = np.zeros((dim, classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, rows=slice(None)) -> np.ndarray:
        z, n = self.z[rows], self.n[rows]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0.0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def update(self, rows: np.ndarray, weights: np.ndarray, gradient: np.ndarray) -> None:
        """``rows`` are distinct; ``weights`` are those the gradient was taken at."""
        n = self.n[rows]
        grown = n + gradient**2
        self.z[rows] += gradient - (np.sqrt(grown) - np.sqrt(n)) / self.alpha * weights
        self.n[rows] = grown
