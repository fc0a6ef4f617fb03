"""Adam for models held as dictionaries of numpy arrays."""

from __future__ import annotations

import numpy as np

Weights = dict[str, np.ndarray]


class Adam:
    def __init__(self, weights: Weights, rate: float, clip: float = 5.0):
        self.weights, self.rate, self.clip, self.steps = weights, rate, clip, 0
        self.mean = {k: np.zeros_like(v) for k, v in weights.items()}
        self.square = {k: np.zeros_like(v) for k, v in weights.items()}

    def step(self, gradients: Weights) -> None:
        """Move all weights against their gradients, which are scaled down to a norm of ``clip``."""
        self.steps += 1
        norm = float(np.sqrt(sum(float((g**2).sum()) for g in gradients.values())))
        scale = min(1.0, self.clip / (norm + 1e-12))
        for k, g in gradients.items():
            g = g * scale
            self.mean[k] += 0.1 * (g - self.mean[k])
            self.square[k] += 0.001 * (g * g - self.square[k])
            mean = self.mean[k] / (1 - 0.9**self.steps)
            square = self.square[k] / (1 - 0.999**self.steps)
            self.weights[k] -= (self.rate * mean / (np.sqrt(square) + 1e-8)).astype(self.weights[k].dtype)
