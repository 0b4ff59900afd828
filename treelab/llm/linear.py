"""Logistic regression on small dense or sparse samples, for models whose training rows are bounded."""

from __future__ import annotations

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, rounds: int = 200, weight: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise log loss plus l2 / 2 * |weights|^2 (sum over rows), by accelerated gradient steps."""
    n, d = x.shape
    weight = np.ones(n) if weight is None else weight
    if not n:
        return np.zeros(d), 0.0
    rate = float((weight @ y + 0.5) / (weight.sum() + 1))
    w, b = np.zeros(d), float(np.log(rate / (1 - rate)))
    v, c = w.copy(), b
    smooth = 0.25 * _top(x, weight) + l2
    momentum = 1.0
    for _ in range(rounds):
        r = weight * (sigmoid(x @ v.astype(x.dtype) + c) - y)
        new_w, new_b = v - (r.astype(x.dtype) @ x + l2 * v) / smooth, c - r.sum() / smooth
        following = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        turn = (momentum - 1) / following
        moved = new_w - w
        if (new_w - v) @ moved < -1e-12:  # the step went back: start the momentum anew
            following, turn = 1.0, 0.0
        v, c = new_w + turn * moved, new_b + turn * (new_b - b)
        done = np.abs(moved).max(initial=0) < 1e-5 and abs(new_b - b) < 1e-5
        w, b, momentum = new_w, new_b, following
        if done:
            break
    return w, b


def _top(x: np.ndarray, weight: np.ndarray) -> float:
    """Largest eigenvalue of X'WX with a column of ones, by power steps; rounded up."""
    v, u = np.ones(x.shape[1]), 1.0
    top = 1.0
    for _ in range(20):
        r = weight * (x @ v.astype(x.dtype) + u)
        v, u = (r.astype(x.dtype) @ x).astype(float), float(r.sum())
        top = float(np.sqrt(v @ v + u * u)) or 1.0
        v, u = v / top, u / top
    return 1.05 * top
