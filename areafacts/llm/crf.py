"""A linear-chain conditional random field with two labels; numpy only.

Scores of label 1 against label 0 come from hashed features; the chain adds a score for each pair of neighbouring
labels. Chains are stepped together, [time, lane]; positions past a chain's end carry no score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Field:
    weights: np.ndarray  # of the hashed features, for label 1
    pairs: np.ndarray  # [label before, label]


def _log_add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


def _sweep(scores: np.ndarray, live: np.ndarray, pairs: np.ndarray):
    """Forward messages of both labels [time, lane]."""
    zero, one = np.empty_like(scores), np.empty_like(scores)
    zero[0], one[0] = 0, scores[0]
    for t in range(1, len(scores)):
        z = _log_add(zero[t - 1] + pairs[0, 0], one[t - 1] + pairs[1, 0])
        o = _log_add(zero[t - 1] + pairs[0, 1], one[t - 1] + pairs[1, 1]) + scores[t]
        zero[t], one[t] = np.where(live[t], z, zero[t - 1]), np.where(live[t], o, one[t - 1])
    return zero, one


def _back(scores: np.ndarray, live: np.ndarray, pairs: np.ndarray):
    zero, one = np.zeros_like(scores), np.zeros_like(scores)
    for t in range(len(scores) - 2, -1, -1):
        to_zero, to_one = zero[t + 1], one[t + 1] + scores[t + 1]
        z = _log_add(pairs[0, 0] + to_zero, pairs[0, 1] + to_one)
        o = _log_add(pairs[1, 0] + to_zero, pairs[1, 1] + to_one)
        zero[t], one[t] = np.where(live[t + 1], z, 0), np.where(live[t + 1], o, 0)
    return zero, one


def marginals(scores: np.ndarray, live: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Probability of label 1 at each position; 0 past a chain's end."""
    if not scores.size:
        return np.zeros_like(scores)
    (a0, a1), (b0, b1) = _sweep(scores, live, pairs), _back(scores, live, pairs)
    return live / (1 + np.exp(np.clip(a0 + b0 - a1 - b1, -500, 500)))


def train(features: np.ndarray, live: np.ndarray, labels: np.ndarray, n_weights: int, rounds: int, rate: float, decay: float) -> Field:
    """Conditional likelihood by gradient steps (Adam); ``features``: [time, lane, feature] of hashed numbers."""
    field = Field(np.zeros(n_weights), np.zeros((2, 2)))
    first = [np.zeros(n_weights), np.zeros((2, 2))]
    second = [np.zeros(n_weights), np.zeros((2, 2))]
    total = max(live.sum(), 1)
    flat, both = features.reshape(-1), live[1:] & live[:-1]
    seen = np.array([[(both & (labels[:-1] == a) & (labels[1:] == b)).sum() for b in (0, 1)] for a in (0, 1)])
    for step in range(1, rounds + 1):
        scores = field.weights[features].sum(axis=2) * live
        (a0, a1), (b0, b1) = _sweep(scores, live, field.pairs), _back(scores, live, field.pairs)
        ends = _log_add(a0[-1], a1[-1])
        p = live / (1 + np.exp(np.clip(a0 + b0 - a1 - b1, -500, 500)))
        wrong = np.repeat(((p - labels) * live).reshape(-1), features.shape[2])
        grad = np.bincount(flat, wrong, n_weights) / total + decay * field.weights
        alpha, beta = (a0, a1), (b0, b1 + scores)
        expected = np.array(
            [[(np.exp(alpha[i][:-1] + field.pairs[i, j] + beta[j][1:] - ends) * both).sum() for j in (0, 1)] for i in (0, 1)]
        )
        for k, g in enumerate((grad, (expected - seen) / total + decay * field.pairs)):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            move = rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
            if k:
                field.pairs -= move
            else:
                field.weights -= move
    return field
