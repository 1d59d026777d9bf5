"""Two-state linear-chain conditional random field over dense features.

Sequences are batched: positions of all sequences at step t are handled in one
numpy operation, so cost follows the number of positions. ``weights`` holds one
row of emission weights per state and a 2 x 2 transition matrix.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Crf:
    emission: np.ndarray  # (features, 2)
    transition: np.ndarray  # (2, 2), from row to column
    mean: np.ndarray
    scale: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.emission


def _steps(ranges: np.ndarray):
    """Sequences by descending length, and how many still run at every step."""
    size = np.diff(ranges)
    order = np.argsort(-size, kind="stable")
    longest = int(size.max()) if len(size) else 0
    running = len(size) - np.searchsorted(np.sort(size), np.arange(longest), "right")
    return order, running


def _log_sum(a: np.ndarray) -> np.ndarray:
    """log of the sum of exponentials over the first axis after the batch one."""
    top = a.max(axis=1, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=1, keepdims=True)))[:, 0]


def forward_backward(scores: np.ndarray, transition: np.ndarray, ranges: np.ndarray):
    """Marginals (positions, 2), summed pair marginals (2, 2), log partition per sequence."""
    order, running = _steps(ranges)
    start = ranges[:-1][order]
    end = ranges[1:][order] - 1
    alpha = np.zeros_like(scores)
    beta = np.zeros_like(scores)
    for t, k in enumerate(running.tolist()):
        at = start[:k] + t
        alpha[at] = scores[at] + (0 if t == 0 else _log_sum(alpha[at - 1][:, :, None] + transition[None]))
    pairs = np.zeros((2, 2))
    log_z = np.zeros(len(order))
    full = np.flatnonzero(np.diff(ranges)[order] > 0)
    log_z[order[full]] = _log_sum(alpha[end[full]])
    for t, k in enumerate(running.tolist()):
        if t == 0:
            continue
        at = end[:k] - t
        into = (scores[at + 1] + beta[at + 1])[:, None, :] + transition[None]
        beta[at] = _log_sum(into.transpose(0, 2, 1))
        pairs += np.exp(alpha[at][:, :, None] + into - log_z[order[:k]][:, None, None]).sum(axis=0)
    seq = np.repeat(np.arange(len(log_z)), np.diff(ranges))
    return np.exp(alpha + beta - log_z[seq][:, None]), pairs, log_z


def viterbi(scores: np.ndarray, transition: np.ndarray, ranges: np.ndarray) -> np.ndarray:
    order, running = _steps(ranges)
    start = ranges[:-1][order]
    end = ranges[1:][order] - 1
    best = np.zeros_like(scores)
    back = np.zeros(scores.shape, np.int8)
    for t, k in enumerate(running.tolist()):
        at = start[:k] + t
        if t == 0:
            best[at] = scores[at]
            continue
        options = best[at - 1][:, :, None] + transition[None]
        back[at] = options.argmax(axis=1)
        best[at] = scores[at] + options.max(axis=1)
    state = np.zeros(len(scores), np.int8)
    for t, k in enumerate(running.tolist()):
        at = end[:k] - t
        state[at] = best[at].argmax(axis=1) if t == 0 else back[at + 1, state[at + 1]]
    return state


def train(x: np.ndarray, y: np.ndarray, ranges: np.ndarray, l2: float = 1e-3, steps: int = 200, rate: float = 0.1) -> Crf:
    """Maximum-likelihood weights by Adam on the whole (bounded) sample."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-6] = 1.0
    mean = np.where(scale == 1.0, 0.0, mean)
    z = (x - mean) / scale
    positions = max(len(z), 1)
    one_hot = np.eye(2)[y]
    inner = np.ones(len(y), bool)
    first = ranges[:-1]
    inner[first[first < len(y)]] = False
    at = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[at - 1], y[at]), 1)
    shape = (z.shape[1], 2)
    w = np.zeros(shape[0] * 2 + 4)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for k in range(1, steps + 1):
        e, tr = w[:-4].reshape(shape), w[-4:].reshape(2, 2)
        p, pairs, _ = forward_backward(z @ e, tr, ranges)
        g = np.append((z.T @ (p - one_hot)).ravel(), (pairs - seen).ravel()) / positions + l2 * w
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    return Crf(w[:-4].reshape(shape), w[-4:].reshape(2, 2), mean, scale)
