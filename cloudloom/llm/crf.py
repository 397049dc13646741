"""A linear-chain conditional random field, fitted and decoded with numpy.

Tokens carry binary features given as id lists; label 0 means outside.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Crf:
    """``emit``: (features, labels); ``move``: (labels, labels); ``first``, ``last``: (labels,)."""

    emit: np.ndarray
    move: np.ndarray
    first: np.ndarray
    last: np.ndarray

    def viterbi(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Best labels of a batch. scores: (rows, time, labels), rows by falling length; padding gets label 0."""
        rows, time, labels = scores.shape
        best = np.zeros((rows, time), np.int8)
        back = np.zeros((rows, time, labels), np.int8)
        state = scores[:, 0] + self.first
        for t in range(1, time):
            live = int((lengths > t).sum())
            step = state[:live, :, None] + self.move
            back[:live, t] = step.argmax(axis=1)
            state[:live] = step.max(axis=1) + scores[:live, t]
        now = (state + self.last).argmax(axis=1)
        best[np.arange(rows), lengths - 1] = now
        for t in range(time - 1, 0, -1):
            live = int((lengths > t).sum())
            now[:live] = back[np.arange(live), t, now[:live]]
            best[:live, t - 1] = now[:live]
        return best


class Likelihood:
    """Mean negative log-likelihood of labelled sequences and its gradient, for all of them at once.

    ``sequences``: (feature ids of each token, labels). Equal sequences are
    counted, not repeated; nothing depends on their order.
    """

    def __init__(self, sequences: list[tuple[list[list[int]], list[int]]], features: int, labels: int):
        counted: dict = {}
        for tokens, marks in sequences:
            key = (tuple(map(tuple, tokens)), tuple(marks))
            counted[key] = counted.get(key, 0) + 1
        items = sorted(counted.items(), key=lambda x: (-len(x[0][1]), x[0]))
        self.labels, self.features = labels, features
        self.size = np.array([len(k[1]) for k, _ in items])
        weight = np.array([n for _, n in items], float)
        self.weight = weight / max(weight.sum(), 1)
        width = max((len(f) for k, _ in items for f in k[0]), default=1)
        # The last row of ``emit`` pads tokens with fewer features; it stays zero.
        self.ids = np.array([[*f, *[features] * (width - len(f))] for (tokens, _), _ in items for f in tokens], np.int64).reshape(-1, width)
        self.gold = np.zeros((len(items), max((len(k[1]) for k, _ in items), default=1)), np.int64)
        for r, ((_, marks), _) in enumerate(items):
            self.gold[r, : len(marks)] = marks
        self.live = np.arange(self.gold.shape[1])[None, :] < self.size[:, None]
        order = np.argsort(self.ids, axis=None, kind="stable")
        self.used, self.starts = np.unique(self.ids.ravel()[order], return_index=True)
        self.owner = order // width

    def __call__(self, theta: list[np.ndarray]) -> tuple[float, list[np.ndarray]]:
        """By forward and backward sums of probabilities, scaled at each place."""
        emit, move, first, last = theta
        gold, live, size, weight = self.gold, self.live, self.size, self.weight
        rows, time = gold.shape
        at = np.arange(rows)
        scores = np.zeros((rows, time, self.labels))
        scores[live] = sum(emit[self.ids[:, k]] for k in range(self.ids.shape[1]))
        top = scores.max(axis=2, keepdims=True)
        weights, moves, ends = np.exp(scores - top), np.exp(move), np.exp(last)
        alpha, beta, scale = np.zeros_like(scores), np.zeros_like(scores), np.ones((rows, time))
        longer = [int((size > t).sum()) for t in range(time)]
        for t in range(time):
            n = longer[t]
            step = (alpha[:n, t - 1] @ moves if t else np.exp(first)) * weights[:n, t]
            scale[:n, t] = step.sum(axis=1)
            alpha[:n, t] = step / scale[:n, t, None]
        closing = alpha[at, size - 1] @ ends
        total = (np.log(scale) + top[:, :, 0]).sum(axis=1) + np.log(closing)
        beta[at, size - 1] = ends / closing[:, None]
        for t in range(time - 2, -1, -1):
            n = longer[t + 1]
            beta[:n, t] = (weights[:n, t + 1] * beta[:n, t + 1] / scale[:n, t + 1, None]) @ moves.T
        error = (alpha * beta - np.eye(self.labels)[gold]) * (live * weight[:, None])[:, :, None]
        grads = [np.zeros_like(x) for x in theta]
        grads[0][self.used] = np.add.reduceat(error[live][self.owner], self.starts)
        grads[0][self.features] = 0
        path = np.where(live, np.take_along_axis(scores, gold[:, :, None], 2)[:, :, 0], 0).sum(axis=1) + first[gold[:, 0]] + last[gold[at, size - 1]]
        for t in range(1, time):
            n = longer[t]
            right = weights[:n, t] * beta[:n, t] / scale[:n, t, None]
            grads[1] += moves * ((alpha[:n, t - 1] * weight[:n, None]).T @ right)
            np.add.at(grads[1], (gold[:n, t - 1], gold[:n, t]), -weight[:n])
            path[:n] += move[gold[:n, t - 1], gold[:n, t]]
        grads[2] = error[:, 0].sum(axis=0)
        grads[3] = error[at, size - 1].sum(axis=0)
        return float((weight * (total - path)).sum()), grads


def fit(
    sequences: list[tuple[list[list[int]], list[int]]], features: int, labels: int, rounds: int = 100, rate: float = 0.15, ridge: float = 0.0002
) -> Crf:
    """Maximum likelihood with an L2 penalty, by Adam over all sequences at once; without sequences all weights are zero."""
    shapes = ((features + 1, labels), (labels, labels), (labels,), (labels,))
    theta = [np.zeros(s) for s in shapes]
    if sequences:
        value = Likelihood(sequences, features, labels)
        seen, square = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]
        for step in range(1, rounds + 1):
            for k, grad in enumerate(value(theta)[1]):
                grad = grad + ridge * theta[k]
                seen[k] = 0.9 * seen[k] + 0.1 * grad
                square[k] = 0.999 * square[k] + 0.001 * grad**2
                theta[k] = theta[k] - rate * (seen[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
    return Crf(*theta)
