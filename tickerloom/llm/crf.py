"""A linear-chain conditional random field in numpy: training, marginals and Viterbi over padded batches.

Sequences are arrays of feature numbers [rows, steps, features] (0: none) with a mask of the
steps that exist, which is a prefix of each row.
"""

from __future__ import annotations

import numpy as np


def padded(sequences: list[list[list[int]]], width: int) -> tuple[np.ndarray, np.ndarray]:
    steps = max((len(s) for s in sequences), default=0)
    features = np.zeros((len(sequences), steps, width), dtype=np.int32)
    mask = np.zeros((len(sequences), steps), dtype=bool)
    for row, sequence in enumerate(sequences):
        mask[row, : len(sequence)] = True
        for step, active in enumerate(sequence):
            features[row, step, : len(active)] = active
    return features, mask


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(values - top).sum(axis=axis))


class Crf:
    def __init__(self, n_features: int, n_tags: int):
        self.unary = np.zeros((n_features, n_tags))
        self.pair = np.zeros((n_tags, n_tags))
        self.first = np.zeros(n_tags)

    def emissions(self, features: np.ndarray) -> np.ndarray:
        return self.unary[features].sum(axis=2)

    def forward_backward(self, emission: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Forward and backward log sums [rows, steps, tags] and the log partition [rows]."""
        rows, steps, tags = emission.shape
        ahead, back = np.zeros_like(emission), np.zeros_like(emission)
        ahead[:, 0] = self.first + emission[:, 0]
        for t in range(1, steps):
            moved = _log_sum(ahead[:, t - 1, :, None] + self.pair, 1) + emission[:, t]
            ahead[:, t] = np.where(mask[:, t, None], moved, ahead[:, t - 1])
        for t in range(steps - 2, -1, -1):
            moved = _log_sum(self.pair + (emission[:, t + 1] + back[:, t + 1])[:, None, :], 2)
            back[:, t] = np.where(mask[:, t + 1, None], moved, 0.0)
        return ahead, back, _log_sum(ahead[:, -1], 1)

    def marginals(self, emission: np.ndarray, mask: np.ndarray) -> np.ndarray:
        if not emission.shape[1]:
            return emission
        ahead, back, total = self.forward_backward(emission, mask)
        return np.exp(ahead + back - total[:, None, None]) * mask[:, :, None]

    def decode(self, emission: np.ndarray, mask: np.ndarray, start=None, end=0.0) -> np.ndarray:
        """The best tag of every step (Viterbi); steps without a token get tag 0.

        `start` and `end` are scores of each row's first and last tag, for parts of longer chains.
        """
        rows, steps, tags = emission.shape
        best = np.zeros((rows, steps), dtype=np.int16)
        if not steps or not rows:
            return best
        came = np.zeros((rows, steps, tags), dtype=np.int16)
        score = (self.first if start is None else start) + emission[:, 0]
        for t in range(1, steps):
            reached = score[:, :, None] + self.pair
            came[:, t] = np.where(mask[:, t, None], reached.argmax(axis=1), np.arange(tags))
            score = np.where(mask[:, t, None], reached.max(axis=1) + emission[:, t], score)
        best[:, -1] = (score + end).argmax(axis=1)
        for t in range(steps - 1, 0, -1):
            best[:, t - 1] = np.take_along_axis(came[:, t], best[:, t, None].astype(np.int64), 1)[:, 0]
        return np.where(mask, best, 0)

    def decode_rising(self, emission: np.ndarray, lengths: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """`decode` of rows whose lengths (one or more) do not fall; each step touches the rows that reach it only."""
        rows, steps, tags = emission.shape
        best = np.zeros((rows, steps), dtype=np.int16)
        came = np.zeros((steps, rows, tags), dtype=np.int8)
        score = start + emission[:, 0]
        reach = np.searchsorted(lengths, np.arange(steps), side="right").tolist()
        for t in range(1, steps):
            r = reach[t]
            reached = score[r:, :, None] + self.pair
            came[t, r:] = reached.argmax(axis=1)
            score[r:] = reached.max(axis=1) + emission[r:, t]
        best[np.arange(rows), lengths - 1] = (score + end).argmax(axis=1)
        every = np.arange(rows)
        for t in range(steps - 1, 0, -1):
            r = reach[t]
            best[r:, t - 1] = came[t, every[r:], best[r:, t]]
        return best

    def fit(self, features: np.ndarray, mask: np.ndarray, tags: np.ndarray, rounds: int, penalty: float, rate: float = 0.5):
        """Penalised maximum likelihood by full-batch AdaGrad; feature 0 keeps weight 0."""
        rows, steps, width = features.shape
        n_tags = self.pair.shape[0]
        gold = np.eye(n_tags)[tags] * mask[:, :, None]
        follows = mask[:, 1:]
        gold_pair = np.einsum("rti,rtj->ij", gold[:, :-1] * follows[:, :, None], gold[:, 1:])
        flat = features.reshape(-1)
        squares = [np.full_like(x, 1e-8) for x in (self.unary, self.pair, self.first)]
        for _ in range(rounds):
            emission = self.emissions(features)
            ahead, back, total = self.forward_backward(emission, mask)
            node = np.exp(ahead + back - total[:, None, None]) * mask[:, :, None]
            pair = np.zeros_like(self.pair)
            for t in range(1, steps):
                joint = ahead[:, t - 1, :, None] + self.pair + (emission[:, t] + back[:, t])[:, None, :] - total[:, None, None]
                pair += (np.exp(joint) * mask[:, t, None, None]).sum(axis=0)
            miss = np.repeat((gold - node).reshape(-1, n_tags), width, axis=0)
            unary = np.stack([np.bincount(flat, weights=miss[:, k], minlength=len(self.unary)) for k in range(n_tags)], axis=1)
            steps_up = (unary - penalty * self.unary, gold_pair - pair - penalty * self.pair,
                        (gold[:, 0] - node[:, 0]).sum(axis=0) - penalty * self.first)
            for value, square, step in zip((self.unary, self.pair, self.first), squares, steps_up):
                square += step**2
                value += rate * step / np.sqrt(square)
            self.unary[0] = 0.0
        return self
